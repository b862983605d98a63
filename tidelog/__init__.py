"""Change data engine on DataFrames, SQL and Structured Streaming."""
