"""Settings of a capture or apply job."""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Literal


@dataclass(frozen=True)
class CaptureConfig:
    """Settings of the source side; defaults are the documented ones."""

    include: tuple[str, ...] = ()
    exclude: tuple[str, ...] = ()
    schema_type: Literal["kafka", "single", "debezium"] = "kafka"
    topic_prefix: str = ""
    topic_style: Literal["TABLE", "SCHEMA_TABLE", "PDB_SCHEMA_TABLE"] = "TABLE"
    topic_delimiter: str = "_"
    topic_map: dict[str, str] = field(default_factory=dict)
    single_topic: str | None = None
    batch_size: int = 1000
    poll_interval_ms: int = 1000
    fetch_size: int = 32
    process_lobs: bool = False
    all_updates: bool = False
    all_columns_on_delete: bool = False
    rowid_as_key: bool = True
    tolerate_incomplete_rows: bool = False
    pseudo_columns: tuple[str, ...] = ()
    number_map: dict[str, str] = field(default_factory=dict)
    start_scn: int | None = None
    database_time_zone: str = "UTC"

    def problems(self) -> list[str]:
        """What is wrong with the settings; empty if they can be used."""
        out = []
        if self.batch_size < 1:
            out.append("batch_size must be positive")
        if self.single_topic and self.topic_map:
            out.append("single_topic and topic_map exclude each other")
        if self.start_scn is not None and self.start_scn < 0:
            out.append("start_scn must not be negative")
        both = set(self.include) & set(self.exclude)
        if both:
            out.append(f"included and excluded: {', '.join(sorted(both))}")
        return out


@dataclass(frozen=True)
class ApplyConfig:
    """Settings of the sink side."""

    mode: Literal["replicate", "audit"] = "replicate"
    dialect: Literal["postgresql", "mysql", "oracle", "mssql", "clickhouse"] = "postgresql"
    auto_create: bool = True
    batch_size: int = 1000
    table_prefix: str = ""
    table_suffix: str = ""
    topic_prefix: str = ""
