"""The corpus pipeline: stages in order, each over all that the one before it kept.

Every stage takes (spark, docs, sf_dir) and returns a frame, which is written as Parquet and
read again as the next stage's docs; all but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidelog.llm.common import saved, table
from tidelog.llm.decontaminate import clean_stage
from tidelog.llm.line_dedup import line_stage
from tidelog.llm.near_dup import dedup_stage
from tidelog.llm.quality import filter_stage
from tidelog.llm.sentence_pieces import piece_stage

STAGES = [
    ("quality rules", filter_stage),
    ("line dedup", line_stage),
    ("near dedup", dedup_stage),
    ("decontamination", clean_stage),
    ("sentence pieces", piece_stage),
]

#: The fitted threshold and the piece merges cannot be said in SQL; each stage is held against brute force or the library in tests of its own.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over the documents of a folder."""
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = saved(stage(spark, docs, sf_dir), f"stage{k}")
    return docs
