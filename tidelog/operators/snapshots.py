"""Snapshot logs and initial loads."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.operators.envelopes import op_of_code


def poll(log: DataFrame, last: int, batch_size: int, sequence: str = "sequence") -> DataFrame:
    """The next rows of a snapshot log: a batch limit, as the feature is (top-k by sequence)."""
    return log.where(F.col(sequence) > last).orderBy(sequence).limit(batch_size)


def with_master(log: DataFrame, master: DataFrame, key: Sequence[str], code: str = "dmltype") -> DataFrame:
    """Log rows with their master row and op; a created or changed row that is gone since is skipped, a delete needs none."""
    joined = log.withColumn("op", op_of_code(code)).join(master.withColumn("_found", F.lit(True)), list(key), "left")
    return joined.where("op = 'd' or _found").drop("_found")


def chunk_predicates(column: str, low: int, high: int, chunks: int) -> list[str]:
    """Disjoint ranges that cover [low, high] and NULLs, for a parallel read."""
    step = max(1, -(-(high - low + 1) // chunks))
    cuts = list(range(low, high + 1, step))
    out = [f"{column} >= {a} and {column} < {min(a + step, high + 1)}" for a in cuts]
    return [*out, f"{column} is null"] if out else ["1 = 1"]


def load_then_stream(table_as_of: DataFrame, changes: DataFrame, load_scn: Column, columns: Sequence[str], scn: str = "scn") -> DataFrame:
    """Events of an initial load (op r at the load's SCN) and of the changes behind it."""
    load = table_as_of.select(*columns, load_scn.alias(scn), F.lit("r").alias("op"))
    return load.unionByName(changes.where(F.col(scn) > load_scn).select(*columns, scn, "op"))


def first_available_scn(archived: DataFrame, online: DataFrame, first: str = "first_scn") -> DataFrame:
    """The least SCN of the archived logs, else of the online log."""
    a, b = archived.agg(F.min(first).alias("a")), online.agg(F.min(first).alias("b"))
    return a.crossJoin(b).select(F.least(F.coalesce("a", "b"), F.coalesce("b", "a")).alias("first_available_scn"))


def next_logs(archived: DataFrame, last_sequence: int, last_scn: int, online: DataFrame | None = None) -> DataFrame:
    """For each thread the log to read next: the archived one of least sequence behind the position, else the online one."""
    behind = archived.where((F.col("sequence") >= last_sequence) & (F.col("next_scn") > last_scn)).withColumn("is_online", F.lit(False))
    if online is not None:
        behind = behind.unionByName(online.withColumn("is_online", F.lit(True)))
    rest = [c for c in behind.columns if c != "thread"]
    best = behind.groupBy("thread").agg(F.min(F.struct("is_online", "sequence", *(c for c in rest if c not in ("is_online", "sequence")))).alias("b"))
    return best.select("thread", *(F.col(f"b.{c}").alias(c) for c in rest))
