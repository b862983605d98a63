"""Large objects: chunks to values, and chunks that belong to the change before them."""

from __future__ import annotations

import zlib
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType


@F.pandas_udf(BinaryType())
def inflate(data: pd.Series) -> pd.Series:
    """zlib bytes to plain bytes; NULL stays."""
    return data.map(lambda b: None if b is None else zlib.decompress(b))


def assemble(chunks: DataFrame, key: Sequence[str], number: str = "chunk_no", data: str = "bytes") -> DataFrame:
    """(key, n_chunks, value): the chunks of each object in order; an object's size is its own bound."""
    got = chunks.groupBy(*key).agg(F.array_sort(F.collect_list(F.struct(number, data))).alias("_c"))
    return got.select(*key, F.size("_c").alias("n_chunks"), F.array_join(F.col(f"_c.{data}"), "").alias("value"))


def assemble_bytes(chunks: DataFrame, key: Sequence[str], number: str = "chunk_no", data: str = "bytes", compressed: Column | None = None) -> DataFrame:
    """Binary objects in order; inflated where ``compressed`` is true of the object's first chunk."""
    flag = F.lit(False) if compressed is None else compressed
    got = chunks.groupBy(*key).agg(F.array_sort(F.collect_list(F.struct(number, data, flag.alias("z")))).alias("_c"))
    whole = F.aggregate("_c", F.lit(b"").cast("binary"), lambda a, c: F.concat(a, c[data]))
    out = got.select(*key, F.size("_c").alias("n_chunks"), whole.alias("value"), F.col("_c")[0]["z"].alias("_z"))
    return out.withColumn("value", F.when(F.col("_z"), inflate(F.when(F.col("_z"), F.col("value")))).otherwise(F.col("value"))).drop("_z")


def chunks_by_statement(log: DataFrame, partition: Sequence[str], position: Sequence[str], is_change: Column, is_chunk: Column) -> DataFrame:
    """Chunk rows with ``owner``, the position of the change before them in their transaction; chunks before any change go."""
    w = Window.partitionBy(*partition).orderBy(*position).rowsBetween(Window.unboundedPreceding, 0)
    marked = log.withColumn("owner", F.last(F.when(is_change, F.struct(*position)), ignorenulls=True).over(w))
    return marked.where(is_chunk & F.col("owner").isNotNull())


def attach(changes: DataFrame, objects: DataFrame, key: Sequence[str], name: str) -> DataFrame:
    """changes with struct<V> column ``name``: NULL where the change has no such object, an empty value where it has no chunks."""
    return changes.join(objects.select(*key, F.struct(F.col("value").alias("V")).alias(name)), list(key), "left")
