"""Change events: keys, values, envelopes, topic and schema names."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def op_letter(op: str = "op") -> Column:
    return F.when(F.col(op) == 1, "c").when(F.col(op) == 2, "d").when(F.col(op) == 3, "u")


def op_of_code(code: str = "dmltype") -> Column:
    """Snapshot-log codes: I is a create, U an update, anything else a delete."""
    return F.when(F.col(code) == "I", "c").when(F.col(code) == "U", "u").otherwise("d")


def kafka_event(changes: DataFrame, key: Sequence[str], value: Sequence[str], carry: Sequence[str] = (), all_columns_on_delete: bool = False) -> DataFrame:
    """key struct, value struct without the key (NULL for a delete), and op."""
    body = F.struct(*value)
    return changes.select(*carry, F.struct(*key).alias("key"), (body if all_columns_on_delete else F.when(F.col("op") != 2, body)).alias("value"), op_letter().alias("op"))


def single_event(changes: DataFrame, columns: Sequence[str], carry: Sequence[str] = ()) -> DataFrame:
    """All columns in the value, no key; deletes, which nothing could find, go."""
    return changes.where("op <> 2").select(*carry, F.struct(*columns).alias("value"), op_letter().alias("op"))


def debezium_event(changes: DataFrame, key: Sequence[str], before: Column, after: Column, source: Column, ts_ms: Column, carry: Sequence[str] = ()) -> DataFrame:
    """before for updates and deletes, after for creates and updates, source, op, and times; the key beside them."""
    return changes.select(*carry, F.struct(*key).alias("key"), F.when(F.col("op") != 1, before).alias("before"), F.when(F.col("op") != 2, after).alias("after"), source.alias("source"), op_letter().alias("op"), ts_ms.alias("ts_ms"), (ts_ms * 1_000_000).alias("ts_ns"))


def snapshot_event(changes: DataFrame, key: Sequence[str], value: Sequence[str], op: Column) -> DataFrame:
    """Snapshot-log changes: before holds the key, after the master row."""
    return changes.select(F.struct(*key).alias("before"), F.when(op != "d", F.struct(*value)).alias("after"), op.alias("op"))


def wrapped(columns: Sequence[str], present: Mapping[str, Column]) -> list[Column]:
    """Each column as struct<V>: NULL where absent, V NULL where it is SQL NULL."""
    return [F.when(present[c], F.struct(F.col(c).alias("V"))).alias(c) for c in columns]


def map_event(columns: Sequence[str], op: Column) -> list[Column]:
    """op and the column values by 1-based number as text."""
    return [op.alias("op"), F.create_map(*(x for k, c in enumerate(columns) for x in (F.lit(k + 1), F.col(c).cast("string")))).alias("value")]


def topic_name(style: str, prefix: str = "", delimiter: str = "_", pdb: str = "pdb", owner: str = "owner", table: str = "table_name") -> Column:
    """Topic of a table; letters that a topic may not have become zZ."""
    parts = {"TABLE": [table], "SCHEMA_TABLE": [owner, table], "PDB_SCHEMA_TABLE": [pdb, owner, table]}[style]
    return F.regexp_replace(F.concat(F.lit(prefix), F.concat_ws(delimiter, *(F.col(p) for p in parts))), r"[^a-zA-Z0-9._\-]", "zZ")


def mapped_topic(changes: DataFrame, topics: DataFrame, default: Column, on: str = "fqn") -> DataFrame:
    """changes with ``topic`` from a map of full table names, else the default."""
    return changes.join(topics.select(on, F.col("topic").alias("_t")), on, "left").withColumn("topic", F.coalesce("_t", default)).drop("_t")


def schema_name(kind: str, pdb: str = "pdb", owner: str = "owner", table: str = "table_name", protobuf: bool = False) -> Column:
    """``[PDB:]OWNER.TABLE.Key`` or ``.Value``; joined by underscores for protobuf."""
    if protobuf:
        return F.concat_ws("_", F.col(pdb), F.col(owner), F.col(table), F.lit(kind))
    return F.concat(F.coalesce(F.concat(F.col(pdb), F.lit(":")), F.lit("")), F.concat_ws(".", F.col(owner), F.col(table), F.lit(kind)))


def field_name(name: Column) -> Column:
    """A name that strict schema languages accept."""
    return F.regexp_replace(F.regexp_replace(name, r"[^A-Za-z0-9_]", "_"), r"^([0-9])", "_$1")


def partition_of_thread(thread: str = "thread", cluster: bool = True) -> Column:
    """Each redo thread of a cluster has its own partition; else all use 0."""
    return F.col(thread) - 1 if cluster else F.lit(0)
