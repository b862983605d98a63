"""Applying change events to tables, as functions of frames: (base, events) to the next base."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def event_op(envelope_op: str | None = None, header_op: str | None = None) -> Column:
    """The op of the envelope, else of the header, else create."""
    return F.coalesce(*(F.col(c) for c in (envelope_op, header_op) if c), F.lit("c"))


def last_per_key(events: DataFrame, key: Sequence[str], position: Sequence[str]) -> DataFrame:
    """The last event of each key in log order, whatever its op.

    An ordered maximum aggregates before the shuffle, so a hot key is no hot task.
    """
    rest = [c for c in events.columns if c not in key]
    last = events.groupBy(*key).agg(F.max_by(F.struct(*rest), F.struct(*position)).alias("_r"))
    return last.select(*(F.col(c) if c in key else F.col(f"_r.{c}").alias(c) for c in events.columns))


def upsert(base: DataFrame, events: DataFrame, key: Sequence[str], position: Sequence[str], op: str = "op") -> DataFrame:
    """base after the events: inserts and updates replace the row of their key, deletes remove it, the last event of a key wins."""
    delta = last_per_key(events, key, position)
    kept = base.join(delta.select(*key), list(key), "left_anti")
    return kept.unionByName(delta.where(F.col(op) != "d").select(*base.columns))


def audit(base: DataFrame, events: DataFrame) -> DataFrame:
    """Every event as one more row."""
    return base.unionByName(events.select(*base.columns))


def partial_update(base: DataFrame, events: DataFrame, key: Sequence[str], position: Sequence[str], columns: Sequence[str], op: str = "op") -> DataFrame:
    """base after events of struct<V> columns: only columns that are present change, NULL included.

    The latest present value of each column wins; a delete clears what came before it.
    """
    w = Window.partitionBy(*key).orderBy(*position).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    cut = events.withColumn("_del", F.max(F.when(F.col(op) == "d", F.struct(*position))).over(w)).where(F.col("_del").isNull() | (F.struct(*position) >= F.col("_del")))
    folded = cut.groupBy(*key).agg(F.max_by(op, F.struct(*position)).alias("_op"), F.max((F.col(op) == "d").cast("int")).alias("_fresh"), *(F.max_by(c, F.when(F.col(c).isNotNull(), F.struct(*position))).alias(f"_n_{c}") for c in columns))
    joined = base.withColumn("_b", F.lit(True)).join(folded, list(key), "full").where("_op is null or _op <> 'd'")
    keep = F.coalesce(F.col("_fresh"), F.lit(0)) == 0
    new = [F.when(F.col(f"_n_{c}").isNotNull(), F.col(f"_n_{c}.V")).otherwise(F.when(keep, F.col(c))).alias(c) for c in columns]
    rest = [F.when(keep, F.col(c)).alias(c) for c in base.columns if c not in columns and c not in key]
    return joined.select(*key, *new, *rest).select(*base.columns)


def evolve(base: DataFrame, events: DataFrame) -> tuple[DataFrame, list[str], list[str]]:
    """(base with the events' new columns as NULL, the names added, base columns that the events lack)."""
    added = [c for c in events.columns if c not in base.columns]
    out = base.select("*", *(F.lit(None).cast(events.schema[c].dataType).alias(c) for c in added))
    return out, added, [c for c in base.columns if c not in events.columns]


def lob_values(base: DataFrame, delta: DataFrame, key: Sequence[str], lobs: Sequence[str]) -> DataFrame:
    """base with large objects from delta's struct<V>; a NULL struct leaves the stored one."""
    side = delta.select(*key, *(F.col(c).alias(f"_l_{c}") for c in lobs))
    out = base.join(side, list(key), "left")
    return out.select(*(F.when(F.col(f"_l_{c}").isNotNull(), F.col(f"_l_{c}.V")).otherwise(F.col(c)).alias(c) if c in lobs else F.col(c) for c in base.columns))


def unnest(events: DataFrame, column: str) -> DataFrame:
    """A struct column's children as columns of their own."""
    return events.select(*(c for c in events.columns if c != column), f"{column}.*")


def table_of_topic(topic: Column, topic_prefix: str = "", prefix: str = "", suffix: str = "") -> Column:
    bare = F.when(topic.startswith(topic_prefix), F.substring(topic, F.lit(len(topic_prefix) + 1), F.length(topic))).otherwise(topic) if topic_prefix else topic
    return F.concat(F.lit(prefix), bare, F.lit(suffix))


def table_of_schema(schema: Column) -> Column:
    """OWNER.TABLE.Value to TABLE."""
    return F.element_at(F.split(F.regexp_replace(schema, r"\.(Key|Value|Envelope)$", ""), r"[.:]"), -1)


def finite_or_null(column: Column, nullable: bool, least: float) -> Column:
    """Minus infinity becomes NULL, or the least value of a mandatory column."""
    return F.when(column == F.lit(float("-inf")), F.lit(None) if nullable else F.lit(least)).otherwise(column)
