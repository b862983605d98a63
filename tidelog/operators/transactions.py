"""Transaction-level operators: commit join, rollback cancelling, order, low-water mark."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def committed(log: DataFrame, ends: DataFrame, on: str = "xid") -> DataFrame:
    """Changes of committed transactions with their commit position; rolled-back and open ones go."""
    return log.join(ends.where(~F.col("is_rollback")).drop("is_rollback"), on)


def open_transactions(log: DataFrame, ends: DataFrame, on: str = "xid") -> DataFrame:
    return log.join(ends, on, "left_anti")


def cancel_rollbacks(log: DataFrame, position: Sequence[str], xid: str = "xid", row_id: str = "row_id", rollback: str = "rollback") -> DataFrame:
    """Marks each row ``kept`` or not, and ``unpaired`` rollback records.

    A rollback record undoes the latest change of its row that still stands.  The running sum
    of +1 (change) and -1 (rollback) is the height of a stack: a change stands if the height
    never falls below its own again.  Both windows share one partitioning and one sort.
    """
    w = Window.partitionBy(xid, row_id).orderBy(*position)
    depth = log.withColumn("_d", F.sum(F.when(F.col(rollback), -1).otherwise(1)).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    later = F.min("_d").over(w.rowsBetween(1, Window.unboundedFollowing))
    earlier = F.min("_d").over(w.rowsBetween(Window.unboundedPreceding, -1))
    return depth.select(
        *log.columns,
        (~F.col(rollback) & F.coalesce(later >= F.col("_d"), F.lit(True))).alias("kept"),
        (F.col(rollback) & (F.col("_d") < F.least(F.lit(0), F.coalesce(earlier, F.lit(0))))).alias("unpaired"),
    )


def survivors(log: DataFrame, position: Sequence[str], **names: str) -> DataFrame:
    """The changes that no rollback record undid."""
    return cancel_rollbacks(log, position, **names).where("kept").drop("kept", "unpaired")


def suspicious(log: DataFrame, position: Sequence[str], xid: str = "xid") -> DataFrame:
    """A row for each transaction: unpaired rollback records, does it begin with one, and the verdict."""
    marked = cancel_rollbacks(log, position)
    return marked.groupBy(xid).agg(F.count("*").alias("n_statements"), F.sum(F.col("unpaired").cast("long")).alias("n_unpaired"), F.min_by("rollback", F.struct(*position)).alias("starts_with_rollback")).withColumn("suspicious", (F.col("n_unpaired") > 0) | F.col("starts_with_rollback"))


def in_transaction_order(log: DataFrame, position: Sequence[str], xid: str = "xid") -> DataFrame:
    """log with ``seq``, the change's number in its transaction from 1."""
    return log.withColumn("seq", F.row_number().over(Window.partitionBy(xid).orderBy(*position)))


def commit_order(changes: DataFrame, position: Sequence[str] = ("seq",), commit: str = "commit_scn", xid: str = "xid") -> DataFrame:
    """Rows sorted as they are to be emitted; transactions with one commit SCN follow by identifier."""
    return changes.orderBy(commit, xid, *position)


def starts(log: DataFrame, position: Sequence[str], xid: str = "xid") -> DataFrame:
    """(xid, start, n_statements): the first position of each transaction."""
    return log.groupBy(xid).agg(F.min(F.struct(*position)).alias("start"), F.count("*").alias("n_statements"))


def low_water(log: DataFrame, ends: DataFrame, position: Sequence[str], xid: str = "xid") -> DataFrame:
    """Open transactions, and which of them holds back the restart point."""
    opened = starts(open_transactions(log, ends, xid), position, xid)
    least = opened.agg(F.min("start").alias("_least"))
    return opened.crossJoin(F.broadcast(least)).withColumn("is_low_water", F.col("start") == F.col("_least")).drop("_least")


def resolve_partial_xids(changes: DataFrame, starts_: DataFrame, prefix: Column, invalid: Column, position: str = "scn") -> DataFrame:
    """changes with ``resolved_xid``: an identifier with no sequence belongs to the latest transaction of its prefix that started before.

    The as-of join is a union sorted by position, so it costs one shuffle and no row pairs.
    """
    cols = changes.columns
    left = changes.select(*cols, prefix.alias("_p"), F.lit(1).alias("_k"), F.lit(None).cast(starts_.schema["xid"].dataType).alias("_x"))
    right = starts_.select(*(F.lit(None).cast(changes.schema[c].dataType).alias(c) if c != position else F.col("start_scn").alias(c) for c in cols), F.col("prefix").alias("_p"), F.lit(0).alias("_k"), F.col("xid").alias("_x"))
    w = Window.partitionBy("_p").orderBy(position, "_k", "_x").rowsBetween(Window.unboundedPreceding, 0)
    seen = left.unionByName(right).withColumn("_last", F.last("_x", ignorenulls=True).over(w)).where("_k = 1")
    return seen.select(*cols, F.when(invalid, F.col("_last")).otherwise(F.col("xid")).alias("resolved_xid"))


def concat_continuations(log: DataFrame, partition: Sequence[str], position: Sequence[str], flag: str = "csf", text: str = "sql_redo") -> DataFrame:
    """Statements whose text came in pieces: a row with the flag goes on in the next row of its partition."""
    w = Window.partitionBy(*partition).orderBy(*position)
    group = F.coalesce(F.sum(F.when(F.col(flag) == 0, 1).otherwise(0)).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    pieces = log.withColumn("_g", group).groupBy(*partition, "_g").agg(F.array_sort(F.collect_list(F.struct(*position, F.col(text).alias("_t")))).alias("_p"))
    return pieces.select(*partition, *(F.col("_p")[0][c].alias(c) for c in position), F.size("_p").alias("n_pieces"), F.array_join(F.col("_p._t"), "").alias(text))


def size_metrics(log: DataFrame, bytes_: Column, xid: str = "xid") -> DataFrame:
    return log.groupBy(xid).agg(F.count("*").alias("n_rows"), F.sum(bytes_).alias("n_bytes"), F.sum((F.col("op") == 1).cast("long")).alias("n_inserts"), F.sum((F.col("op") == 2).cast("long")).alias("n_deletes"), F.sum((F.col("op") == 3).cast("long")).alias("n_updates"))
