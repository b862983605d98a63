"""Connected components and size-checked broadcasts with DataFrame operations only.

Components use alternating large-star and small-star steps: in each, every node's smallest
neighbour comes from a group-by with partial aggregation, and goes back over the edges by an
equi-join, which adaptive execution can split where a node has very many edges.  Every round
is written to the shared folder, so a lost executor costs one round, and the rounds number
about the logarithm of the longest path.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.llm.common import drop_saved, saved

#: Rows of ids that may be broadcast: about 16 bytes each in memory.
BROADCAST_ROWS = 1_000_000


def small_side(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """df marked for broadcast if it has at most ``rows`` rows, else as it is."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One step over undirected edges (u, v); large: link larger neighbours to the least one, else the smaller ones."""
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    near = both if large else both.where("v < u")
    least = near.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    moved = near.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"), F.col("u").alias("_at"))
    if large:
        moved = moved.where("u > _at").select("u", "v")
    else:
        moved = moved.select("u", "v").unionByName(least.select("u", F.col("m").alias("v")))
    return moved.where("u <> v").distinct()


def _unsettled(edges: DataFrame) -> bool:
    """Is there a node with two smaller neighbours, or one with neighbours on both sides?"""
    two = edges.groupBy("u").count().where("count > 1").select("u").limit(1)
    return not two.unionByName(edges.select("u").join(edges.select(F.col("v").alias("u")), "u", "left_semi").limit(1)).isEmpty()


def components(edges: DataFrame, u: str = "u", v: str = "v") -> DataFrame:
    """(node, root) of every node with an edge; root is the least node of its component.

    Null ends and self-loops are ignored, repeated edges count once; no edges give no rows.
    """
    now = saved(edges.where(f"`{u}` <> `{v}`").select(F.greatest(u, v).alias("u"), F.least(u, v).alias("v")).distinct(), "edges")
    while _unsettled(now):
        after = saved(_star(_star(now, True), False), "edges")
        drop_saved(now.sparkSession, now)
        now = after
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
