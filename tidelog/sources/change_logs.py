"""Change logs, transaction ends and a catalog derived from the star-schema tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidelog.session import SETTINGS


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    for k, v in SETTINGS.items():
        spark.conf.set(k, v)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def event_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events as a log: user is the transaction, seven rows each; signup inserts, purchase deletes, error is a rollback record."""
    e = read(spark, sf_dir, "events")
    kind = F.col("event_type")
    return e.select(
        F.col("event_id").alias("scn"), F.col("user_id").alias("xid"), (F.col("event_id") % 7).alias("row_id"),
        F.when(kind == "signup", 1).when(kind == "purchase", 2).otherwise(3).alias("op"), (kind == "error").alias("rollback"),
        "ts", "value", "props", kind.alias("event_type"),
    )


EVENT_LOG = """select event_id as scn, user_id as xid, event_id % 7 as row_id, case event_type when 'signup' then 1 when 'purchase' then 2 else 3 end as op,
 event_type = 'error' as rollback, ts, value, props, event_type from events"""


def order_ends(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders as transaction ends: F commits, P rolls back, O stays open (no row)."""
    o = read(spark, sf_dir, "orders").where("o_orderstatus in ('F', 'P')")
    return o.select(F.col("o_orderkey").alias("xid"), F.unix_micros(F.col("o_orderdate").cast("timestamp")).alias("commit_scn"), (F.col("o_orderstatus") == "P").alias("is_rollback"))


ORDER_ENDS = "select o_orderkey as xid, epoch_us(o_orderdate) as commit_scn, o_orderstatus = 'P' as is_rollback from orders where o_orderstatus in ('F', 'P')"

_LINE = ("l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate")


def line_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem as statements of its order's transaction, numbered over all columns; R deletes, A updates, N inserts.

    The window is over the order, on which the join with the ends follows: one shuffle for both.
    """
    line = read(spark, sf_dir, "lineitem")
    ssn = F.row_number().over(Window.partitionBy("l_orderkey").orderBy(*_LINE)).cast("long")
    op = F.when(F.col("l_returnflag") == "R", 2).when(F.col("l_returnflag") == "A", 3).otherwise(1)
    return line.select(F.col("l_orderkey").alias("xid"), ssn.alias("ssn"), op.alias("op"), *(F.col(c) for c in _LINE))


LINE_LOG = f"""select l_orderkey as xid, row_number() over (partition by l_orderkey order by {", ".join(_LINE)}) as ssn,
 case l_returnflag when 'R' then 2 when 'A' then 3 else 1 end as op, {", ".join(_LINE)} from lineitem"""


def customer_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """customer as a dictionary: segment owns tables T<nation>; container is the nation modulo 4."""
    c = read(spark, sf_dir, "customer")
    return c.select(F.col("c_custkey").alias("obj_id"), (F.col("c_nationkey") % 4).alias("con_id"), F.concat(F.lit("PDB"), (F.col("c_nationkey") % 4).cast("string")).alias("pdb"), F.col("c_mktsegment").alias("owner"), F.concat(F.lit("T"), F.col("c_nationkey").cast("string")).alias("table_name"), "c_acctbal", "c_name")


CUSTOMER_TABLES = "select c_custkey as obj_id, c_nationkey % 4 as con_id, 'PDB' || (c_nationkey % 4) as pdb, c_mktsegment as owner, 'T' || c_nationkey as table_name, c_acctbal, c_name from customer"
