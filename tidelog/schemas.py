"""Operation codes and the shapes of the engine's tables."""

from __future__ import annotations

from pyspark.sql import types as t

#: Operation codes of a change log (fixed values).
INSERT, DELETE, UPDATE, DDL, COMMIT, LOB_LOCATOR, LOB_WRITE, LOB_TRIM = 1, 2, 3, 5, 7, 9, 10, 11
LOB_ERASE, ROLLBACK, XML_BEGIN, XML_WRITE, XML_END, UNSUPPORTED = 29, 36, 68, 70, 71, 255

#: SCN is BIGINT: an unsigned 64-bit number that stays below 2**63.
CHANGE_LOG = t.StructType([
    t.StructField("thread", t.IntegerType()), t.StructField("scn", t.LongType()), t.StructField("rs_id", t.StringType()), t.StructField("ssn", t.LongType()),
    t.StructField("xid", t.StringType()), t.StructField("op", t.IntegerType()), t.StructField("rollback", t.BooleanType()), t.StructField("con_id", t.IntegerType()),
    t.StructField("obj_id", t.LongType()), t.StructField("row_id", t.StringType()), t.StructField("ts", t.TimestampType()),
    t.StructField("before", t.MapType(t.StringType(), t.StringType())), t.StructField("after", t.MapType(t.StringType(), t.StringType())), t.StructField("sql_redo", t.StringType()),
])

TXN_END = "xid string, commit_scn bigint, is_rollback boolean, ts timestamp"

CATALOG = "obj_id bigint, con_id int, pdb string, owner string, table_name string, parent_obj_id bigint, version int, valid_from_scn bigint, columns array<struct<name: string, type: string, nullable: boolean, pk: boolean, default: string>>"
