"""Queries over the given tables, one an operator, and the same in SQL, by name."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidelog.operators import apply as ap
from tidelog.operators import ddl, envelopes, filters, projections, snapshots, transactions, transforms
from tidelog.operators import large_objects as lobs
from tidelog.plans import redo_queries as redo_queries  # registers its queries
from tidelog.plans.registry import ORACLES as ORACLES
from tidelog.plans.registry import QUERIES as QUERIES
from tidelog.plans.registry import query
from tidelog.sources import change_logs as src
from tidelog.sources.change_logs import CUSTOMER_TABLES, EVENT_LOG, LINE_LOG, ORDER_ENDS

#: The stack rule of rollback records, over the event log.
_CANCEL = f"""with log as ({EVENT_LOG}),
d as (select *, sum(case when rollback then -1 else 1 end) over (partition by xid, row_id order by scn rows between unbounded preceding and current row) as d from log),
m as (select *, min(d) over (partition by xid, row_id order by scn rows between 1 following and unbounded following) as later,
 min(d) over (partition by xid, row_id order by scn rows between unbounded preceding and 1 preceding) as earlier from d),
k as (select *, not rollback and coalesce(later >= d, true) as kept, rollback and d < least(0, coalesce(earlier, 0)) as unpaired from m)"""


@query("committed_changes", f"with l as ({LINE_LOG}), e as ({ORDER_ENDS}) select xid, ssn, op, l_partkey, commit_scn from l join e using (xid) where not is_rollback")
def committed_changes(s: SparkSession, d: str) -> DataFrame:
    return transactions.committed(src.line_log(s, d), src.order_ends(s, d)).select("xid", "ssn", "op", "l_partkey", "commit_scn")


@query("rollback_cancel", _CANCEL + " select scn, xid, row_id, op, kept, unpaired from k")
def rollback_cancel(s: SparkSession, d: str) -> DataFrame:
    return transactions.cancel_rollbacks(src.event_log(s, d), ["scn"]).select("scn", "xid", "row_id", "op", "kept", "unpaired")


@query("suspicious_txn", _CANCEL + """ select xid, count(*) as n_statements, cast(sum(cast(unpaired as bigint)) as bigint) as n_unpaired, arg_min(rollback, scn) as starts_with_rollback,
 sum(cast(unpaired as bigint)) > 0 or arg_min(rollback, scn) as suspicious from k group by xid""")  # fmt: skip
def suspicious_txn(s: SparkSession, d: str) -> DataFrame:
    return transactions.suspicious(src.event_log(s, d), ["scn"])


@query("commit_order", f"""with l as ({LINE_LOG}), e as ({ORDER_ENDS}) select xid, commit_scn, ssn, row_number() over (partition by xid order by ssn) as seq
 from l join e using (xid) where not is_rollback""")  # fmt: skip
def commit_order(s: SparkSession, d: str) -> DataFrame:
    seq = transactions.in_transaction_order(src.line_log(s, d), ["ssn"])
    done = transactions.committed(seq, src.order_ends(s, d)).withColumn("seq", F.col("seq").cast("long"))
    return transactions.commit_order(done.select("xid", "commit_scn", "ssn", "seq"))


@query("open_txn_low_water", f"""with l as ({LINE_LOG}), e as ({ORDER_ENDS}), o as (select xid, min(l_shipdate) as start, count(*) as n from l where xid not in (select xid from e) group by xid)
 select xid, epoch_us(start) as start_us, n as n_statements, start = (select min(start) from o) as is_low_water from o""")  # fmt: skip
def open_txn_low_water(s: SparkSession, d: str) -> DataFrame:
    out = transactions.low_water(src.read(s, d, "lineitem").select(F.col("l_orderkey").alias("xid"), "l_shipdate"), src.order_ends(s, d), ["l_shipdate"])
    return out.select("xid", F.unix_micros(F.col("start.l_shipdate").cast("timestamp")).alias("start_us"), "n_statements", "is_low_water")


_INCLUDE = ["BUILDING.*", "automobile.T1%", '"MACHINERY".t7']


@query("include_list", f"select obj_id, owner, table_name from ({CUSTOMER_TABLES}) where owner = 'BUILDING' or (owner = 'AUTOMOBILE' and table_name like 'T1%') or (owner = 'MACHINERY' and table_name = 'T7')")
def include_list(s: SparkSession, d: str) -> DataFrame:
    return src.customer_tables(s, d).where(filters.table_list(_INCLUDE)).select("obj_id", "owner", "table_name")


@query("exclude_list", f"select obj_id, owner, table_name from ({CUSTOMER_TABLES}) where not (owner = 'BUILDING' or (owner = 'AUTOMOBILE' and table_name like 'T1%') or (owner = 'MACHINERY' and table_name = 'T7'))")
def exclude_list(s: SparkSession, d: str) -> DataFrame:
    return src.customer_tables(s, d).where(filters.in_scope([], _INCLUDE)).select("obj_id", "owner", "table_name")


@query("object_scope", "select o_orderkey, o_custkey, o_totalprice from orders where o_custkey in (select c_custkey from customer where c_mktsegment = 'BUILDING')")
def object_scope(s: SparkSession, d: str) -> DataFrame:
    objects = src.read(s, d, "customer").where("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").alias("o_custkey"))
    return filters.object_scope(src.read(s, d, "orders").select("o_orderkey", "o_custkey", "o_totalprice"), objects, "o_custkey")


@query("container_filter", f"select obj_id, con_id from ({CUSTOMER_TABLES}) where con_id in (1, 3)")
def container_filter(s: SparkSession, d: str) -> DataFrame:
    return src.customer_tables(s, d).where(filters.containers([1, 3])).select("obj_id", "con_id")


_OLD = f"select *, lag(event_type) over w as old_type, lag(props) over w as old_props, lag(value) over w as old_value from ({EVENT_LOG}) window w as (partition by xid, row_id order by scn)"


def _with_old(s: SparkSession, d: str) -> DataFrame:
    w = Window.partitionBy("xid", "row_id").orderBy("scn")
    return src.event_log(s, d).withColumns({"old_type": F.lag("event_type").over(w), "old_props": F.lag("props").over(w), "old_value": F.lag("value").over(w)})


@query("noop_update", f"select scn, xid, op, event_type, old_type from ({_OLD}) where op <> 3 or event_type is distinct from old_type")
def noop_update(s: SparkSession, d: str) -> DataFrame:
    return filters.no_noop_updates(_with_old(s, d), ["old_type"], ["event_type"]).select("scn", "xid", "op", "event_type", "old_type")


@query("keyless_delete", f"select scn, xid, op from ({EVENT_LOG}) where not (op = 2 and row_id = 0)")
def keyless_delete(s: SparkSession, d: str) -> DataFrame:
    return filters.no_keyless_deletes(src.event_log(s, d), F.col("row_id") != 0).select("scn", "xid", "op")


@query("mandatory_check", f"select scn, old_type is not null and old_props is not null as complete from ({_OLD})")
def mandatory_check(s: SparkSession, d: str) -> DataFrame:
    return _with_old(s, d).select("scn", filters.complete(["old_type", "old_props"]).alias("complete"))


@query("restart_position", f"select xid, ssn, l_partkey from ({LINE_LOG}) where (xid, ssn) > (1000, 2)")
def restart_position(s: SparkSession, d: str) -> DataFrame:
    pruned = src.line_log(s, d).where("xid >= 1000")
    return pruned.where(filters.after_position(["xid", "ssn"], [1000, 2])).select("xid", "ssn", "l_partkey")


@query("restart_committed", f"select xid, commit_scn from ({ORDER_ENDS}) where commit_scn > 852076800000000")
def restart_committed(s: SparkSession, d: str) -> DataFrame:
    return src.order_ends(s, d).where(filters.not_committed_before("commit_scn", 852076800000000)).select("xid", "commit_scn")


@query("csf_concat", f"""with l as (select scn, xid, props, case when event_type = 'view' then 1 else 0 end as csf from ({EVENT_LOG})),
 g as (select *, coalesce(sum(case when csf = 0 then 1 else 0 end) over (partition by xid order by scn rows between unbounded preceding and 1 preceding), 0) as g from l)
 select xid, min(scn) as scn, cast(count(*) as integer) as n_pieces, string_agg(props, '' order by scn) as sql_redo from g group by xid, g""")  # fmt: skip
def csf_concat(s: SparkSession, d: str) -> DataFrame:
    log = src.event_log(s, d).select("scn", "xid", F.col("props").alias("sql_redo"), (F.col("event_type") == "view").cast("int").alias("csf"))
    return transactions.concat_continuations(log, ["xid"], ["scn"])


@query("full_after_image", f"select scn, case when value > 50 then event_type else old_type end as event_type, props from ({_OLD}) where op = 3")
def full_after_image(s: SparkSession, d: str) -> DataFrame:
    rows = _with_old(s, d).where("op = 3").select("scn", F.col("event_type").alias("n_event_type"), (F.col("value") > 50).alias("n_event_type__set"), F.col("old_type").alias("o_event_type"), F.col("props").alias("n_props"), F.lit(True).alias("n_props__set"), F.col("old_props").alias("o_props"))
    return rows.select("scn", *projections.after_image(["event_type", "props"], "o_", "n_"))


@query("after_map", f"select scn, coalesce(event_type, old_type) as t, old_props as p from ({_OLD}) where op = 3 and old_type is not null")
def after_map(s: SparkSession, d: str) -> DataFrame:
    rows = _with_old(s, d).where("op = 3 and old_type is not null").select("scn", F.create_map(F.lit("t"), "old_type", F.lit("p"), "old_props").alias("b"), F.create_map(F.lit("t"), "event_type").alias("a"))
    return rows.withColumn("m", projections.after_map("b", "a")).select("scn", F.col("m")["t"].alias("t"), F.col("m")["p"].alias("p"))


@query("before_image", f"select scn, case when old_type is not null then old_type else event_type end as event_type, props from ({_OLD}) where op = 3")
def before_image(s: SparkSession, d: str) -> DataFrame:
    rows = _with_old(s, d).where("op = 3").select("scn", F.col("event_type").alias("n_event_type"), F.col("old_type").isNotNull().alias("o_event_type__set"), F.col("old_type").alias("o_event_type"), F.col("props").alias("n_props"), F.lit(False).alias("o_props__set"), F.col("old_props").alias("o_props"))
    return rows.select("scn", *projections.before_image(["event_type", "props"], "o_", "n_"))


@query("default_subst", f"select scn, coalesce(old_type, 'none') as old_type, coalesce(old_value, -1.5) as old_value from ({_OLD})")
def default_subst(s: SparkSession, d: str) -> DataFrame:
    return _with_old(s, d).withColumns(projections.with_defaults({"old_type": F.lit("none"), "old_value": F.lit(-1.5)})).select("scn", "old_type", "old_value")


@query("decode_or_null", "select event_id, try_cast(substr(props, 7, 2) as integer) as n, cast(event_id as integer) as id from events")
def decode_or_null(s: SparkSession, d: str) -> DataFrame:
    e = src.read(s, d, "events").select("event_id", F.substring("props", 7, 2).alias("t"))
    return e.select("event_id", projections.decoded("t", "int", True).alias("n"), projections.decoded("event_id", "int", False).alias("id"))


@query("pseudo_columns", f"""with l as ({LINE_LOG}), e as ({ORDER_ENDS}) select xid as txn, ssn as rowscn, commit_scn as ora_commit, case op when 1 then 'INSERT' when 2 then 'DELETE' else 'UPDATE' end as ora_op
 from l join e using (xid) where not is_rollback""")  # fmt: skip
def pseudo_columns(s: SparkSession, d: str) -> DataFrame:
    rows = transactions.committed(src.line_log(s, d), src.order_ends(s, d)).withColumnRenamed("ssn", "scn")
    return rows.select(*(c.alias(n) for n, c in projections.pseudo_columns({"xid": "txn", "rowscn": "rowscn", "commitscn": "ora_commit", "operation": "ora_op"}).items()))


@query("source_struct", f"select scn, 'ORCL' as instance_name, cast(xid as varchar) as xid, cast(row_id as varchar) as row_id, epoch_us(ts) // 1000 as ts_ms, cast(null as varchar) as query from ({EVENT_LOG})")
def source_struct(s: SparkSession, d: str) -> DataFrame:
    have = {"instance_name": F.lit("ORCL"), "xid": F.col("xid").cast("string"), "scn": F.col("scn"), "row_id": F.col("row_id").cast("string"), "ts_ms": F.unix_millis(F.col("ts").cast("timestamp"))}
    return src.event_log(s, d).select(projections.source_struct(have).alias("source")).select("source.scn", "source.instance_name", "source.xid", "source.row_id", "source.ts_ms", "source.query")


_B64 = "'ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/'"


def _sql64(v: str, n: int) -> str:
    return " || ".join(f"substr({_B64}, cast(({v} // {64**k}) % 64 + 1 as integer), 1)" for k in range(n - 1, -1, -1))


@query("rowid_text", f"select l_orderkey, l_linenumber, l_partkey, {_sql64('l_suppkey', 6)} || {_sql64('l_linenumber', 3)} || {_sql64('l_orderkey', 6)} || {_sql64('(l_partkey % 1000)', 3)} as row_id from lineitem")
def rowid_text(s: SparkSession, d: str) -> DataFrame:
    line = src.read(s, d, "lineitem")
    return line.select("l_orderkey", "l_linenumber", "l_partkey", projections.rowid_text(F.col("l_suppkey"), F.col("l_linenumber").cast("long"), F.col("l_orderkey"), F.col("l_partkey") % 1000).alias("row_id"))


@query("pseudo_sql", f"""select scn, case op when 1 then 'insert into "UNKNOWN"."OBJ# ' || xid || '"("COL 1", "COL 2") values (''' || event_type || ''', ' || coalesce('''' || old_type || '''', 'NULL') || ')'
 when 2 then 'delete from "UNKNOWN"."OBJ# ' || xid || '" where ROWID = ''' || row_id || ''''
 else 'update "UNKNOWN"."OBJ# ' || xid || '" set "COL 1" = ''' || event_type || ''', "COL 2" = ' || coalesce('''' || old_type || '''', 'NULL') || ' where ROWID = ''' || row_id || '''' end as sql_redo from ({_OLD})""")  # fmt: skip
def pseudo_sql(s: SparkSession, d: str) -> DataFrame:
    return _with_old(s, d).select("scn", projections.pseudo_sql("op", "xid", ["event_type", "old_type"], "row_id").alias("sql_redo"))


@query("dump_row", f"select scn || '|' || xid || '|' || op || '|' || coalesce(old_type, '') as line from ({_OLD})")
def dump_row(s: SparkSession, d: str) -> DataFrame:
    return _with_old(s, d).select(projections.dump_row(["scn", "xid", "op", "old_type"]).alias("line"))


@query("partition_remap", "select s_suppkey as obj_id, coalesce(n_nationkey, s_suppkey) as table_obj_id from supplier left join (select * from nation where n_regionkey < 3) on s_nationkey = n_nationkey")
def partition_remap(s: SparkSession, d: str) -> DataFrame:
    parents = src.read(s, d, "supplier").join(src.read(s, d, "nation").where("n_regionkey < 3"), F.col("s_nationkey") == F.col("n_nationkey")).select(F.col("s_suppkey").alias("obj_id"), F.col("n_nationkey").cast("long").alias("parent_obj_id"))
    return projections.remap_objects(src.read(s, d, "supplier").select(F.col("s_suppkey").alias("obj_id")), parents)


@query("combined_id", f"select obj_id, (cast(con_id as bigint) << 32) | obj_id as combined from ({CUSTOMER_TABLES})")
def combined_id(s: SparkSession, d: str) -> DataFrame:
    return src.customer_tables(s, d).select("obj_id", projections.combined_id(F.col("con_id"), F.col("obj_id")).alias("combined"))


@query("delete_projection", f"select scn, case when op <> 2 then event_type end as value from ({EVENT_LOG})")
def delete_projection(s: SparkSession, d: str) -> DataFrame:
    return src.event_log(s, d).select("scn", projections.deleted_value("op", F.col("event_type")).alias("value"))


@query("partial_xid_join", f"""with l as ({EVENT_LOG}), st as (select scn as start_scn, xid, xid % 16 as prefix from l where op = 1)
 select l.scn, case when l.op = 2 then (select arg_max(st.xid, (st.start_scn, st.xid)) from st where st.prefix = l.xid % 16 and st.start_scn <= l.scn) else l.xid end as resolved_xid from l""")  # fmt: skip
def partial_xid_join(s: SparkSession, d: str) -> DataFrame:
    log = src.event_log(s, d)
    begun = log.where("op = 1").select(F.col("scn").alias("start_scn"), "xid", (F.col("xid") % 16).alias("prefix"))
    return transactions.resolve_partial_xids(log.select("scn", "xid", "op"), begun, F.col("xid") % 16, F.col("op") == 2).select("scn", "resolved_xid")


@query("pk_picker", """with i as (select l_orderkey as table_id, l_returnflag || l_linestatus as index_name, l_tax > 0.06 as nullable, l_returnflag = 'A' as is_pk from lineitem),
 p as (select table_id, index_name, bool_or(is_pk) as is_pk, count(*) as n_columns, bool_or(nullable) as any_nullable from i group by all),
 r as (select *, row_number() over (partition by table_id order by not is_pk, n_columns, index_name) as r from p where is_pk or not any_nullable)
 select o_orderkey as table_id, index_name, n_columns from orders left join r on o_orderkey = table_id and r = 1""")  # fmt: skip
def pk_picker(s: SparkSession, d: str) -> DataFrame:
    idx = src.read(s, d, "lineitem").select(F.col("l_orderkey").alias("table_id"), F.concat("l_returnflag", "l_linestatus").alias("index_name"), F.lit("c").alias("column_name"), (F.col("l_tax") > 0.06).alias("nullable"), (F.col("l_returnflag") == "A").alias("is_pk"))
    return ddl.pick_key(src.read(s, d, "orders").select(F.col("o_orderkey").alias("table_id")), idx)


_OP = "case op when 1 then 'c' when 2 then 'd' else 'u' end"


@query("envelope_kafka", _CANCEL + f""" , last as (select xid, max(scn) as commit_scn from k group by xid)
 select k.xid, commit_scn, scn, row_id as key_row_id, case when op <> 2 then event_type end as value_event_type, case when op <> 2 then value end as value_value, {_OP} as op from k join last using (xid) where kept""")  # fmt: skip
def envelope_kafka(s: SparkSession, d: str) -> DataFrame:
    """Committed changes, partial rollbacks cancelled, as keyed events in commit order."""
    log = src.event_log(s, d)
    ends = log.groupBy("xid").agg(F.max("scn").alias("commit_scn")).withColumn("is_rollback", F.lit(False))
    rows = transactions.committed(transactions.survivors(log, ["scn"]), ends)
    events = envelopes.kafka_event(rows, ["row_id"], ["event_type", "value"], carry=["xid", "commit_scn", "scn"])
    flat = events.select("xid", "commit_scn", "scn", F.col("key.row_id").alias("key_row_id"), F.col("value.event_type").alias("value_event_type"), F.col("value.value").alias("value_value"), "op")
    return transactions.commit_order(flat, ["scn"])


@query("envelope_single", f"select scn, row_id, event_type, {_OP} as op from ({EVENT_LOG}) where op <> 2")
def envelope_single(s: SparkSession, d: str) -> DataFrame:
    return envelopes.single_event(src.event_log(s, d), ["row_id", "event_type"], carry=["scn"]).select("scn", "value.row_id", "value.event_type", "op")


@query("envelope_debezium", f"""select scn, row_id as key_row_id, case when op <> 1 then old_type end as before_type, case when op <> 2 then event_type end as after_type, 'EV' as source_table, {_OP} as op,
 epoch_us(ts) // 1000 as ts_ms, epoch_us(ts) // 1000 * 1000000 as ts_ns from ({_OLD})""")  # fmt: skip
def envelope_debezium(s: SparkSession, d: str) -> DataFrame:
    ms = F.unix_millis(F.col("ts").cast("timestamp"))
    out = envelopes.debezium_event(_with_old(s, d), ["row_id"], F.struct(F.col("old_type").alias("t")), F.struct(F.col("event_type").alias("t")), F.struct(F.lit("EV").alias("table")), ms, carry=["scn"])
    return out.select("scn", F.col("key.row_id").alias("key_row_id"), F.col("before.t").alias("before_type"), F.col("after.t").alias("after_type"), F.col("source.table").alias("source_table"), "op", "ts_ms", "ts_ns")


@query("envelope_wrapped", f"select scn, old_type is not null or op = 1 as present, old_type as v from ({_OLD})")
def envelope_wrapped(s: SparkSession, d: str) -> DataFrame:
    rows = _with_old(s, d).select("scn", *envelopes.wrapped(["old_type"], {"old_type": F.col("old_type").isNotNull() | (F.col("op") == 1)}))
    return rows.select("scn", F.col("old_type").isNotNull().alias("present"), F.col("old_type.V").alias("v"))


@query("envelope_map", f"select scn, {_OP} as op, event_type as c1, old_type as c2 from ({_OLD})")
def envelope_map(s: SparkSession, d: str) -> DataFrame:
    rows = _with_old(s, d).select("scn", *envelopes.map_event(["event_type", "old_type"], envelopes.op_letter()))
    return rows.select("scn", "op", F.col("value")[1].alias("c1"), F.col("value")[2].alias("c2"))


@query("topic_name", f"select obj_id, 'p_' || pdb || '-' || regexp_replace(owner || '$', '[^a-zA-Z0-9._\\-]', 'zZ', 'g') || '-' || table_name as topic, 'x' || table_name as short from ({CUSTOMER_TABLES})")
def topic_name(s: SparkSession, d: str) -> DataFrame:
    t = src.customer_tables(s, d).withColumn("owner", F.concat("owner", F.lit("$")))
    return t.select("obj_id", envelopes.topic_name("PDB_SCHEMA_TABLE", "p_", "-").alias("topic"), envelopes.topic_name("TABLE", "x").alias("short"))


@query("topic_map", f"select obj_id, case when owner = 'BUILDING' and table_name in ('T1', 'T2') then 'hot-' || table_name else table_name end as topic from ({CUSTOMER_TABLES})")
def topic_map(s: SparkSession, d: str) -> DataFrame:
    topics = s.createDataFrame([("BUILDING.T1", "hot-T1"), ("BUILDING.T2", "hot-T2")], "fqn string, topic string")
    rows = src.customer_tables(s, d).withColumn("fqn", F.concat_ws(".", "owner", "table_name"))
    return envelopes.mapped_topic(rows, topics, envelopes.topic_name("TABLE")).select("obj_id", "topic")


@query("schema_name", f"select obj_id, pdb || ':' || owner || '.' || table_name || '.Value' as name, pdb || '_' || owner || '_' || table_name || '_Key' as proto, regexp_replace(regexp_replace(c_name, '[^A-Za-z0-9_]', '_', 'g'), '^([0-9])', '_\\1') as field from ({CUSTOMER_TABLES})")
def schema_name(s: SparkSession, d: str) -> DataFrame:
    return src.customer_tables(s, d).select("obj_id", envelopes.schema_name("Value").alias("name"), envelopes.schema_name("Key", protobuf=True).alias("proto"), envelopes.field_name(F.col("c_name")).alias("field"))


@query("partition_choice", f"select obj_id, con_id - 1 as p from ({CUSTOMER_TABLES})")
def partition_choice(s: SparkSession, d: str) -> DataFrame:
    return src.customer_tables(s, d).select("obj_id", envelopes.partition_of_thread("con_id").alias("p"))


@query("snapshot_log_join", """with l as (select event_id as seq, user_id as c_custkey, case event_type when 'signup' then 'I' when 'purchase' then 'D' else 'U' end as code from events)
 select seq, l.c_custkey, case code when 'I' then 'c' when 'U' then 'u' else 'd' end as op, case when code <> 'D' then c_name end as name from l left join (select * from customer where c_nationkey < 20) c on l.c_custkey = c.c_custkey where code = 'D' or c.c_custkey is not null""")  # fmt: skip
def snapshot_log_join(s: SparkSession, d: str) -> DataFrame:
    code = F.when(F.col("event_type") == "signup", "I").when(F.col("event_type") == "purchase", "D").otherwise("U")
    log = src.read(s, d, "events").select(F.col("event_id").alias("seq"), F.col("user_id").alias("c_custkey"), code.alias("dmltype"))
    out = snapshots.with_master(log, src.read(s, d, "customer").where("c_nationkey < 20").select("c_custkey", "c_name"), ["c_custkey"])
    return out.select("seq", "c_custkey", "op", F.when(F.col("op") != "d", F.col("c_name")).alias("name"))


@query("snapshot_poll", "select event_id as sequence, user_id from events where event_id > 100 order by event_id limit 1000")
def snapshot_poll(s: SparkSession, d: str) -> DataFrame:
    return snapshots.poll(src.read(s, d, "events").select(F.col("event_id").alias("sequence"), "user_id"), 100, 1000)


_DELTA = "with ev as (select o_custkey as c_custkey, o_orderkey as pos, case o_orderstatus when 'P' then 'd' when 'F' then 'u' else 'c' end as op, 'N' || o_orderkey as c_name, o_totalprice as c_acctbal from orders)"


def _delta(s: SparkSession, d: str) -> DataFrame:
    op = F.when(F.col("o_orderstatus") == "P", "d").when(F.col("o_orderstatus") == "F", "u").otherwise("c")
    return src.read(s, d, "orders").select(F.col("o_custkey").alias("c_custkey"), F.col("o_orderkey").alias("pos"), op.alias("op"), F.concat(F.lit("N"), F.col("o_orderkey").cast("string")).alias("c_name"), F.col("o_totalprice").alias("c_acctbal"))


def _base(s: SparkSession, d: str) -> DataFrame:
    return src.read(s, d, "customer").select("c_custkey", "c_name", "c_acctbal")


@query("apply_upsert", _DELTA + """, l as (select *, row_number() over (partition by c_custkey order by pos desc) as r from ev)
 select c_custkey, c_name, c_acctbal from customer where c_custkey not in (select c_custkey from ev) union all select c_custkey, c_name, c_acctbal from l where r = 1 and op <> 'd'""")  # fmt: skip
def apply_upsert(s: SparkSession, d: str) -> DataFrame:
    return ap.upsert(_base(s, d), _delta(s, d), ["c_custkey"], ["pos"])


@query("apply_audit", _DELTA + " select c_custkey, c_name, c_acctbal from customer union all select c_custkey, c_name, c_acctbal from ev")
def apply_audit(s: SparkSession, d: str) -> DataFrame:
    return ap.audit(_base(s, d), _delta(s, d))


@query("dedup_in_batch", _DELTA + " select c_custkey, max(pos) as pos, arg_max(op, pos) as op from ev group by c_custkey")
def dedup_in_batch(s: SparkSession, d: str) -> DataFrame:
    return ap.last_per_key(_delta(s, d), ["c_custkey"], ["pos"]).select("c_custkey", "pos", "op")


@query("apply_partial_update", _DELTA + """, x as (select *, max(case when op = 'd' then pos end) over (partition by c_custkey) as del from ev), y as (select * from x where del is null or pos >= del),
 f as (select c_custkey, arg_max(op, pos) as op, max(case when op = 'd' then 1 else 0 end) as fresh, max(case when op <> 'd' and pos % 2 = 0 then pos end) as pn, max(case when op <> 'd' and pos % 3 <> 0 then pos end) as pa,
  arg_max(c_name, case when op <> 'd' and pos % 2 = 0 then pos end) as nm, arg_max(case when c_acctbal > 100000 then c_acctbal end, case when op <> 'd' and pos % 3 <> 0 then pos end) as ac0 from y group by c_custkey),
 g as (select f.*, (select case when e.c_acctbal > 100000 then e.c_acctbal end from ev e where e.pos = f.pa) as ac from f)
 select coalesce(b.c_custkey, g.c_custkey) as c_custkey, case when pn is not null then nm when coalesce(fresh, 0) = 0 then b.c_name end as c_name, case when pa is not null then ac when coalesce(fresh, 0) = 0 then b.c_acctbal end as c_acctbal
 from customer b full join g on b.c_custkey = g.c_custkey where g.op is null or g.op <> 'd'""")  # fmt: skip
def apply_partial_update(s: SparkSession, d: str) -> DataFrame:
    live = F.col("op") != "d"
    ev = _delta(s, d).select("c_custkey", "pos", "op", F.when(live & (F.col("pos") % 2 == 0), F.struct(F.col("c_name").alias("V"))).alias("c_name"), F.when(live & (F.col("pos") % 3 != 0), F.struct(F.when(F.col("c_acctbal") > 100000, F.col("c_acctbal")).alias("V"))).alias("c_acctbal"))
    return ap.partial_update(_base(s, d), ev, ["c_custkey"], ["pos"], ["c_name", "c_acctbal"])


@query("op_detect", "select event_id, coalesce(case when event_type = 'signup' then 'c' when event_type = 'view' then 'r' end, case when value > 50 then 'u' end, 'c') as op from events")
def op_detect(s: SparkSession, d: str) -> DataFrame:
    e = src.read(s, d, "events").select("event_id", F.when(F.col("event_type") == "signup", "c").when(F.col("event_type") == "view", "r").alias("eop"), F.when(F.col("value") > 50, "u").alias("hop"))
    return e.select("event_id", ap.event_op("eop", "hop").alias("op"))


@query("schema_evolution", "select n_nationkey as k, n_name as name, cast(null as varchar) as r_name from nation union all select r_regionkey, null, r_name from region")
def schema_evolution(s: SparkSession, d: str) -> DataFrame:
    base = src.read(s, d, "nation").select(F.col("n_nationkey").alias("k"), F.col("n_name").alias("name"))
    new = src.read(s, d, "region").select(F.col("r_regionkey").alias("k"), "r_name")
    return ap.evolve(base, new)[0].unionByName(new, allowMissingColumns=True)


@query("table_name_map", f"select obj_id, 'pre_' || table_name || '_suf' as a, table_name as b from ({CUSTOMER_TABLES})")
def table_name_map(s: SparkSession, d: str) -> DataFrame:
    t = src.customer_tables(s, d)
    return t.select("obj_id", ap.table_of_topic(F.concat(F.lit("top-"), "table_name"), "top-", "pre_", "_suf").alias("a"), ap.table_of_schema(F.concat_ws(".", "owner", "table_name", F.lit("Value"))).alias("b"))


@query("lob_update", "select s_suppkey, case when o_orderkey is not null and o_orderkey % 2 = 0 then o_orderpriority else s_name end as s_name from supplier left join orders on s_suppkey = o_orderkey")
def lob_update(s: SparkSession, d: str) -> DataFrame:
    delta = src.read(s, d, "orders").select(F.col("o_orderkey").alias("s_suppkey"), F.when(F.col("o_orderkey") % 2 == 0, F.struct(F.col("o_orderpriority").alias("V"))).alias("s_name"))
    return ap.lob_values(src.read(s, d, "supplier").select("s_suppkey", "s_name"), delta, ["s_suppkey"], ["s_name"])


@query("unnest_struct", "select p_partkey, p_brand, p_size from part")
def unnest_struct(s: SparkSession, d: str) -> DataFrame:
    return ap.unnest(src.read(s, d, "part").select("p_partkey", F.struct("p_brand", "p_size").alias("x")), "x")


@query("minus_infinity", "select event_id, case when value < 10 then null else value end as a, case when value < 10 then -1.0 else value end as b from events")
def minus_infinity(s: SparkSession, d: str) -> DataFrame:
    v = F.when(F.col("value") < 10, F.lit(float("-inf"))).otherwise(F.col("value"))
    return src.read(s, d, "events").select("event_id", ap.finite_or_null(v, True, 0.0).alias("a"), ap.finite_or_null(v, False, -1.0).alias("b"))


@query("ddl_asof_version", f"""with l as ({EVENT_LOG}), v as (select scn, row_id, row_number() over (partition by row_id order by scn) as version from l where op = 1)
 select l.scn, l.row_id, cast((select max(version) from v where v.row_id = l.row_id and v.scn <= l.scn) as integer) as version from l""")  # fmt: skip
def ddl_asof_version(s: SparkSession, d: str) -> DataFrame:
    log = src.event_log(s, d).select("scn", "row_id", "op")
    versions = log.where("op = 1").select(F.col("scn").alias("valid_from_scn"), "row_id", F.row_number().over(Window.partitionBy("row_id").orderBy("scn")).alias("version"))
    return ddl.version_as_of(log.select("scn", "row_id"), versions, "row_id")


@query("header_to_field", "select event_id, case event_type when 'view' then 'V' when 'click' then 'C' else event_type end as f from events")
def header_to_field(s: SparkSession, d: str) -> DataFrame:
    return src.read(s, d, "events").select("event_id", transforms.header_to_field(F.col("event_type"), {"view": "V", "click": "C"}).alias("f"))


@query("key_to_value", "select o_orderkey, o_totalprice, o_orderstatus from orders")
def key_to_value(s: SparkSession, d: str) -> DataFrame:
    e = src.read(s, d, "orders").select(F.struct("o_orderkey", "o_custkey").alias("key"), F.struct("o_totalprice", "o_orderstatus").alias("value"))
    return transforms.key_to_value(e, ["o_orderkey"]).select("value.*")


@query("lower_names", "select n_nationkey, n_name from nation")
def lower_names(s: SparkSession, d: str) -> DataFrame:
    n = src.read(s, d, "nation")
    return transforms.lower_names(n.select(F.col("n_nationkey").alias("N_NATIONKEY"), F.col("n_name").alias("N_NAME")))


@query("number_convert", "select l_orderkey, l_linenumber, l_partkey, cast(l_quantity as bigint) as l_quantity, l_extendedprice from lineitem")
def number_convert(s: SparkSession, d: str) -> DataFrame:
    line = src.read(s, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice")
    return transforms.convert_numbers(line, "%quantity", "long")


@query("number_map", "select c_custkey, cast(c_nationkey as smallint) as c_nationkey, cast(c_acctbal as float) as c_acctbal from customer")
def number_map(s: SparkSession, d: str) -> DataFrame:
    entries = {"TPCH.CUSTOMER.C_%": "smallint", "TPCH.CUSTOMER.C_ACCTBAL": "float", "PDB1.TPCH.CUSTOMER.C_CUSTKEY": "bigint"}
    c = src.read(s, d, "customer")
    return c.select(*(F.col(x).cast(transforms.number_map(entries, "PDB1", "TPCH", "CUSTOMER", x.upper())).alias(x) for x in ("c_custkey", "c_nationkey", "c_acctbal")))


@query("interval_iso", """select o_orderkey, case when m = 0 then 'P0M' else 'P' || case when m // 12 > 0 then (m // 12) || 'Y' else '' end || case when m % 12 > 0 then (m % 12) || 'M' else '' end end as ym,
 case when t = 0 then 'PT0S' else 'P' || case when t // 86400 > 0 then (t // 86400) || 'D' else '' end || case when t % 86400 > 0 then 'T' else '' end || case when t % 86400 // 3600 > 0 then (t % 86400 // 3600) || 'H' else '' end
  || case when t % 3600 // 60 > 0 then (t % 3600 // 60) || 'M' else '' end || case when t % 60 > 0 then (t % 60) || 'S' else '' end end as ds
 from (select o_orderkey, o_custkey % 100 as m, o_orderkey * 37 % 500000 as t from orders)""")  # fmt: skip
def interval_iso(s: SparkSession, d: str) -> DataFrame:
    return src.read(s, d, "orders").select("o_orderkey", transforms.iso_year_month(F.col("o_custkey") % 100).alias("ym"), transforms.iso_day_second(F.col("o_orderkey") * 37 % 500000).alias("ds"))


@query("lob_concat", f"select xid, cast(count(*) as integer) as n_chunks, string_agg(l_returnflag || l_linestatus || l_partkey, '' order by ssn) as value from ({LINE_LOG}) group by xid")
def lob_concat(s: SparkSession, d: str) -> DataFrame:
    chunks = src.line_log(s, d).select("xid", F.col("ssn").alias("chunk_no"), F.concat("l_returnflag", "l_linestatus", F.col("l_partkey").cast("string")).alias("bytes"))
    return lobs.assemble(chunks, ["xid"])


@query("lob_sessionise", f"""with l as (select *, last_value(case when op <> 3 then scn end ignore nulls) over (partition by xid order by scn rows between unbounded preceding and current row) as own from ({EVENT_LOG}))
 select xid, own as owner_scn, cast(count(*) as integer) as n_chunks, string_agg(props, '' order by scn) as value from l where op = 3 and own is not null group by xid, own""")  # fmt: skip
def lob_sessionise(s: SparkSession, d: str) -> DataFrame:
    log = src.event_log(s, d).select("xid", "scn", "op", F.col("props").alias("bytes"), F.col("scn").alias("chunk_no"))
    owned = lobs.chunks_by_statement(log, ["xid"], ["scn"], F.col("op") != 3, F.col("op") == 3).withColumn("owner_scn", F.col("owner.scn"))
    return lobs.assemble(owned, ["xid", "owner_scn"])


@query("txn_metrics", f"select xid, count(*) as n_rows, cast(sum(length(props)) as bigint) as n_bytes, count(*) filter (op = 1) as n_inserts, count(*) filter (op = 2) as n_deletes, count(*) filter (op = 3) as n_updates from ({EVENT_LOG}) group by xid")
def txn_metrics(s: SparkSession, d: str) -> DataFrame:
    return transactions.size_metrics(src.event_log(s, d), F.length("props"))


@query("lag_by_window", "select epoch_us(time_bucket(interval 1 hour, ts, timestamp '1970-01-01')) as hour_us, event_type, count(*) as n, max(event_id) as last_scn, epoch_us(max(ts)) - epoch_us(min(ts)) as span_us from events group by all")
def lag_by_window(s: SparkSession, d: str) -> DataFrame:
    micros = lambda c: F.unix_micros(c.cast("timestamp"))
    g = src.read(s, d, "events").groupBy(F.window(F.col("ts").cast("timestamp"), "1 hour").alias("w"), "event_type").agg(F.count("*").alias("n"), F.max("event_id").alias("last_scn"), (micros(F.max("ts")) - micros(F.min("ts"))).alias("span_us"))
    return g.select(micros(F.col("w.start")).alias("hour_us"), "event_type", "n", "last_scn", "span_us")


@query("initial_load_then_stream", "select c_custkey as k, c_name as name, 500 as scn, 'r' as op from customer union all select o_custkey, 'N' || o_orderkey, o_orderkey, 'u' from orders where o_orderkey > 500")
def initial_load_then_stream(s: SparkSession, d: str) -> DataFrame:
    load = src.read(s, d, "customer").select(F.col("c_custkey").alias("k"), F.col("c_name").alias("name"))
    changes = src.read(s, d, "orders").select(F.col("o_custkey").alias("k"), F.concat(F.lit("N"), F.col("o_orderkey").cast("string")).alias("name"), F.col("o_orderkey").alias("scn"), F.lit("u").alias("op"))
    return snapshots.load_then_stream(load, changes, F.lit(500).cast("long"), ["k", "name"])


@query("initial_load_chunks", "select cast(least(7, (o_orderkey - lo) // (((hi - lo + 1) + 7) // 8)) as integer) as chunk, count(*) as n from orders, (select min(o_orderkey) as lo, max(o_orderkey) as hi from orders) group by 1")
def initial_load_chunks(s: SparkSession, d: str) -> DataFrame:
    o = src.read(s, d, "orders")
    lo, hi = o.agg(F.min("o_orderkey"), F.max("o_orderkey")).first()
    preds = snapshots.chunk_predicates("o_orderkey", lo, hi, 8)
    number = F.coalesce(*(F.when(F.expr(p), F.lit(k)) for k, p in enumerate(preds)))
    return o.groupBy(number.alias("chunk")).agg(F.count("*").alias("n"))


@query("first_available_scn", "select min(o_orderkey) as first_available_scn from orders where o_orderstatus = 'F' or o_orderstatus = 'O'")
def first_available_scn(s: SparkSession, d: str) -> DataFrame:
    logs = src.read(s, d, "orders").select(F.col("o_orderkey").alias("first_scn"), "o_orderstatus")
    return snapshots.first_available_scn(logs.where("o_orderstatus = 'F'"), logs.where("o_orderstatus = 'O'"))


@query("next_logs", "select l_linenumber as thread, min(l_partkey) as sequence from lineitem where l_partkey >= 10 and l_suppkey > 5 group by 1")
def next_logs(s: SparkSession, d: str) -> DataFrame:
    logs = src.read(s, d, "lineitem").select(F.col("l_linenumber").alias("thread"), F.col("l_partkey").alias("sequence"), F.col("l_suppkey").alias("next_scn"))
    return snapshots.next_logs(logs, 10, 5).select("thread", "sequence")


@query("table_list", f"select owner, table_name, count(*) as n from ({CUSTOMER_TABLES}) where owner <> 'FURNITURE' and table_name not like 'T2%' group by all")
def table_list(s: SparkSession, d: str) -> DataFrame:
    t = src.customer_tables(s, d).withColumn("table_name", F.when(F.col("table_name").startswith("T2"), F.concat(F.lit("MLOG$_"), "table_name")).otherwise(F.col("table_name")))
    return t.where(filters.user_tables(system=["FURNITURE"])).groupBy("owner", "table_name").agg(F.count("*").alias("n"))


@query("guard_columns", "select p_partkey, p_partkey % 3 = 0 as guard from part")
def guard_columns(s: SparkSession, d: str) -> DataFrame:
    name = F.when(F.col("p_partkey") % 3 == 0, F.concat(F.when(F.col("p_partkey") % 2 == 0, "SYS_C").otherwise("SYS_NC"), F.col("p_partkey").cast("string"), F.lit("$"))).otherwise(F.col("p_brand"))
    return src.read(s, d, "part").select("p_partkey", ddl.is_guard_column(name).alias("guard"))


@query("array_rows", "select l_orderkey as xid, l_partkey, cast(l_linenumber as integer) as n from lineitem")
def array_rows(s: SparkSession, d: str) -> DataFrame:
    """Array inserts: one record with all rows of a transaction, to one statement a row."""
    packed = src.read(s, d, "lineitem").groupBy(F.col("l_orderkey").alias("xid")).agg(F.collect_list(F.struct("l_partkey", "l_linenumber")).alias("rows"))
    return packed.select("xid", F.posexplode("rows")).select("xid", "col.l_partkey", F.col("col.l_linenumber").cast("int").alias("n"))
