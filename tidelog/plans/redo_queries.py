"""Queries of the binary and text decoders: values of the tables written in the database's forms, read back by the operators."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.functions import decoders as d
from tidelog.functions import sql_redo
from tidelog.operators import ddl, envelopes, filters, redo_rows, snapshots, stitching, transactions
from tidelog.operators import large_objects as lobs
from tidelog.plans.registry import query
from tidelog.sources import change_logs as src
from tidelog.sources import redo_writer as w

_RECORDS = "scn long, rba string, vectors array<struct<opcode: string, class: int, fields: array<binary>>>"
_COLUMNS = [(1, "SUPPKEY", "NUMBER", False), (2, "NAME", "VARCHAR2(25)", True), (3, "NATION", "NUMBER(10)", True), (4, "BALANCE", "NUMBER(12,2)", True), (5, "NOTE", "VARCHAR2(100)", True)]


def supplier_redo(s: SparkSession, sf_dir: str) -> DataFrame:
    """A log of suppliers: by key modulo 3 an insert in two pieces, an update of the balance, a delete; by nation one transaction, each fifth of them rolled back."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for k, name, nation, cents in b.itertuples(index=False):
                xid, dba, n = (nation, 3, 70 + nation), (7 << 22) + k // 50, d.number_bytes
                values = [n(k), name.encode(), n(nation), n(cents) if cents is not None else None, None if k % 4 == 0 else f"note {k}".encode()]
                if k % 3 == 0:  # the tail of a row comes before its head
                    out.append(w.insert(xid, 900, dba + 1, k % 50, values[3:], 4, w.LAST))
                    out.append(w.insert(xid, 900, dba, k % 50, values[:3], 1, w.HEAD | w.FIRST))
                elif k % 3 == 1:
                    out.append(w.update(xid, 900, dba, k % 50, {4: values[3], 5: None}, {4: n(cents + 100), 5: values[4]}, {1: values[0]}))
                else:
                    out.append(w.delete(xid, 900, dba, k % 50, values))
                out[-1].append({"opcode": "11.10", "class": 1, "fields": [b"", b""]})
            yield pd.DataFrame({"vectors": out}).assign(scn=0, rba="")[["scn", "rba", "vectors"]]

    rows = src.read(s, sf_dir, "supplier").select(F.col("s_suppkey").cast("long"), "s_name", F.col("s_nationkey").cast("long"), F.round(F.col("s_acctbal") * 100).cast("long"))
    # places: both records of an insert in their order
    numbered = rows.mapInPandas(run, _RECORDS).withColumn("scn", F.monotonically_increasing_id())
    return numbered.withColumn("rba", F.format_string("0x000001.%08x.0010", "scn"))


def _supplier_rows(s: SparkSession, sf_dir: str) -> DataFrame:
    rows = stitching.stitch_rows(redo_rows.pieces(supplier_redo(s, sf_dir)))
    return redo_rows.decode(rows, s.createDataFrame([(900, _COLUMNS)], "obj_id long, columns array<struct<id: int, name: string, type: string, nullable: boolean>>"))


_SUPPLIERS = """select s_suppkey as k, s_suppkey % 3 as kind, s_name, s_nationkey, cast(round(s_acctbal * 100) as bigint) as cents, case when s_suppkey % 4 <> 0 then 'note ' || s_suppkey end as note from supplier"""


@query("redo_insert", f"select cast(k as varchar) as k, s_name, cast(s_nationkey as varchar) as nation, cast(cents as varchar) as cents, note, s_nationkey || '.3.' || (70 + s_nationkey) as xid, 2 as n_pieces, true as complete from ({_SUPPLIERS}) where kind = 0")
def redo_insert(s: SparkSession, sf_dir: str) -> DataFrame:
    """Inserts of two pieces each, tail first: undo and row vectors, stitched, decoded by the catalog."""
    r = _supplier_rows(s, sf_dir).where("op = 'INSERT'")
    return r.select(F.col("set.SUPPKEY").alias("k"), F.col("set.NAME").alias("s_name"), F.col("set.NATION").alias("nation"), F.col("set.BALANCE").alias("cents"), F.col("set.NOTE").alias("note"), "xid", "n_pieces", "complete")


@query("redo_update", f"select cast(k as varchar) as k, cast(cents + 100 as varchar) as new_cents, cast(cents as varchar) as old_cents, note as new_note, cast(null as varchar) as old_note, 2 as n_set from ({_SUPPLIERS}) where kind = 1")
def redo_update(s: SparkSession, sf_dir: str) -> DataFrame:
    r = _supplier_rows(s, sf_dir).where("op = 'UPDATE'")
    return r.select(F.col("where.SUPPKEY").alias("k"), F.col("set.BALANCE").alias("new_cents"), F.col("original.BALANCE").alias("old_cents"), F.col("set.NOTE").alias("new_note"), F.col("original.NOTE").alias("old_note"), F.size("set").alias("n_set"))


@query("redo_delete", f"""select cast(k as varchar) as k, s_name, note, 'AAAAOEAAHAA' || substr('ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/', cast(k // 50 // 262144 % 64 + 1 as int), 1) || substr('ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/', cast(k // 50 // 4096 % 64 + 1 as int), 1)
 || substr('ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/', cast(k // 50 // 64 % 64 + 1 as int), 1) || substr('ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/', cast(k // 50 % 64 + 1 as int), 1) || 'AA' || substr('ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/', cast(k % 50 + 1 as int), 1) as row_id from ({_SUPPLIERS}) where kind = 2""")  # fmt: skip
def redo_delete(s: SparkSession, sf_dir: str) -> DataFrame:
    r = _supplier_rows(s, sf_dir).where("op = 'DELETE'")
    return r.select(F.col("original.SUPPKEY").alias("k"), F.col("original.NAME").alias("s_name"), F.col("original.NOTE").alias("note"), "row_id")


@query("redo_ends", "select n_nationkey || '.3.' || (70 + n_nationkey) as xid, 1000 + n_nationkey as commit_scn, n_nationkey % 5 = 0 as is_rollback, case when n_nationkey % 2 = 0 then 1700000000 + n_nationkey end as time from nation")
def redo_ends(s: SparkSession, sf_dir: str) -> DataFrame:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            keys = [int(k) for k in b["n_nationkey"]]
            yield pd.DataFrame({"scn": [1000 + k for k in keys], "rba": "", "vectors": [w.end((k, 3, 70 + k), k % 5 == 0, 1_700_000_000 + k if k % 2 == 0 else None) for k in keys]})

    out = redo_rows.ends(src.read(s, sf_dir, "nation").select("n_nationkey").mapInPandas(run, _RECORDS))
    return out.withColumns({"commit_scn": F.col("commit_scn").cast(src.read(s, sf_dir, "nation").schema["n_nationkey"].dataType), "time": F.col("time").cast(src.read(s, sf_dir, "nation").schema["n_nationkey"].dataType)})


@query("redo_committed", f"select case kind when 0 then 'INSERT' when 1 then 'UPDATE' else 'DELETE' end as op, s_nationkey || '.3.' || (70 + s_nationkey) as xid, count(*) as n from ({_SUPPLIERS}) where s_nationkey % 5 <> 0 group by all")
def redo_committed(s: SparkSession, sf_dir: str) -> DataFrame:
    """Row changes of the log joined with its transaction ends."""
    done = redo_ends(s, sf_dir).select("xid", "commit_scn", "is_rollback")
    return transactions.committed(_supplier_rows(s, sf_dir), done).groupBy("op", "xid").agg(F.count("*").alias("n"))


@query("number_decode", "select l_orderkey, l_linenumber, cast(l_extendedprice as decimal(20,2)) as price, cast(-l_discount as decimal(20,2)) as less from lineitem")
def number_decode(s: SparkSession, sf_dir: str) -> DataFrame:
    """NUMBER bytes to decimals of a fixed scale."""
    native = d.udf_of_values(d.number_bytes, "binary")
    read = d.udf(lambda b: d.number(b), "decimal(20,2)")
    rows = src.read(s, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", native(F.col("l_extendedprice").cast("decimal(20,2)")).alias("p"), native((-F.col("l_discount")).cast("decimal(20,2)")).alias("q"))
    return rows.select("l_orderkey", "l_linenumber", read("p").alias("price"), read("q").alias("less"))


def _byte(c: F.Column) -> F.Column:
    return F.unhex(F.lpad(F.hex(c.cast("long")), 2, "0"))


@query("date_decode", "select o_orderkey, epoch_us(cast(o_orderdate as timestamp)) as us from orders")
def date_decode(s: SparkSession, sf_dir: str) -> DataFrame:
    """DATE bytes to timestamps, in the JVM."""
    o = F.col("o_orderdate").cast("timestamp")
    native = F.concat(_byte(F.floor(F.year(o) / 100) + 100), _byte(F.year(o) % 100 + 100), _byte(F.month(o)), _byte(F.dayofmonth(o)), _byte(F.hour(o) + 1), _byte(F.minute(o) + 1), _byte(F.second(o) + 1))
    at = src.read(s, sf_dir, "orders").select("o_orderkey", native.alias("b")).select("o_orderkey", d.ora_date(F.col("b")).alias("t"))
    return at.select("o_orderkey", F.unix_micros(F.col("t").cast("timestamp")).alias("us"))


@query("float_decode", "select ps_key, v, -v as w from (select p_partkey as ps_key, cast(p_retailprice as double) as v from part)")
def float_decode(s: SparkSession, sf_dir: str) -> DataFrame:
    """BINARY_DOUBLE bytes, whose sign bit is turned, both signs."""

    def native(x: float) -> bytes:
        import struct

        b = struct.pack(">d", x)
        return bytes(c ^ 0xFF for c in b) if b[0] & 0x80 else bytes([b[0] | 0x80]) + b[1:]

    write, read = d.udf_of_values(native, "binary"), d.udf(d.binary_double, "double")
    v = F.col("p_retailprice").cast("double")
    rows = src.read(s, sf_dir, "part").select(F.col("p_partkey").alias("ps_key"), write(v).alias("a"), write(-v).alias("b"))
    return rows.select("ps_key", read("a").alias("v"), read("b").alias("w"))


@query("sql_redo_insert", "select c_custkey, c_name || '''s, \"x\" = 1 where' || chr(10) || 'two' as name, cast(c_acctbal as varchar) as bal, cast(null as varchar) as none from customer")
def sql_redo_insert(s: SparkSession, sf_dir: str) -> DataFrame:
    text = F.concat(F.lit('insert into "O"."T"("NAME","BAL","NONE") values (\''), F.col("c_name"), F.lit("''s, \"x\" = 1 where\ntwo',"), F.col("c_acctbal").cast("string"), F.lit(",NULL);"))
    m = src.read(s, sf_dir, "customer").select("c_custkey", text.alias("sql_redo")).select("c_custkey", sql_redo.insert_values().alias("m"))
    return m.select("c_custkey", F.col("m.NAME").alias("name"), F.col("m.BAL").alias("bal"), F.col("m.NONE").alias("none"))


@query("sql_redo_update", "select c_custkey, 'a where \"K\" = ' || c_name as new_name, 'TO_DATE(''2024-01-01'', ''YYYY-MM-DD'')' as new_at, cast(c_custkey as varchar) as k, c_name || chr(10) || ' set ' as old_name, cast(null as varchar) as old_at from customer")
def sql_redo_update(s: SparkSession, sf_dir: str) -> DataFrame:
    text = F.concat(
        F.lit('update "O"."T" set "NAME" = \'a where "K" = '), F.col("c_name"), F.lit("', \"AT\" = TO_DATE('2024-01-01', 'YYYY-MM-DD') where \"K\" = '"), F.col("c_custkey").cast("string"),
        F.lit("' and \"NAME\" = '"), F.col("c_name"), F.lit("\n set ' and \"AT\" IS NULL and ROWID = 'AAA'"),
    )
    rows = src.read(s, sf_dir, "customer").select("c_custkey", text.alias("sql_redo")).select("c_custkey", sql_redo.set_values().alias("n"), sql_redo.where_values().alias("o"))
    return rows.select("c_custkey", F.col("n.NAME").alias("new_name"), F.col("n.AT").alias("new_at"), F.col("o.K").alias("k"), F.col("o.NAME").alias("old_name"), F.col("o.AT").alias("old_at"))


@query("redo_opcodes", "select event_id, case event_id % 5 when 0 then '11.2' when 1 then '11.4' when 2 then '11.10' when 3 then '11.22' else '11.5' end as opcode from events where event_id % 5 in (0, 4) or (event_id % 5 = 1 and user_id % 2 = 0)")
def redo_opcodes(s: SparkSession, sf_dir: str) -> DataFrame:
    """Row locks stay only with supplemental data; cluster links go."""
    op = F.element_at(F.array(*(F.lit(x) for x in ("11.2", "11.4", "11.10", "11.22", "11.5"))), (F.col("event_id") % 5 + 1).cast("int"))
    log = src.read(s, sf_dir, "events").select("event_id", op.alias("opcode"), (F.col("user_id") % 2 == 0).alias("eligible"))
    return log.where(filters.row_changes(eligible_lock="eligible")).select("event_id", "opcode")


@query("iot_not_empty", "select event_id from events where event_id % 3 <> 0 or user_id % 2 <> 0")
def iot_not_empty(s: SparkSession, sf_dir: str) -> DataFrame:
    log = src.read(s, sf_dir, "events").select("event_id", (F.col("event_id") % 3).alias("fb"), (F.col("user_id") % 2).alias("ufb"))
    return log.where(filters.index_change_not_empty(["fb", "ufb"])).select("event_id")


@query("snapshot_envelope", "select o_orderkey as k, case when o_orderkey % 3 <> 0 then o_totalprice end as price, o_orderkey % 3 = 0 as gone from orders")
def snapshot_envelope(s: SparkSession, sf_dir: str) -> DataFrame:
    o = src.read(s, sf_dir, "orders").select("o_orderkey", "o_totalprice", F.when(F.col("o_orderkey") % 3 == 0, "d").otherwise("u").alias("op"))
    e = envelopes.snapshot_event(o, ["o_orderkey"], ["o_totalprice"], F.col("op"))
    return e.select(F.col("before.o_orderkey").alias("k"), F.col("after.o_totalprice").alias("price"), F.col("after").isNull().alias("gone"))


@query("lob_bytes", "select l_orderkey as k, count(*) as n_chunks, string_agg(l_linenumber || ':' || l_partkey || ';', '' order by l_linenumber, l_linenumber || ':' || l_partkey || ';') as value from lineitem where l_orderkey % 2 = 0 group by 1")
def lob_bytes(s: SparkSession, sf_dir: str) -> DataFrame:
    """Binary chunks in order."""
    c = src.read(s, sf_dir, "lineitem").where("l_orderkey % 2 = 0").select(F.col("l_orderkey").alias("k"), F.col("l_linenumber").alias("chunk_no"), F.concat("l_linenumber", F.lit(":"), "l_partkey", F.lit(";")).cast("binary").alias("bytes"))
    return lobs.assemble_bytes(c, ["k"]).select("k", F.col("n_chunks").cast("long").alias("n_chunks"), F.col("value").cast("string").alias("value"))


@query("lob_inflate", "select o_orderkey as k, o_orderpriority || o_orderdate as value from orders")
def lob_inflate(s: SparkSession, sf_dir: str) -> DataFrame:
    """Compressed objects, cut into two chunks."""
    deflate = d.udf_of_values(lambda t: zlib.compress(t.encode()), "binary")
    z = src.read(s, sf_dir, "orders").select(F.col("o_orderkey").alias("k"), deflate(F.concat("o_orderpriority", F.col("o_orderdate").cast("string"))).alias("z"))
    c = z.select("k", F.posexplode(F.array(F.substring("z", 1, 9), F.expr("substring(z, 10)"))).alias("chunk_no", "bytes"))
    return lobs.assemble_bytes(c, ["k"], compressed=F.lit(True)).select("k", F.col("value").cast("string").alias("value"))


@query("lob_attach", "select o_orderkey, o_orderkey % 3 <> 0 as present, case when o_orderkey % 3 <> 0 then o_orderpriority end as value from orders")
def lob_attach(s: SparkSession, sf_dir: str) -> DataFrame:
    o = src.read(s, sf_dir, "orders").select("o_orderkey", "o_orderpriority")
    got = lobs.attach(o, o.where("o_orderkey % 3 <> 0").select("o_orderkey", F.col("o_orderpriority").alias("value")), ["o_orderkey"], "doc")
    return got.select("o_orderkey", F.col("doc").isNotNull().alias("present"), F.col("doc.V").alias("value"))


@query("alter_text", """select n_nationkey, case n_nationkey % 4 when 0 then 'add%%' || n_name || ' number(10|2);b date' when 1 then 'modify%%' || n_name || ' varchar2(' || n_nationkey || ')'
 when 2 then 'rename%%' || n_name || ';x%%alter table o.t rename column ' || n_name || ' to x' end as normal from (select n_nationkey, replace(n_name, ' ', '_') as n_name from nation)""")  # fmt: skip
def alter_text(s: SparkSession, sf_dir: str) -> DataFrame:
    """ALTER TABLE texts to their normal line; what changes no column gives NULL."""
    name = F.replace(F.col("n_name"), F.lit(" "), F.lit("_"))
    kind = F.col("n_nationkey") % 4
    text = F.when(kind == 0, F.concat(F.lit("alter table \"O\" . t  add ("), name, F.lit(" number(10, 2), b date)"))).when(kind == 1, F.concat(F.lit("ALTER TABLE t modify "), name, F.lit(" varchar2("), F.col("n_nationkey").cast("string"), F.lit(")")))
    text = text.when(kind == 2, F.concat(F.lit("alter table o.t rename column "), name, F.lit(" to x"))).otherwise(F.lit("alter table t add constraint c check (a > 0)"))
    normal = d.udf_of_values(lambda t: a.normal() if (a := ddl.parse_alter(t)) is not None else None, "string")
    return src.read(s, sf_dir, "nation").select("n_nationkey", normal(text).alias("normal"))


@query("canonical_names", "select n_nationkey, case when n_nationkey % 2 = 0 then n_name else upper(n_name) end as name from nation")
def canonical_names(s: SparkSession, sf_dir: str) -> DataFrame:
    written = F.when(F.col("n_nationkey") % 2 == 0, F.concat(F.lit(' "'), "n_name", F.lit('"'))).otherwise(F.concat(F.lower("n_name"), F.lit(" ")))
    return src.read(s, sf_dir, "nation").select("n_nationkey", sql_redo.canonical_name(written).alias("name"))


@query("file_names", "select r_regionkey, case when r_regionkey % 2 = 0 then '/arch/' || r_name || '/1.arc' else 'C:\\logs\\' || r_name || '.arc' end as name from region")
def file_names(s: SparkSession, sf_dir: str) -> DataFrame:
    """Names under an old prefix move to the new one, with its separators."""
    name = F.when(F.col("r_regionkey") % 2 == 0, F.concat(F.lit("D:\\redo\\"), "r_name", F.lit("\\1.arc"))).otherwise(F.concat(F.lit("C:\\logs\\"), "r_name", F.lit(".arc")))
    return src.read(s, sf_dir, "region").select("r_regionkey", sql_redo.convert_file_name(name, {"D:\\redo\\": "/arch/"}).alias("name"))


@query("next_logs_online", "select thread, min(sequence) as sequence, min(sequence) > 200 as online from (select l_linenumber as thread, l_partkey as sequence from lineitem where l_partkey between 150 and 250 and l_suppkey > 5) group by 1")
def next_logs_online(s: SparkSession, sf_dir: str) -> DataFrame:
    """The next log of each thread, from archived or, where there is none, online logs."""
    logs = src.read(s, sf_dir, "lineitem").select(F.col("l_linenumber").alias("thread"), F.col("l_partkey").alias("sequence"), F.col("l_suppkey").alias("next_scn"))
    got = snapshots.next_logs(logs.where("sequence between 150 and 200"), 150, 5, logs.where("sequence between 201 and 250"))
    return got.select("thread", "sequence", (F.col("sequence") > 200).alias("online"))
