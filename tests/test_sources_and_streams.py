"""The binary log source on files made here, and streams against batch."""

import struct

import pytest

from tidelog.functions.row_vectors import end_of, row_records
from tidelog.operators import apply, stitching
from tidelog.sources import redo
from tidelog.sources import redo_writer as w
from tidelog.streaming import assembler


def vector(layer, op, fields, cls=1):
    lengths = struct.pack(f"<{len(fields) + 1}H", 2 * (len(fields) + 1), *map(len, fields))
    pad = lambda b: b + bytes(-len(b) % 4)
    return struct.pack("<BBHIIIIIII", layer, op, cls, 0, 77, 0, 0, 0, 0, 0) + pad(lengths) + b"".join(map(pad, fields))


def log_file(path, sequence, recs, first=1, last=1000, size=512):
    """A little log: records of (scn, [vectors]) framed into blocks."""
    stream = bytearray()
    blocks, room = [], size - redo.BLOCK_HEADER
    for scn, vs in recs:
        body = b"".join(vs)
        rec = struct.pack("<IBBHIH", redo.RECORD_SMALL + len(body), 1, 0, 0, scn, 0).ljust(redo.RECORD_SMALL, b"\0") + body
        if room - len(stream) % room < redo.RECORD_SMALL:
            stream += bytes(room - len(stream) % room)
        stream += rec + bytes(-len(rec) % 4)
    stream += bytes(-len(stream) % room)
    head = bytearray(size)
    head[0:2] = bytes([1, 0x22])
    struct.pack_into("<I", head, 8, sequence)
    struct.pack_into("<I", head, 0x14, 0x13000000)
    head[0x1C:0x21] = b"ORCL\0"
    struct.pack_into("<H", head, 0xB0, 2)
    struct.pack_into("<IH", head, 0xB4, first, 0)
    struct.pack_into("<IH", head, 0xC0, last, 0)
    zero = bytearray(size)
    zero[0x1C:0x20] = b"\x7d\x7c\x7b\x7a"
    for k in range(0, len(stream), room):
        blocks.append(struct.pack("<BBHIIHH", 1, 0x22, 0, 2 + k // room, sequence, 0, 0) + bytes(stream[k : k + room]))
    for b in (head, *blocks):
        b = bytearray(b)
        struct.pack_into("<H", b, 14, redo.checksum(bytes(b), "<"))
        zero += b
    path.write_bytes(bytes(zero))


def test_redo_source(spark, tmp_path):
    commit = struct.pack("<HHI", 5, 0, 99).ljust(20, b"\0")
    recs = [(10, [vector(11, 2, [b"abc", b"x" * 700])]), (20, [vector(5, 1, [b"u"]), vector(11, 5, [b"de", b""])]), (30, [vector(5, 4, [commit])])]
    log_file(tmp_path / "a.arc", 7, recs, 1, 100)
    log_file(tmp_path / "b.arc", 8, recs, 100, 200)
    spark.dataSource.register(redo.RedoSource)
    read = spark.read.format("redo").option("path", str(tmp_path)).option("checksum", "true")
    rows = sorted(read.load().collect(), key=lambda r: (r.sequence, r.scn, r.vector))
    assert [(r.scn, r.opcode) for r in rows[:4]] == [(10, "11.2"), (20, "5.1"), (20, "11.5"), (30, "5.4")] and len(rows) == 8
    assert [bytes(x) for x in rows[0].fields] == [b"abc", b"x" * 700] and rows[0].thread == 2 and rows[0].block == 2
    assert end_of(rows[3]["class"], [bytes(x) for x in rows[3].fields], "<") == {"xid": "-1.5.99", "rollback": False, "time": None}
    some = read.option("startscn", "10").option("endscn", "20").load().collect()
    assert {(r.sequence, r.scn) for r in some} == {(7, 20)}


def test_redo_header_errors(tmp_path):
    with pytest.raises(redo.RedoError):
        redo.read_header(bytes(2048))
    log_file(tmp_path / "a.arc", 7, [])
    data = bytearray((tmp_path / "a.arc").read_bytes())
    h = redo.read_header(bytes(data), True)
    assert (h.sequence, h.sid, h.version, h.first_scn) == (7, "ORCL", "19.0.0.0", 1)
    data[600] ^= 1
    with pytest.raises(redo.RedoError):
        redo.read_header(bytes(data), True)


LOG = "xid long, scn long, row_id long, op int, rollback boolean, value double"


def test_stream_equals_batch(spark, tmp_path):
    rows = [(1, 1, 5, 1, False, 1.0), (2, 2, 6, 1, False, 2.0), (1, 3, 5, 3, False, 3.0), (1, 4, 5, 3, True, 0.0), (2, 5, 0, 36, False, 0.0), (3, 6, 1, 1, False, 9.0), (1, 7, 0, 7, False, 0.0), (3, 8, 1, 2, True, 0.0), (4, 9, 1, 1, False, 0.5)]
    for k in range(3):
        spark.createDataFrame(rows[3 * k : 3 * k + 3], LOG).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    out, ck = str(tmp_path / "out"), str(tmp_path / "ck")
    stream = spark.readStream.schema(LOG).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    q = assembler.assemble(stream).writeStream.format("parquet").option("path", out).option("checkpointLocation", ck).outputMode("append").trigger(availableNow=True).start()
    q.awaitTermination(120)
    got = spark.read.parquet(out).collect()
    assert [(r.xid, r.commit_scn, r.seq, r.scn, r.op, r.suspicious) for r in got] == [(1, 7, 1, 1, "c", False)]


def test_foreach_batch_apply(spark, tmp_path):
    schema = "k long, pos long, op string, v string"
    for part in ([(1, 1, "c", "a"), (2, 2, "c", "b")], [(1, 3, "u", "c"), (2, 4, "d", None), (2, 5, "c", "again"), (3, 6, "d", None)]):
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    assembler.apply_batches(stream, str(tmp_path / "t"), str(tmp_path / "ck"), ["k"], ["pos"]).start().awaitTermination(120)
    assert sorted((r.k, r.v) for r in spark.read.parquet(str(tmp_path / "t" / "v=1")).collect()) == [(1, "c"), (2, "again")]


def test_partial_update_of_wrapped_columns(spark):
    base = spark.createDataFrame([(1, "a", "x"), (2, "b", "y"), (3, "c", "z")], "k long, p string, q string")
    v = "struct<V: string>"
    ev = spark.createDataFrame([(1, 1, "u", ("n",), None), (1, 2, "u", None, (None,)), (2, 1, "d", None, None), (2, 2, "c", ("new",), None), (3, 1, "d", None, None), (4, 1, "c", ("i",), ("j",))], f"k long, pos long, op string, p {v}, q {v}")
    assert sorted(map(tuple, apply.partial_update(base, ev, ["k"], ["pos"], ["p", "q"]).collect())) == [(1, "n", None), (2, "new", None), (4, "i", "j")]


def raw(vs):
    """Vectors of the writer as bytes of a record."""
    return [vector(*map(int, v["opcode"].split(".")), v["fields"], v["class"]) for v in vs]


def test_row_pieces_and_ends_of_files(spark, tmp_path):
    xid, key = (4, 5, 6), b"\xc1\x02"
    recs = [(10, raw(w.insert(xid, 9, 3 << 22 | 8, 2, [key, b"one", None]))), (20, raw(w.update(xid, 9, 3 << 22 | 8, 2, {2: b"one"}, {2: b"two"}, {1: key}))), (30, raw(w.delete(xid, 9, 3 << 22 | 8, 2, [key, b"two", None]))), (40, raw(w.end(xid, time=99)))]
    log_file(tmp_path / "a.arc", 7, recs, 1, 100)
    spark.dataSource.register(redo.RedoSource)
    read = spark.read.format("redo").option("path", str(tmp_path)).option("checksum", "true")
    rows = sorted(stitching.stitch_rows(read.option("decode", "pieces").load()).collect(), key=lambda r: r.scn)
    assert [(r.op, r.scn, r.xid, r.row_id, r.complete) for r in rows] == [(op, scn, "4.5.6", "AAAAAJAADAAAAAIAAC", True) for op, scn in (("INSERT", 10), ("UPDATE", 20), ("DELETE", 30))]
    assert rows[0]["set"] == {1: "c102", 2: "6f6e65", 3: None} and rows[2]["original"] == {1: "c102", 2: "74776f", 3: None}
    assert (rows[1]["set"], rows[1]["original"], rows[1]["where"]) == ({2: "74776f"}, {2: "6f6e65"}, {1: "c102", 2: "6f6e65"})
    assert [(r.xid, r.rollback, r.time, r.scn) for r in read.option("decode", "ends").load().collect()] == [("4.5.6", False, 99, 40)]


def test_partial_rollback_and_arrays():
    two, undone = w.insert((1, 2, 3), 9, 8, 0, [b"a"])
    marker = {"opcode": "5.6", "class": 17, "fields": [struct.pack("<II8xBBBxHH", 9, 9, 11, 1, 2, 0, 0)]}
    got = list(row_records([(v["opcode"], v["class"], v["fields"]) for v in (undone, marker)]))
    assert [(g["xid"], g["rollback"], g["opcode"]) for g in got] == [("1.2", True, "11.2")]
    rows = b"\x2c\x00\x02\x01a\xff" + b"\x2c\x00\x01\xfe\x02\x00bc"
    head = struct.pack("<I6xBB6xB1xHH4x", 8, 11, 0, 2, 5, 6)
    got = list(row_records([(two["opcode"], 1, two["fields"]), ("11.11", 1, [b"", head, b"", rows])]))
    assert [(g["new"], g["row_id"][-3:]) for g in got] == [({1: "61", 2: None}, "AAF"), ({1: "6263"}, "AAG")]


def test_vector_headers_by_version():
    for header in (redo.VECTOR_HEADER, redo.VECTOR_HEADER_12):
        body = struct.pack("<BBHI", 11, 2, 1, 0).ljust(header, b"\0") + struct.pack("<HH", 4, 3) + b"abc\0"
        assert [(v.opcode, v.fields) for v in redo.vectors(bytes(24) + body, "<", header)] == [("11.2", (b"abc",))]
