"""Binary redo logs as a data source: header, record framing, and change vectors.

``spark.read.format("redo").option("path", glob)`` gives a row for each change vector; a file is
a partition, pruned by its header's SCN range before any task starts.  Layouts follow public
descriptions of the format; all numbers have the file's byte order.

Options: ``path`` (file, folder or glob), ``startscn`` (exclusive), ``endscn`` (inclusive),
``sequence`` (only this log), ``checksum`` (true: blocks with a wrong XOR sum fail the task),
``decode``: ``vectors``, or ``pieces`` for the row pieces that ``stitching.stitch_rows`` joins, or
``ends`` for commits and rollbacks.  Files must be mounted where the tasks run.
"""

from __future__ import annotations

import glob
import os
import struct
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from tidelog.functions.row_vectors import RedoError, end_of, row_records

#: Fixed places in the file header block (block 1) and the sizes of a block and record header.
BLOCK_HEADER = 16
_SEQUENCE, _VERSION, _SID, _DBID, _FILE_SIZE = 0x08, 0x14, 0x1C, 0x18, 0x28
_DESCRIPTION, _NAB, _THREAD, _FIRST_SCN, _FIRST_TIME, _NEXT_SCN, _NEXT_TIME = 0x5C, 0x9C, 0xB0, 0xB4, 0xBC, 0xC0, 0xC8
#: Block type letters of redo files by block size.
BLOCK_TYPE = {512: 0x22, 1024: 0x22, 4096: 0x82}
RECORD_SMALL, RECORD_LWN = 24, 68

SCHEMA = "thread int, sequence long, block long, offset int, scn long, sub_scn int, ts long, vector int, opcode string, class int, dba long, con_uid long, fields array<binary>"

_PLACE = "thread int, sequence long, rba string, pos string, scn long, sub_scn int, ts long, con_uid long"
#: Columns by the ``decode`` option.
SCHEMAS = {
    "vectors": SCHEMA,
    "pieces": f"{_PLACE}, xid string, rollback boolean, obj long, data_obj long, opcode string, fb int, ufb int, sfb int, sup_op string, offset int, new map<int,string>, old map<int,string>, sup map<int,string>, row_id string",
    "ends": f"{_PLACE}, xid string, rollback boolean, time long",
}
#: Size of a vector's header, up to version 11 and from 12 on, which adds the container.
VECTOR_HEADER, VECTOR_HEADER_12, FIRST_WITH_CONTAINERS = 0x18, 0x20, 12


@dataclass(frozen=True)
class Header:
    block_size: int
    little: bool
    sequence: int
    thread: int
    first_scn: int
    next_scn: int
    first_time: int
    next_time: int
    dbid: int
    version: str
    sid: str
    blocks: int

    @property
    def order(self) -> str:
        return "<" if self.little else ">"

    @property
    def containers(self) -> bool:
        return int(self.version.split(".")[0]) >= FIRST_WITH_CONTAINERS

    @property
    def vector_header(self) -> int:
        return VECTOR_HEADER_12 if self.containers else VECTOR_HEADER


def scn(b: bytes, at: int, order: str) -> int:
    """48 bits: base of four bytes, wrap of two; the high bit of the wrap tells a 64-bit number, whose top two bytes follow."""
    base, wrap = struct.unpack_from(order + "IH", b, at)
    if wrap == 0xFFFF and base == 0xFFFFFFFF:
        return 2**63 - 1
    if wrap & 0x8000:
        top = struct.unpack_from(order + "H", b, at + 6)[0]
        return base | (wrap & 0x7FFF) << 32 | top << 47
    return base | wrap << 32


def checksum(block: bytes, order: str) -> int:
    """XOR of all 16-bit words, the stored sum among them: 0 in a sound block."""
    out = 0
    for (x,) in struct.iter_unpack(order + "H", block):
        out ^= x
    return out


def read_header(data: bytes, check: bool = False) -> Header:
    """The header from the first two blocks."""
    size = next((s for s, kind in BLOCK_TYPE.items() if len(data) >= 2 * s and data[s] == 1 and data[s + 1] == kind), None)
    if size is None:
        raise RedoError("no redo block signature")
    b = data[size : 2 * size]
    # the magic number of block 0 is written in the byte order of the platform
    little = data[0x1C:0x20] == b"\x7d\x7c\x7b\x7a"
    o = "<" if little else ">"
    if check and checksum(b, o):
        raise RedoError("wrong checksum of block 1")
    u32 = lambda at: struct.unpack_from(o + "I", b, at)[0]
    v = u32(_VERSION)
    sid = b[_SID : _SID + 8].split(b"\0")[0].decode("ascii", "replace")
    return Header(size, little, u32(_SEQUENCE), struct.unpack_from(o + "H", b, _THREAD)[0], scn(b, _FIRST_SCN, o), scn(b, _NEXT_SCN, o), u32(_FIRST_TIME), u32(_NEXT_TIME), u32(_DBID), f"{v >> 24}.{v >> 20 & 15}.{v >> 12 & 255}.{v & 255}", sid, u32(_NAB))


def records(read, header: Header, check: bool = False) -> Iterator[tuple[int, int, bytes]]:
    """(block, offset, bytes) of each record; ``read(block)`` gives a block's bytes or nothing at the end.

    A record goes on behind the header of the next block; a block of another sequence is the
    tail of an online log that was written before, and ends the reading.
    """
    number, o = 2, header.order
    pending, want, at = bytearray(), 0, (0, 0)
    while True:
        block = read(number)
        if len(block) < header.block_size or block[0] != 1 or struct.unpack_from(o + "I", block, 8)[0] != header.sequence:
            return
        if check and checksum(block, o):
            raise RedoError(f"wrong checksum of block {number}")
        place = BLOCK_HEADER
        while place < header.block_size:
            if want:
                take = min(want, header.block_size - place)
                pending += block[place : place + take]
                want, place = want - take, place + take
                if not want:
                    yield (*at, bytes(pending))
                    place = (place + 3) & ~3
                continue
            if place + RECORD_SMALL > header.block_size:
                break
            size = struct.unpack_from(o + "I", block, place)[0]
            if not size:
                break
            pending, want, at = bytearray(), size, (number, place)
        number += 1


@dataclass(frozen=True)
class Vector:
    opcode: str
    cls: int
    dba: int
    fields: tuple[bytes, ...]


def vectors(record: bytes, order: str, header: int = VECTOR_HEADER_12) -> Iterator[Vector]:
    """The change vectors of a record: each a header, a list of field lengths, and the fields, padded to four bytes."""
    at = RECORD_LWN if record[4] & 0x04 else RECORD_SMALL
    while at + header + 2 <= len(record):
        layer, op, cls = struct.unpack_from(order + "BBH", record, at)
        dba = struct.unpack_from(order + "I", record, at + 8)[0]
        head = at + header
        n_bytes = struct.unpack_from(order + "H", record, head)[0]
        if n_bytes < 2:
            return
        lengths = struct.unpack_from(f"{order}{n_bytes // 2 - 1}H", record, head + 2)
        place = head + ((n_bytes + 3) & ~3)
        fields = []
        for n in lengths:
            fields.append(record[place : place + n])
            place += (n + 3) & ~3
        yield Vector(f"{layer}.{op}", cls, dba, tuple(fields))
        at = place


@dataclass
class _File(InputPartition):
    path: str

    def __init__(self, path: str):
        self.path = path


class RedoReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.options = options
        self.start, self.end = int(options.get("startscn", -1)), int(options.get("endscn", 2**63 - 1))
        self.check = options.get("checksum", "false").lower() == "true"
        self.decode = options.get("decode", "vectors").lower()

    def _header(self, path: str) -> Header:
        with open(path, "rb") as f:
            return read_header(f.read(8192), self.check)

    def partitions(self) -> list[_File]:
        path = self.options["path"]
        names = sorted(glob.glob(os.path.join(path, "*") if os.path.isdir(path) else path))
        out = []
        for n in names:
            h = self._header(n)
            if h.first_scn <= self.end and h.next_scn > self.start and int(self.options.get("sequence", h.sequence)) == h.sequence:
                out.append(_File(n))
        return out

    def read(self, partition: _File) -> Iterator[tuple]:
        header = self._header(partition.path)
        with open(partition.path, "rb") as f:

            def block(number: int) -> bytes:
                f.seek(number * header.block_size)
                return f.read(header.block_size)

            ts = header.first_time
            for number, offset, rec in records(block, header, self.check):
                o = header.order
                wrap, base, sub = struct.unpack_from(o + "HIH", rec, 6)
                at = base | wrap << 32
                if rec[4] & 0x04:
                    ts = struct.unpack_from(o + "I", rec, 64)[0]
                if not self.start < at <= self.end:
                    continue
                con = struct.unpack_from(o + "I", rec, 16)[0] if header.containers else None
                found = list(vectors(rec, o, header.vector_header))
                if self.decode == "vectors":
                    for k, v in enumerate(found):
                        yield (header.thread, header.sequence, number, offset, at, sub, ts, k, v.opcode, v.cls, v.dba, con, list(v.fields))
                    continue
                rba = f"0x{header.sequence:06x}.{number:08x}.{offset:04x}"
                if self.decode == "ends":
                    rows = [end_of(v.cls, v.fields, o) for v in found if v.opcode == "5.4"]
                else:
                    rows = list(row_records([(v.opcode, v.cls, v.fields) for v in found], o))
                names = [c.split()[0] for c in SCHEMAS[self.decode][len(_PLACE) + 2 :].split(", ")]
                for k, r in enumerate(rows):
                    yield (header.thread, header.sequence, rba, f"{at:020d}.{sub:05d}.{rba}.{k:05d}", at, sub, ts, con, *(r[c] for c in names))


class RedoSource(DataSource):
    """Redo log files, a row for each change vector, row piece or transaction end."""

    @classmethod
    def name(cls) -> str:
        return "redo"

    def schema(self) -> str:
        return SCHEMAS[self.options.get("decode", "vectors").lower()]

    def reader(self, schema) -> RedoReader:
        return RedoReader(self.options)
