"""Row vectors from values: what a database writes for a row change, for replays and round trips."""

from __future__ import annotations

import struct
from collections.abc import Mapping, Sequence

HEAD, FIRST, LAST = 0x20, 0x08, 0x04
Vector = dict[str, object]


def _vector(opcode: str, fields: Sequence[bytes], cls: int = 1) -> Vector:
    return {"opcode": opcode, "class": cls, "fields": list(fields)}


def _nulls(values: Sequence[bytes | None]) -> bytes:
    out = bytearray((len(values) + 7) // 8)
    for k, v in enumerate(values):
        out[k // 8] |= (v is None) << k % 8
    return bytes(out)


def _row(op: int, dba: int, slot: int, values: Sequence[bytes | None], fb: int, columns: Sequence[int] = ()) -> list[bytes]:
    """The operation element and the columns' elements."""
    head = bytearray(0x30 + len(values) // 8)
    struct.pack_into("<I", head, 0, dba)
    head[10], head[0x10] = op, fb
    if op == 5:
        struct.pack_into("<H", head, 0x14, slot)
        head[0x17] = len(values)
        head[0x1A : 0x1A + len(_nulls(values))] = _nulls(values)
        return [bytes(head), struct.pack(f"<{len(columns)}H", *columns), *(v or b"" for v in values)]
    if op == 2:
        head[0x12] = len(values)
        struct.pack_into("<HH", head, 0x28, 0xFFFF, slot)
        head[0x2D : 0x2D + len(_nulls(values))] = _nulls(values)
        return [bytes(head), *(v or b"" for v in values)]
    struct.pack_into("<H", head, 0x10, slot)
    return [bytes(head[:0x14])]


def _undo(xid: tuple[int, int, int], obj: int, row: Sequence[bytes], kind: int, fb: int, at: int, dba: int, slot: int, key: Mapping[int, bytes]) -> Vector:
    ktudb = struct.pack("<8xHHI4x", *xid)
    ktub = struct.pack("<II8xBBHHH", obj, obj, 11, 1, 0, 0, 0)
    sup = struct.pack("<BBHHHH10xIH2x", kind, fb, len(key), obj & 0xFFFF, at, at, dba, slot)
    more = [struct.pack(f"<{len(key)}H", *key), struct.pack(f"<{len(key)}H", *map(len, key.values())), *key.values()] if key else []
    return _vector("5.1", [ktudb, ktub, bytes(8), *row, sup, *more])


def insert(xid: tuple[int, int, int], obj: int, dba: int, slot: int, values: Sequence[bytes | None], first: int = 1, fb: int = HEAD | FIRST | LAST) -> list[Vector]:
    """A record that adds a row piece whose columns start at number ``first``."""
    return [_undo(xid, obj, _row(3, dba, slot, (), 0), 2, fb & (FIRST | LAST), first, dba, slot, {}), _vector("11.2", [bytes(8), *_row(2, dba, slot, values, fb)])]


def update(xid: tuple[int, int, int], obj: int, dba: int, slot: int, old: Mapping[int, bytes | None], new: Mapping[int, bytes | None], key: Mapping[int, bytes]) -> list[Vector]:
    """A record that sets columns (numbers from 1 on); ``key`` are the supplemental columns."""
    both, columns = FIRST | LAST, [c - 1 for c in new]
    undo = _undo(xid, obj, _row(5, dba, slot, [old[c] for c in new], both, columns), 1, both, min(new), dba, slot, key)
    return [undo, _vector("11.5", [bytes(8), *_row(5, dba, slot, list(new.values()), both, columns)])]


def delete(xid: tuple[int, int, int], obj: int, dba: int, slot: int, values: Sequence[bytes | None]) -> list[Vector]:
    """A record that takes a whole row away."""
    whole = HEAD | FIRST | LAST
    return [_undo(xid, obj, _row(2, dba, slot, values, whole), 4, FIRST | LAST, 1, dba, slot, {}), _vector("11.3", [bytes(8), *_row(3, dba, slot, (), 0)])]


def end(xid: tuple[int, int, int], rollback: bool = False, time: int | None = None) -> list[Vector]:
    """A record that commits or rolls back; its vector's class names the undo segment."""
    head = struct.pack("<HHI8xB3x", xid[1], 0, xid[2], 4 * rollback)
    return [_vector("5.4", [head, *([struct.pack("<I", time)] if time is not None else [])], 15 + 2 * xid[0])]
