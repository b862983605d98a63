"""Row stitching: the pieces of one logical row change, spread over redo records, as one change.

A transaction's records are worked in log order in one group; the pieces are those of one
transaction, which a capture engine must hold anyway.  Pieces carry H(ead), F(irst), L(ast)
flags on the redo (``fb``) and supplemental (``sfb``) side.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame

HEAD, FIRST, LAST = 0x20, 0x08, 0x04

STITCHED = "xid string, seq int, op string, obj long, rollback boolean, row_id string, scn long, rba string, set map<int,string>, original map<int,string>, where map<int,string>, n_pieces int, complete boolean"

#: Opcode to row operation; the last two only end an update (fixed values).
OPERATION = {"11.2": "INSERT", "11.3": "DELETE", "11.5": "UPDATE", "11.6": "UPDATE", "11.8": "TAIL", "11.16": "TAIL", "10.2": "INSERT", "10.4": "DELETE", "10.18": "UPDATE", "10.30": "UPDATE", "10.35": "UPDATE"}


@dataclass
class _Row:
    """A logical row change in the making."""

    op: str
    pieces: list[dict] = field(default_factory=list)

    def count(self, flag: int) -> int:
        return sum(bool(p["fb"] & flag) + bool(p["ufb"] & flag) * (self.op == "UPDATE") for p in self.pieces)

    def complete(self) -> bool:
        first, *more = self.pieces
        if not more:
            sup = first["sfb"]
            if sup:
                return bool(sup & FIRST and sup & LAST) if self.op != "INSERT" else all(first["fb"] & x for x in (HEAD, FIRST, LAST)) or first["opcode"].startswith("10.")
            if self.op == "DELETE":
                return all(first["ufb"] & x for x in (HEAD, FIRST, LAST))
            if self.op == "UPDATE" and first["opcode"] != "11.6":
                return all(first[s] & x for s in ("fb", "ufb") for x in (FIRST, LAST))
            return all(first["fb"] & x for x in (HEAD, FIRST, LAST))
        if self.op in ("INSERT", "DELETE"):
            side = "fb" if self.op == "INSERT" else "ufb"
            return all(any(p[side] & x for p in self.pieces) for x in (HEAD, FIRST, LAST))
        if any(p["sfb"] for p in self.pieces) or len({p["opcode"] for p in self.pieces}) == 1 or first["opcode"].startswith("10."):
            return self.count(FIRST) > 0 and self.count(LAST) > 0
        return self.count(FIRST) > 1 and self.count(LAST) > 1

    def emit(self) -> dict:
        # the head piece may come first or last; columns follow the chain
        order = self.pieces if self.pieces[0]["fb"] & (HEAD | FIRST) or not self.pieces[-1]["fb"] & (HEAD | FIRST) else self.pieces[::-1]
        new: dict[int, str | None] = {}
        old: dict[int, str | None] = {}
        where: dict[int, str | None] = {}
        at_new = at_old = 0
        for p in order:
            if p["opcode"] in ("11.8", "11.16"):
                where.update(p["sup"])
                continue
            base_new, base_old = (p["offset"],) * 2 if p["offset"] is not None else (at_new, at_old)
            new.update({base_new + k: v for k, v in p["new"].items()})
            old.update({base_old + k: v for k, v in p["old"].items()})
            where.update(p["sup"])
            at_new, at_old = base_new + len(p["new"]), base_old + len(p["old"])
        if self.op == "UPDATE":
            where = old | where if any(p["opcode"] != "11.2" for p in order) else where
            if all(p["opcode"] in ("11.8", "11.16") for p in order):
                new, old = dict(where), dict(where)
        if self.op == "DELETE":
            old = old | where
        first = self.pieces[0]
        row_id = next((p["row_id"] for p in order if p["row_id"]), None)
        return {"op": self.op, "obj": first.get("obj"), "rollback": bool(first["rollback"]), "row_id": row_id, "scn": first["scn"], "rba": first["rba"], "set": new if self.op != "DELETE" else {}, "original": old if self.op != "INSERT" else {}, "where": where if self.op == "UPDATE" else {}, "n_pieces": len(self.pieces)}


def stitch(records: list[dict]) -> Iterator[dict]:
    """Row changes of one transaction's records in log order.

    Pieces of one table and class of operation join the innermost open row; a completed row
    waits until the rows around it are complete, so the order of the outer pieces holds.
    """
    open_: dict[tuple, list[_Row]] = defaultdict(list)
    waiting: list[tuple[_Row, bool]] = []

    def drain() -> Iterator[dict]:
        while waiting and waiting[0][1]:
            yield waiting.pop(0)[0].emit() | {"complete": True}

    for r in records:
        op = OPERATION.get(r["opcode"])
        if op is None:
            continue
        kind = "UPDATE" if op == "TAIL" else op
        # the supplemental operation, where there is one, tells which row a piece belongs to
        key = (r["rollback"], r.get("sup_op") or kind, r["data_obj"])
        stack = open_[key]
        begins = op != "TAIL" and (not stack or (r["fb"] == stack[-1].pieces[-1]["fb"] and r["sfb"] == stack[-1].pieces[-1]["sfb"] and bool(r["fb"] & FIRST)))
        if begins or not stack:
            row = _Row(key[1] if key[1] in ("INSERT", "UPDATE", "DELETE") else kind)
            stack.append(row)
            waiting.append((row, False))
        row = stack[-1]
        row.pieces.append(r)
        ended = op == "TAIL" and r["sfb"] & LAST
        if ended or row.complete():
            stack.pop()
            k = next(i for i, (x, _) in enumerate(waiting) if x is row)
            waiting[k] = (row, True)
            yield from drain()
    for row, done in waiting:
        yield row.emit() | {"complete": done}


def stitch_rows(records: DataFrame) -> DataFrame:
    """Row changes from records (xid, pos, opcode, rollback, data_obj, fb, ufb, sfb, sup_op, offset, new, old, sup, row_id, scn, rba)."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        rows = pdf.sort_values("pos").to_dict("records")
        for r in rows:
            for c in ("new", "old", "sup"):
                r[c] = dict(r[c]) if r[c] is not None else {}
            r["offset"] = None if pd.isna(r["offset"]) else int(r["offset"])
        out = [{"xid": pdf["xid"].iloc[0], "seq": k + 1} | x for k, x in enumerate(stitch(rows))]
        return pd.DataFrame(out, columns=[c.split()[0] for c in STITCHED.split(", ")])

    return records.groupBy("xid").applyInPandas(run, STITCHED)
