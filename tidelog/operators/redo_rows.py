"""Redo records in frames: their row pieces, and stitched rows decoded by the catalog."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from decimal import Decimal

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.functions import decoders as d
from tidelog.functions.row_vectors import end_of, row_records

PIECES = "xid string, pos string, scn long, rba string, rollback boolean, obj long, data_obj long, opcode string, fb int, ufb int, sfb int, sup_op string, offset int, new map<int,string>, old map<int,string>, sup map<int,string>, row_id string"
_NAMES = [c.split()[0] for c in PIECES.split(", ")]


def _vectors(row) -> list[tuple[str, int, list[bytes]]]:
    return [(v["opcode"], v["class"], [bytes(b) for b in v["fields"]]) for v in row]


def pieces(records: DataFrame, order: str = "<") -> DataFrame:
    """Row pieces of records (scn, rba, vectors array<struct<opcode, class, fields>>)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = [r | {"scn": scn, "rba": rba, "pos": f"{scn:020d}.{rba}.{k:05d}"} for scn, rba, vs in zip(b["scn"], b["rba"], b["vectors"], strict=True) for k, r in enumerate(row_records(_vectors(vs), order))]
            frame = pd.DataFrame(out, columns=_NAMES)
            yield frame.assign(offset=frame["offset"].astype("Int32"))

    return records.select("scn", "rba", "vectors").mapInPandas(run, PIECES)


def ends(records: DataFrame, order: str = "<") -> DataFrame:
    """(xid, commit_scn, is_rollback, time) of the transaction ends of records."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = [(e["xid"], scn, e["rollback"], e["time"]) for scn, vs in zip(b["scn"], b["vectors"], strict=True) for o, c, f in _vectors(vs) if o == "5.4" for e in [end_of(c, f, order)]]
            frame = pd.DataFrame(out, columns=["xid", "commit_scn", "is_rollback", "time"])
            yield frame.assign(time=frame["time"].astype("Int64"))

    return records.select("scn", "vectors").mapInPandas(run, "xid string, commit_scn long, is_rollback boolean, time long")


def _plain(x: Decimal | None) -> str | None:
    return None if x is None else format(x.normalize(), "f") if x.is_finite() else str(x)


def _decoder(kind: str) -> Callable[[bytes], str | None]:
    """Text of a column's bytes by its type; what has no decoder stays hexadecimal."""
    base = kind.upper().split("(")[0].strip()
    if base == "NUMBER":
        return lambda b: _plain(d.number(b))
    if base in ("VARCHAR2", "CHAR", "VARCHAR", "LONG"):
        return d.text
    if base in ("NVARCHAR2", "NCHAR"):
        return lambda b: d.text(b, "AL16UTF16")
    if base == "DATE" or base == "TIMESTAMP" and "ZONE" not in kind.upper():
        return lambda b: None if (t := d.timestamp(b)) is None else t.isoformat(" ")
    if base == "TIMESTAMP":
        return d.timestamp_tz
    if base.startswith("INTERVAL"):
        return d.interval
    if base in ("BINARY_FLOAT", "BINARY_DOUBLE"):
        read = d.binary_float if base == "BINARY_FLOAT" else d.binary_double
        return lambda b: None if (x := read(b)) is None else repr(x)
    if base == "BOOLEAN":
        return lambda b: None if (x := d.boolean(b)) is None else str(x).lower()
    return lambda b: b.hex() or None


def decode(rows: DataFrame, catalog: DataFrame, sections: tuple[str, ...] = ("set", "original", "where")) -> DataFrame:
    """rows with each section (column number to hexadecimal bytes) as a map of column names to text.

    catalog: obj_id, columns array<struct<id, name, type, nullable>>.  Rows of tables that it
    lacks go.  Columns that it lacks go; bytes that a nullable column cannot hold give NULL,
    those of a mandatory one fail the query.
    """

    @F.pandas_udf("map<string,string>")
    def named(values: pd.Series, columns: pd.Series) -> pd.Series:
        known: dict[tuple, tuple] = {}
        out = []
        for v, cs in zip(values, columns, strict=True):
            result = []
            by_id = {c["id"]: c for c in cs}
            for k, x in () if v is None else v if isinstance(v, list) else v.items():
                c = by_id.get(k)
                if c is None:
                    continue
                read = known.setdefault((c["type"],), (_decoder(c["type"]),))[0]
                try:
                    result.append((c["name"], None if x is None else read(bytes.fromhex(x))))
                except (ValueError, IndexError):
                    if not c["nullable"]:
                        raise
                    result.append((c["name"], None))
            out.append(dict(result))
        return pd.Series(out)

    joined = rows.join(catalog.select(F.col("obj_id").alias("obj"), F.col("columns").alias("_columns")), "obj")
    return joined.withColumns({c: named(F.col(c), F.col("_columns")) for c in sections}).drop("_columns")
