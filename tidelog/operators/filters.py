"""Predicates over change logs, all as plain column expressions or semi-joins."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _name(part: str) -> str:
    """A quoted name keeps its case, any other is upper-cased."""
    return part[1:-1] if len(part) > 1 and part[0] == part[-1] == '"' else part.upper()


def _one(entry: str, owner: str, table: str) -> Column:
    head, dot, tail = entry.strip().partition(".")
    if not dot:
        # a bare table name is taken as it stands
        return F.col(table) == head.strip('"')
    mine = F.col(owner) == _name(head)
    if tail in ("*", "%"):
        return mine
    if tail.endswith(("%", "*")):
        return mine & F.col(table).startswith(_name(tail[:-1]))
    return mine & (F.col(table) == _name(tail))


def table_list(entries: Sequence[str], owner: str = "owner", table: str = "table_name") -> Column:
    """True for the tables named by ``OWNER.TABLE``, ``OWNER.*``, ``OWNER.PREFIX%`` or ``TABLE``; for none if the list is empty."""
    return reduce(lambda a, b: a | b, (_one(e, owner, table) for e in entries), F.lit(False))


def in_scope(include: Sequence[str], exclude: Sequence[str], owner: str = "owner", table: str = "table_name") -> Column:
    """Included (all, without a list) and not excluded; an exclusion drops just the tables that it names."""
    return (table_list(include, owner, table) if include else F.lit(True)) & ~table_list(exclude, owner, table)


def predicate_text(entries: Sequence[str], exclude: bool = False) -> str:
    """The list as SQL text for a remote dictionary query."""
    parts = []
    for e in entries:
        head, dot, tail = e.strip().partition(".")
        if not dot:
            parts.append(f"(TABLE_NAME = '{head}')")
        elif tail in ("*", "%"):
            parts.append(f"(OWNER = '{_name(head)}')")
        elif tail.endswith(("%", "*")):
            parts.append(f"(OWNER = '{_name(head)}' and TABLE_NAME like '{_name(tail[:-1])}%')")
        else:
            parts.append(f"(OWNER = '{_name(head)}' and TABLE_NAME = '{_name(tail)}')")
    return " and ".join(f"not {p}" for p in parts) if exclude else " or ".join(parts)


def object_scope(log: DataFrame, objects: DataFrame, on: str | list[str] = "obj_id") -> DataFrame:
    """Changes of known objects: a semi-join, broadcast by Spark where the catalog is small."""
    return log.join(objects, on, "left_semi")


def containers(con_ids: Iterable[int], column: str = "con_id") -> Column:
    return F.col(column).isin(list(con_ids))


def changed(before: Sequence[str], after: Sequence[str]) -> Column:
    """Does any column differ, NULL counting as a value."""
    return reduce(lambda a, b: a | b, (~F.col(x).eqNullSafe(F.col(y)) for x, y in zip(before, after, strict=True)), F.lit(False))


def no_noop_updates(log: DataFrame, before: Sequence[str], after: Sequence[str], op: str = "op") -> DataFrame:
    """Without updates that set every column to the value that it had."""
    return log.where((F.col(op) != 3) | changed(before, after))


def no_keyless_deletes(log: DataFrame, has_key: Column, op: str = "op") -> DataFrame:
    return log.where(~((F.col(op) == 2) & ~has_key))


def complete(mandatory: Sequence[str]) -> Column:
    """Every mandatory column has a value."""
    return reduce(lambda a, b: a & b, (F.col(c).isNotNull() for c in mandatory), F.lit(True))


def after_position(position: Sequence[str], values: Sequence[int]) -> Column:
    """Rows behind a log position, compared part by part as numbers."""
    return F.struct(*position) > F.struct(*(F.lit(v).alias(c) for c, v in zip(position, values, strict=True)))


def not_committed_before(commit_scn: str, last: int) -> Column:
    """Transactions that a restart must still deliver."""
    return F.col(commit_scn) > last


def user_tables(owner: str = "owner", table: str = "table_name", temporary: str | None = None, system: Sequence[str] = ("SYS", "SYSTEM", "MDSYS", "CTXSYS", "XDB", "OUTLN")) -> Column:
    """Neither of a system owner, nor a log of the database's own, nor temporary."""
    ok = ~F.col(owner).isin(*system) & ~F.col(table).startswith("MLOG$_")
    return ok if temporary is None else ok & (F.col(temporary) == "N")


def index_change_not_empty(flags: Sequence[str]) -> Column:
    """An index-organised change with at least one piece flag."""
    return reduce(lambda a, b: a | b, (F.col(c) != 0 for c in flags))


def row_changes(opcode: str = "opcode", eligible_lock: str | None = None) -> Column:
    """Redo opcodes that change rows; cluster links go, row locks stay only where they carry supplemental data."""
    keep = ~F.col(opcode).isin("11.10", "11.22")
    return keep & ((F.col(opcode) != "11.4") | (F.col(eligible_lock) if eligible_lock else F.lit(False)))


def wanted_columns(columns: Sequence[tuple[str, str]], process_lobs: bool) -> list[str]:
    """Names of (name, type) columns, large objects only on demand, guard and unused columns never."""
    lobs = ("CLOB", "NCLOB", "BLOB", "XMLTYPE", "JSON")
    return [n for n, kind in columns if (process_lobs or kind.upper() not in lobs) and not (n.startswith("SYS_C") and n.endswith("$")) and not (n.startswith("SYS_NC") and n.endswith("$"))]
