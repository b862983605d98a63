"""DDL: ALTER TABLE texts, catalog versions, and the version that a change is decoded by."""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Alteration:
    """What an ALTER TABLE does to columns: operation, (column, definition or new name) pairs, and the text."""

    op: str
    columns: tuple[tuple[str, str], ...]
    text: str

    def normal(self) -> str:
        """One line: operation, columns, and, except for ADD and MODIFY, the original text."""
        body = ";".join(f"{a};{b}" if self.op == "rename" else f"{a} {b}".strip() for a, b in self.columns)
        return f"{self.op}%%{body}" + ("" if self.op in ("add", "modify") else f"%%{self.text}")


def _split(body: str) -> list[str]:
    """Comma parts outside parentheses and quotes."""
    parts, depth, at, quoted = [], 0, 0, False
    for k, ch in enumerate(body):
        quoted ^= ch == "'"
        depth += ((ch == "(") - (ch == ")")) * (not quoted)
        if ch == "," and depth == 0 and not quoted:
            parts.append(body[at:k])
            at = k + 1
    return [p.strip() for p in [*parts, body[at:]] if p.strip()]


def parse_alter(text: str) -> Alteration | None:
    """The column change of an ALTER TABLE text, or None where it changes no column."""
    flat = " ".join(text.split()).rstrip("; ")
    m = re.match(r'alter table (?:(?:"[^"]+"|[\w$#]+) ?\. ?)?(?:"[^"]+"|[\w$#]+) (.*)$', flat, re.I)
    if m is None:
        return None
    action = m[1]
    if r := re.match(r'rename column ("[^"]+"|\S+) to ("[^"]+"|\S+)$', action, re.I):
        return Alteration("rename", ((r[1], r[2]),), text)
    if r := re.match(r"(add|modify) (?!constraint|supplemental|primary|unique|foreign|check|partition)(.*)$", action, re.I):
        body = r[2].strip()
        if body.startswith("(") and body.endswith(")"):
            body = body[1:-1]
        pairs = []
        for p in _split(body):
            name, _, rest = p.partition(" ")
            # a comma inside (p,s) becomes a bar, since lists are comma lists
            pairs.append((name, re.sub(r"\([^)']*\)", lambda m: re.sub(r"\s*,\s*", "|", m[0]), rest.strip())))
        return Alteration(r[1].lower(), tuple(pairs), text)
    if r := re.match(r"(drop|set unused) ?(column )?(?!constraint|unused|supplemental|primary|partition)(.*)$", action, re.I):
        body = r[3].strip()
        body = re.sub(r"\s*(cascade constraints|invalidate|checkpoint \d+)\s*$", "", body, flags=re.I)
        listed = body.startswith("(")
        if not listed and not r[2]:
            return None
        return Alteration("drop" if r[1].lower() == "drop" else "set unused", tuple((c, "") for c in _split(body.strip("()"))), text)
    return None


@dataclass(frozen=True)
class CatalogColumn:
    name: str
    column_id: int
    type: str
    nullable: bool = True
    pk: bool = False
    default: str | None = None


def column_of(name: str, column_id: int, text: str) -> CatalogColumn:
    """A column from its definition text."""
    m = re.match(r"\s*([a-z][a-z0-9_ ]*?)\s*(\([^)]*\))?(?=\s|$)", text, re.I)
    kind = (m[1] + (m[2] or "")) if m else text
    default = re.search(r"\bdefault\s+('(?:[^']|'')*'|\S+)", text, re.I)
    return CatalogColumn(name.strip('"') if name.startswith('"') else name.upper(), column_id, kind.strip(), re.search(r"\bnot null\b", text, re.I) is None, False, default[1] if default else None)


def alter(columns: Sequence[CatalogColumn], change: Alteration) -> list[CatalogColumn] | None:
    """The next version's columns, or None where nothing changes; dropping a key column is an error."""
    name = lambda c: c.strip('"') if c.startswith('"') else c.upper()
    have = {c.name: c for c in columns}
    if change.op == "add":
        new = [column_of(c, 0, d.replace("|", ",")) for c, d in change.columns if name(c) not in have]
        return [*columns, *(replace(c, column_id=len(columns) + k + 1) for k, c in enumerate(new))] if new else None
    if change.op == "modify":
        new = {name(c): d.replace("|", ",") for c, d in change.columns if name(c) in have}
        return [replace(column_of(f'"{c.name}"', c.column_id, new[c.name]), pk=c.pk) if c.name in new else c for c in columns] if new else None
    if change.op == "rename":
        old, to = (name(x) for x in change.columns[0])
        return [replace(c, name=to) if c.name == old else c for c in columns] if old in have and to not in have else None
    gone = {name(c) for c, _ in change.columns} & set(have)
    if any(have[c].pk for c in gone):
        raise ValueError(f"a key column can't be dropped: {', '.join(sorted(gone))}")
    left = [c for c in columns if c.name not in gone]
    return [replace(c, column_id=k + 1) for k, c in enumerate(left)] if gone else None


def version_as_of(changes: DataFrame, versions: DataFrame, key: str, position: str = "scn", valid_from: str = "valid_from_scn", carry: Sequence[str] = ("version",)) -> DataFrame:
    """changes with the latest version of their table at their position: a sorted union, one shuffle."""
    cols = changes.columns
    left = changes.select(*cols, F.lit(1).alias("_k"), *(F.lit(None).cast(versions.schema[c].dataType).alias(f"_v_{c}") for c in carry))
    right = versions.select(*(F.col(valid_from).alias(c) if c == position else F.col(c) if c == key else F.lit(None).cast(changes.schema[c].dataType).alias(c) for c in cols), F.lit(0).alias("_k"), *(F.col(c).alias(f"_v_{c}") for c in carry))
    w = Window.partitionBy(key).orderBy(position, "_k").rowsBetween(Window.unboundedPreceding, 0)
    seen = left.unionByName(right).withColumns({c: F.last(f"_v_{c}", ignorenulls=True).over(w) for c in carry})
    return seen.where("_k = 1").select(*cols, *carry)


def is_guard_column(name: Column) -> Column:
    """Columns that the database keeps for itself: unused ones and guards of functional indexes."""
    return name.rlike(r"^SYS_N?C.*\$$")


def pick_key(tables: DataFrame, indexes: DataFrame) -> DataFrame:
    """The key index of each table from rows (table_id, index_name, column_name, nullable, is_pk): the primary key, else the
    unique index whose columns are all mandatory, with the fewest columns and then the first name."""
    per = indexes.groupBy("table_id", "index_name").agg(F.max("is_pk").alias("is_pk"), F.count("*").alias("n_columns"), F.max("nullable").alias("any_nullable"))
    usable = per.where("is_pk or not any_nullable")
    best = usable.groupBy("table_id").agg(F.min(F.struct((~F.col("is_pk")).alias("o"), "n_columns", "index_name")).alias("b"))
    return tables.join(best, "table_id", "left").select("table_id", F.col("b.index_name").alias("index_name"), F.col("b.n_columns").alias("n_columns"))
