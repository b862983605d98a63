"""Record transforms: headers and keys to fields, names, number and interval columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def selects(pattern: str, name: str) -> bool:
    """Blank selects all; ``%suffix``, ``prefix%``, or the exact name."""
    if not pattern.strip():
        return True
    if pattern.startswith("%"):
        return name.endswith(pattern[1:])
    if pattern.endswith("%"):
        return name.startswith(pattern[:-1])
    return name == pattern


def header_to_field(header: Column, mapping: Mapping[str, str] | None = None) -> Column:
    """The header's value, translated where the mapping knows it."""
    if not mapping:
        return header
    table = F.create_map(*(F.lit(x) for kv in mapping.items() for x in kv))
    return F.coalesce(F.element_at(table, header), header)


def key_to_value(events: DataFrame, fields: Sequence[str], key: str = "key", value: str = "value") -> DataFrame:
    """Key fields copied into the value; the key stays."""
    return events.withColumn(value, F.struct(f"{value}.*", *(F.col(f"{key}.{f}").alias(f) for f in fields)))


def lower_names(events: DataFrame, names: Sequence[str] = ()) -> DataFrame:
    """Column names (all, or those listed) in lower case."""
    return events.toDF(*(c.lower() if not names or c in names else c for c in events.columns))


_NUMBER = {"string": "string", "double": "double", "float": "float", "long": "bigint", "int": "int", "short": "smallint", "byte": "tinyint", "boolean": "boolean"}


def number_type(kind: str, precision: int = 38, scale: int = 0) -> str:
    return f"decimal({precision},{scale})" if kind == "decimal" else _NUMBER[kind]


def convert_numbers(events: DataFrame, pattern: str, kind: str, precision: int = 38, scale: int = 0, null_default: object | None = None) -> DataFrame:
    """Selected columns cast to one type, NULL optionally replaced."""
    out = {}
    for c in events.columns:
        if selects(pattern, c):
            v = F.col(c).cast(number_type(kind, precision, scale))
            out[c] = v if null_default is None else F.coalesce(v, F.lit(null_default).cast(number_type(kind, precision, scale)))
    return events.withColumns(out)


def number_map(entries: Mapping[str, str], pdb: str | None, owner: str, table: str, column: str) -> str | None:
    """Type text for a column from ``[PDB.]OWNER.TABLE.COL`` entries; COL may be ``%suffix`` or ``prefix%``.

    The exact name wins over a wildcard, a database's own entry over a general one.
    """
    found: list[tuple[int, str]] = []
    for name, kind in entries.items():
        parts = name.split(".")
        if len(parts) == 4 and parts[0] != pdb or len(parts) not in (3, 4) or parts[-3:-1] != [owner, table]:
            continue
        if parts[-1] and selects(parts[-1], column):
            found.append((2 * (parts[-1] == column) + (len(parts) == 4), kind))
    return max(found)[1] if found else None


def iso_year_month(months: Column) -> Column:
    """A number of months as an ISO-8601 period."""
    m = F.abs(months)
    years, rest = F.floor(m / 12).cast("long"), (m % 12).cast("long")
    body = F.concat(F.when(years > 0, F.concat(years.cast("string"), F.lit("Y"))).otherwise(F.lit("")), F.when(rest > 0, F.concat(rest.cast("string"), F.lit("M"))).otherwise(F.lit("")))
    return F.when(m == 0, F.lit("P0M")).otherwise(F.concat(F.when(months < 0, F.lit("-")).otherwise(F.lit("")), F.lit("P"), body))


def iso_day_second(seconds: Column) -> Column:
    """Whole seconds as an ISO-8601 duration of days, hours, minutes and seconds."""
    s = F.abs(seconds).cast("long")
    d, h, m, r = F.floor(s / 86400).cast("long"), F.floor(s % 86400 / 3600).cast("long"), F.floor(s % 3600 / 60).cast("long"), s % 60
    part = lambda v, unit: F.when(v > 0, F.concat(v.cast("string"), F.lit(unit))).otherwise(F.lit(""))
    time = F.concat(part(h, "H"), part(m, "M"), part(r, "S"))
    body = F.concat(part(d, "D"), F.when(time != "", F.concat(F.lit("T"), time)).otherwise(F.lit("")))
    return F.when(s == 0, F.lit("PT0S")).otherwise(F.concat(F.when(seconds < 0, F.lit("-")).otherwise(F.lit("")), F.lit("P"), body))
