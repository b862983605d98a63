"""SQL-redo texts to column maps, with expressions of the JVM; and names of files and columns."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

#: A quoted text with doubled quotes, by possessive loops: no step of the regex engine recurses, whatever the length.
_TEXT = r"'[^']*+(?:''[^']*+)*+'"
_VALUE = rf"(NULL(?![\w(])|{_TEXT}|\w++\([^()']*+(?:{_TEXT}[^()']*+)*+\)|[^\s,)]++)"
#: What stands before a key word outside quotes.
_SKIP = rf"""(?:[^'" ]++|"[^"]*+"|{_TEXT}| (?!%s))*+"""


def _literal(pattern: str) -> str:
    """A pattern as a SQL text literal."""
    return "'" + pattern.replace("\\", "\\\\").replace("'", "\\'") + "'"


#: NULL, nothing (IS NULL), a quoted text with doubled quotes, or a bare value.
_PLAIN = "v -> case when v in ('', 'NULL') then cast(null as string) when startswith(v, '\\'') then replace(substring(v, 2, length(v) - 2), '\\'\\'', '\\'') else v end"


def _pairs(text: str) -> str:
    """Map of "COL" = value and "COL" IS NULL terms of a text expression."""
    names, values = rf'"([^"]++)" (?:= {_VALUE}|IS NULL)', rf'"[^"]++" (?:= {_VALUE}|IS NULL)'
    return f"map_from_arrays(regexp_extract_all({text}, {_literal(names)}, 1), transform(regexp_extract_all({text}, {_literal(values)}, 1), {_PLAIN}))"


def insert_values(text: str = "sql_redo") -> Column:
    """Column map of ``insert into "O"."T"("A","B") values ('x',NULL)``."""
    start = r"""(?s)^insert into (?:[^"(]++|"[^"]*+")++\(((?:[^")]++|"[^"]*+")*+)\) values \((.*)\);?\s*\z"""
    head, tail = (f"regexp_extract({text}, {_literal(start)}, {k})" for k in (1, 2))
    return F.expr(f"map_from_arrays(regexp_extract_all({head}, '\"([^\"]++)\"', 1), transform(regexp_extract_all({tail}, {_literal(_VALUE)}, 1), {_PLAIN}))")


def where_values(text: str = "sql_redo") -> Column:
    """Column map of the WHERE terms of a delete or update."""
    pattern = f"(?s)^{_SKIP % 'where '} where (.*)"
    return F.expr(_pairs(f"regexp_extract({text}, {_literal(pattern)}, 1)"))


def set_values(text: str = "sql_redo") -> Column:
    """Column map of the SET terms of an update."""
    pattern = f"(?s)^{_SKIP % 'set '} set ({_SKIP % 'where '})"
    return F.expr(_pairs(f"regexp_extract({text}, {_literal(pattern)}, 1)"))


def operation(text: str = "sql_redo") -> Column:
    return F.when(F.col(text).startswith("insert "), 1).when(F.col(text).startswith("delete "), 2).when(F.col(text).startswith("update "), 3)


def convert_file_name(name: Column, prefixes: Mapping[str, str]) -> Column:
    """The first old prefix that fits replaced by the new one; Windows separators follow a new prefix without any."""
    out = name
    for old, new in reversed(prefixes.items()):
        rest = F.substring(name, F.lit(len(old) + 1), F.length(name))
        if "\\" in old and "\\" not in new:
            rest = F.replace(rest, F.lit("\\"), F.lit("/"))
        out = F.when(name.startswith(old), F.concat(F.lit(new), rest)).otherwise(out)
    return out


def canonical_name(name: Column) -> Column:
    """Quoted names keep their case, others are upper-cased."""
    bare = F.trim(name)
    return F.when(bare.startswith('"') & bare.endswith('"'), F.substring(bare, F.lit(2), F.length(bare) - 2)).otherwise(F.upper(bare))
