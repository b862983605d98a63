"""Column images, defaults, pseudo-columns and identifiers of change rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_BASE64 = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"


def after_image(columns: Sequence[str], before: str, after: str) -> list[Column]:
    """Full image behind an update: SET values, and the old ones where SET has no such column.

    ``before`` and ``after`` are name prefixes; ``<after><c>__set`` tells a column that was set,
    also to NULL.
    """
    return [F.when(F.col(f"{after}{c}__set"), F.col(f"{after}{c}")).otherwise(F.col(f"{before}{c}")).alias(c) for c in columns]


def after_map(before: str, after: str) -> Column:
    """The same over maps of column values, the later value of a name winning."""
    return F.map_from_entries(F.expr(f"concat(filter(map_entries({before}), e -> not map_contains_key({after}, e.key)), map_entries({after}))"))


def before_image(columns: Sequence[str], old: str, new: str) -> list[Column]:
    """Image ahead of an update: the new image with the original values of set columns."""
    return [F.when(F.col(f"{old}{c}__set"), F.col(f"{old}{c}")).otherwise(F.col(f"{new}{c}")).alias(c) for c in columns]


def with_defaults(defaults: Mapping[str, Column]) -> dict[str, Column]:
    """Mandatory columns, NULL replaced by the typed default."""
    return {c: F.coalesce(F.col(c), d) for c, d in defaults.items()}


def decoded(column: str, kind: str, nullable: bool) -> Column:
    """A cast that gives NULL for what a nullable column cannot hold, and fails the query for a mandatory one."""
    return F.expr(f"try_cast(`{column}` as {kind})") if nullable else F.col(column).cast(kind)


#: Pseudo-columns by name, each independent of the others.
PSEUDO = {
    "rowscn": lambda: F.col("scn"),
    "rowts": lambda: F.col("ts"),
    "commitscn": lambda: F.col("commit_scn"),
    "operation": lambda: F.when(F.col("op") == 1, "INSERT").when(F.col("op") == 2, "DELETE").when(F.col("op") == 3, "UPDATE"),
    "xid": lambda: F.col("xid"),
    "username": lambda: F.col("username"),
    "osusername": lambda: F.col("os_username"),
    "hostname": lambda: F.col("machine_name"),
    "audit_session_id": lambda: F.col("audit_session_id"),
    "session_info": lambda: F.col("session_info"),
    "client_id": lambda: F.col("client_id"),
}


def pseudo_columns(names: Mapping[str, str]) -> dict[str, Column]:
    """Configured pseudo-columns: kind to column name."""
    return {name: PSEUDO[kind]() for kind, name in names.items()}


#: Fields of the source block in their order.
SOURCE_FIELDS = ("instance_number", "version", "instance_name", "host_name", "dbid", "database_name", "platform_name", "commit_scn", "xid", "query", "pdb_name", "owner", "table", "scn", "row_id", "ts_ms")


def source_struct(have: Mapping[str, Column]) -> Column:
    return F.struct(*(have.get(f, F.lit(None).cast("string")).alias(f) for f in SOURCE_FIELDS))


def _digits64(value: Column, n: int) -> Column:
    return F.concat(*(F.substring(F.lit(_BASE64), (F.shiftright(value, 6 * k).bitwiseAND(63) + 1).cast("int"), F.lit(1)) for k in range(n - 1, -1, -1)))


def rowid_text(data_obj: Column, file: Column, block: Column, slot: Column) -> Column:
    """The 18 letters of a row address: object 6, file 3, block 6, slot 3, base 64."""
    return F.concat(_digits64(data_obj, 6), _digits64(file, 3), _digits64(block, 6), _digits64(slot, 3))


def combined_id(con_id: Column, obj_id: Column) -> Column:
    """Container in the high half, object in the low half."""
    return F.shiftleft(con_id.cast("long"), 32).bitwiseOR(obj_id.cast("long"))


def remap_objects(log: DataFrame, parents: DataFrame) -> DataFrame:
    """log with ``table_obj_id``: partitions and overflow segments by the table that they belong to."""
    return log.join(parents.select(F.col("obj_id"), "parent_obj_id"), "obj_id", "left").withColumn("table_obj_id", F.coalesce("parent_obj_id", "obj_id")).drop("parent_obj_id")


def pseudo_sql(op: str, obj_id: str, columns: Sequence[str], row_id: str) -> Column:
    """The change as SQL text against an unknown table, for diagnosis."""
    table = F.concat(F.lit('"UNKNOWN"."OBJ# '), F.col(obj_id).cast("string"), F.lit('"'))
    value = {c: F.coalesce(F.concat(F.lit("'"), F.col(c).cast("string"), F.lit("'")), F.lit("NULL")) for c in columns}
    names = F.lit(", ".join(f'"COL {k + 1}"' for k in range(len(columns))))
    sets = F.concat_ws(", ", *(F.concat(F.lit(f'"COL {k + 1}" = '), value[c]) for k, c in enumerate(columns)))
    where = F.concat(F.lit(" where ROWID = '"), F.col(row_id).cast("string"), F.lit("'"))
    return (
        F.when(F.col(op) == 1, F.concat(F.lit("insert into "), table, F.lit("("), names, F.lit(") values ("), F.concat_ws(", ", *value.values()), F.lit(")")))
        .when(F.col(op) == 2, F.concat(F.lit("delete from "), table, where))
        .when(F.col(op) == 3, F.concat(F.lit("update "), table, F.lit(" set "), sets, where))
    )


def dump_row(columns: Sequence[str], delimiter: str = "|") -> Column:
    """Values with a delimiter, NULL as nothing."""
    return F.concat_ws(delimiter, *(F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns))


def deleted_value(op: str, value: Column, all_columns: bool = False) -> Column:
    """NULL for a delete (a tombstone), unless deletes carry all columns."""
    return value if all_columns else F.when(F.col(op) != 2, value)
