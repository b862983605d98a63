"""SQL text for target databases: create, upsert, delete, insert, alter, for five dialects."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

#: Engine type to column type (fixed values).
TYPES = {
    "postgresql": {"boolean": "boolean", "byte": "smallint", "short": "smallint", "int": "integer", "long": "bigint", "float": "real", "double": "double precision", "string": "text", "binary": "bytea", "timestamp": "timestamp", "timestamp_tz": "timestamp with time zone", "decimal": "numeric", "blob": "lo", "clob": "text", "xml": "xml"},
    "mysql": {"boolean": "tinyint", "byte": "tinyint", "short": "smallint", "int": "int", "long": "bigint", "float": "float", "double": "double", "string": "varchar(255)", "binary": "varbinary(1000)", "timestamp": "datetime(6)", "timestamp_tz": "timestamp(6)", "decimal": "decimal(38,10)", "blob": "longblob", "clob": "longtext", "xml": "longtext"},
    "oracle": {"boolean": "NUMBER(1)", "byte": "NUMBER(3)", "short": "NUMBER(5)", "int": "NUMBER(10)", "long": "NUMBER(19)", "float": "BINARY_FLOAT", "double": "BINARY_DOUBLE", "string": "VARCHAR2(4000)", "binary": "RAW(2000)", "timestamp": "TIMESTAMP", "timestamp_tz": "TIMESTAMP WITH TIME ZONE", "decimal": "NUMBER", "blob": "BLOB", "clob": "CLOB", "xml": "XMLTYPE"},
    "mssql": {"boolean": "bit", "byte": "smallint", "short": "smallint", "int": "int", "long": "bigint", "float": "real", "double": "float", "string": "nvarchar(4000)", "binary": "varbinary(8000)", "timestamp": "datetime2", "timestamp_tz": "datetimeoffset", "decimal": "decimal(38,10)", "blob": "varbinary(max)", "clob": "nvarchar(max)", "xml": "xml"},
    "clickhouse": {"boolean": "Bool", "byte": "Int8", "short": "Int16", "int": "Int32", "long": "Int64", "float": "Float32", "double": "Float64", "string": "String", "binary": "String", "timestamp": "DateTime64(6)", "timestamp_tz": "DateTime64(6, 'UTC')", "decimal": "Decimal(38, 10)", "blob": "String", "clob": "String", "xml": "String"},
}

LOBS = ("blob", "clob", "xml")


@dataclass(frozen=True)
class Target:
    name: str
    type: str
    nullable: bool = True
    key: bool = False


def _keys(columns: Sequence[Target]) -> list[str]:
    return [c.name for c in columns if c.key]


def create_table(dialect: str, table: str, columns: Sequence[Target]) -> list[str]:
    """The statements that make a table; a PostgreSQL table with large objects also gets a trigger that unlinks them."""
    types = TYPES[dialect]
    kind = lambda c: f"Nullable({types[c.type]})" if dialect == "clickhouse" and c.nullable and not c.key else types[c.type]
    lines = [f"{c.name} {kind(c)}" + (" not null" if (c.key or not c.nullable) and dialect != "clickhouse" else "") for c in columns]
    keys = _keys(columns)
    if dialect == "clickhouse":
        lines += ["_version UInt64", "_deleted UInt8"]
        return [f"create table if not exists {table}(\n  " + ",\n  ".join(lines) + f"\n) engine = ReplacingMergeTree(_version, _deleted) order by ({', '.join(keys) or 'tuple()'})"]
    if keys:
        lines.append(f"constraint {table}_PK primary key({', '.join(keys)})")
    out = [f"create table {table}(\n  " + ",\n  ".join(lines) + "\n)"]
    if dialect == "postgresql":
        out += [f"create trigger t_lob_{c.name.lower()} before update or delete on {table} for each row execute function lo_manage({c.name})" for c in columns if c.type == "blob"]
    return out


def upsert(dialect: str, table: str, columns: Sequence[Target], audit: bool = False) -> str:
    """One row in, or over the row of its key; without a key, in audit mode, or on ClickHouse a plain insert."""
    plain = [c for c in columns if c.type not in LOBS]
    names, keys = [c.name for c in plain], _keys(plain)
    rest = [n for n in names if n not in keys]
    insert = f"insert into {table}({', '.join(names)}) values({', '.join('?' * len(names))})"
    if audit or not keys or dialect == "clickhouse":
        return insert
    if dialect == "postgresql":
        return insert + f" on conflict({', '.join(keys)}) do " + ("update set " + ", ".join(f"{n}=excluded.{n}" for n in rest) if rest else "nothing")
    if not rest:
        return insert
    if dialect == "mysql":
        return insert + " on duplicate key update " + ", ".join(f"{n}=values({n})" for n in rest)
    source = ", ".join(f"? {n}" for n in names)
    dual = " from dual" if dialect == "oracle" else ""
    return (
        f"merge into {table} d using (select {source}{dual}) s on ({' and '.join(f'd.{k}=s.{k}' for k in keys)})"
        f" when matched then update set {', '.join(f'd.{n}=s.{n}' for n in rest)}"
        f" when not matched then insert({', '.join(names)}) values({', '.join(f's.{n}' for n in names)})" + (";" if dialect == "mssql" else "")
    )


def delete(table: str, columns: Sequence[Target]) -> str:
    keys = _keys(columns)
    if not keys:
        raise ValueError("a table without a key has no delete")
    return f"delete from {table} where {' and '.join(f'{k}=?' for k in keys)}"


def update_present(table: str, columns: Sequence[Target], present: Sequence[str]) -> str:
    """An update of the columns that are present."""
    keys = _keys(columns)
    return f"update {table} set {', '.join(f'{n}=?' for n in present if n not in keys)} where {' and '.join(f'{k}=?' for k in keys)}"


def update_lob(table: str, columns: Sequence[Target], lob: str) -> str:
    return f"update {table} set {lob}=? where {' and '.join(f'{k}=?' for k in _keys(columns))}"


def add_columns(dialect: str, table: str, columns: Sequence[Target]) -> str:
    parts = [f"{c.name} {TYPES[dialect][c.type]}" for c in columns]
    if dialect in ("oracle",):
        return f"alter table {table} add ({', '.join(parts)})"
    word = "add column " if dialect in ("postgresql", "mysql", "clickhouse") else ""
    return f"alter table {table} " + ("add " + ", ".join(parts) if dialect == "mssql" else ", ".join(word + p for p in parts))
