import pytest

from tidelog.config import CaptureConfig
from tidelog.operators import ddl, filters, snapshots, transforms
from tidelog.operators import sql_text as q


def test_alter_texts():
    n = lambda t: (a := ddl.parse_alter(t)) and a.normal()
    assert n("alter table O . T rename column A to B") == "rename%%A;B%%alter table O . T rename column A to B"
    assert n("ALTER TABLE T ADD (X number(10,2), Y varchar2(5) default 'a,b')") == "add%%X number(10|2);Y varchar2(5) default 'a,b'"
    assert n("alter table T drop (A, B)") == "drop%%A;B%%alter table T drop (A, B)"
    assert n("alter table T set unused column C") == "set unused%%C%%alter table T set unused column C"
    for t in ("alter table T add constraint C primary key (A)", "alter table T add supplemental log data (all) columns", "alter table T drop unused columns", "alter table T drop constraint C", "truncate table T"):
        assert n(t) is None


def test_catalog_versions():
    cols = [ddl.CatalogColumn("ID", 1, "number", False, True), ddl.CatalogColumn("A", 2, "date"), ddl.CatalogColumn("B", 3, "date")]
    go = lambda t: ddl.alter(cols, ddl.parse_alter(t))
    assert [(c.name, c.column_id) for c in go("alter table T drop column A")] == [("ID", 1), ("B", 2)]
    assert [c.name for c in go("alter table T rename column A to Z")] == ["ID", "Z", "B"]
    assert go("alter table T rename column A to B") is None
    new = go("alter table T add (N number(5) not null)")
    assert (new[3].name, new[3].type, new[3].nullable, new[3].column_id) == ("N", "number(5)", False, 4)
    assert go("alter table T modify (A varchar2(100) null default 'SALES')")[1].default == "'SALES'"
    assert go("alter table T modify (Q number)") is None
    with pytest.raises(ValueError):
        go("alter table T drop column ID")


COLS = [q.Target("DEPTNO", "byte", False, True), q.Target("DNAME", "string"), q.Target("PIC", "blob")]


def test_create_and_upsert():
    pg = q.create_table("postgresql", "DEPT", COLS)
    assert "DEPTNO smallint not null" in pg[0] and "constraint DEPT_PK primary key(DEPTNO)" in pg[0] and "lo_manage(PIC)" in pg[1]
    assert "ReplacingMergeTree(_version, _deleted)" in q.create_table("clickhouse", "DEPT", COLS)[0]
    assert "on conflict(DEPTNO) do update set DNAME=excluded.DNAME" in q.upsert("postgresql", "DEPT", COLS)
    assert "on duplicate key update DNAME=values(DNAME)" in q.upsert("mysql", "DEPT", COLS)
    assert "when matched then update set d.DNAME=s.DNAME" in q.upsert("oracle", "DEPT", COLS) and "from dual" in q.upsert("oracle", "DEPT", COLS)
    assert q.upsert("mssql", "DEPT", COLS).endswith(";")
    assert q.upsert("postgresql", "DEPT", COLS, audit=True) == "insert into DEPT(DEPTNO, DNAME) values(?, ?)"
    assert q.upsert("mysql", "K", [q.Target("A", "int", False, True)]) == "insert into K(A) values(?)"
    assert q.delete("DEPT", COLS) == "delete from DEPT where DEPTNO=?"
    with pytest.raises(ValueError):
        q.delete("S", [q.Target("A", "double")])
    assert q.add_columns("oracle", "D", [q.Target("X", "int")]) == "alter table D add (X NUMBER(10))"
    assert q.update_present("D", COLS, ["DNAME"]) == "update D set DNAME=? where DEPTNO=?"
    assert q.update_lob("D", COLS, "PIC") == "update D set PIC=? where DEPTNO=?"


def test_lists_and_maps():
    assert filters.predicate_text(["scott.emp", "hr.*", "app.log%"]) == "(OWNER = 'SCOTT' and TABLE_NAME = 'EMP') or (OWNER = 'HR') or (OWNER = 'APP' and TABLE_NAME like 'LOG%')"
    assert filters.predicate_text(['"sc".T'], exclude=True) == "not (OWNER = 'sc' and TABLE_NAME = 'T')"
    entries = {"O.T.%_ID": "long", "O.T.X_ID": "int", "P.O.T.X_ID": "short"}
    assert transforms.number_map(entries, "P", "O", "T", "X_ID") == "short"
    assert transforms.number_map(entries, "Q", "O", "T", "X_ID") == "int"
    assert transforms.number_map(entries, None, "O", "T", "Y_ID") == "long"
    assert transforms.number_map(entries, None, "O", "T", "Y") is None
    assert snapshots.chunk_predicates("k", 1, 10, 3) == ["k >= 1 and k < 5", "k >= 5 and k < 9", "k >= 9 and k < 11", "k is null"]
    assert filters.wanted_columns([("A", "number"), ("B", "CLOB"), ("SYS_C01$", "number")], False) == ["A"]
    assert CaptureConfig(include=("A.B",), exclude=("A.B",), batch_size=0).problems() == ["batch_size must be positive", "included and excluded: A.B"]
