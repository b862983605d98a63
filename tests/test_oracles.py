"""Every query of the change-data engine against its SQL, and the driver's contract."""

import duckdb
import pytest

import __spark_entry__ as entry
from tidelog.plans.queries import ORACLES, QUERIES

TABLES = "region nation customer supplier part orders lineitem events".split()


@pytest.fixture(scope="module")
def duck(sf):
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"create view {t} as select * from '{sf}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, duck, sf, name):
    df = QUERIES[name](spark, sf)
    cols = sorted(df.columns)
    got = sorted(repr(tuple(r[c] for c in cols)) for r in df.collect())
    sql = ORACLES[name]
    assert sorted(duck.sql(sql).columns) == cols
    names = ", ".join(f'"{c}"' for c in cols)
    assert got == sorted(map(repr, duck.sql(f"select {names} from ({sql})").fetchall()))


def test_entry_and_registry(spark):
    assert entry.entry(spark).count() > 0
    assert set(QUERIES) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())
