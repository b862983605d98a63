import duckdb
import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def duck(sf):
    c = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "labels", "conversations"):
        c.sql(f"create view {t} as select * from '{sf}/{t}.parquet'")
    return c


@pytest.fixture(scope="session")
def doc_rows(duck):
    return duck.sql("select doc_id, text from documents order by doc_id").fetchall()


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls, empty and blank texts, a very long one, ties and repeated rows, and columns whose names clash."""
    long = " ".join(f"w{k % 977} v{k}" for k in range(30_000))
    rows = [(1, None), (2, ""), (3, " \n\t "), (4, "one"), (None, "two words"), (5, long), (6, long), (6, long), (7, "é" * 300), (8, "a\n" * 50), (9, "x " * 500)]
    return spark.createDataFrame([(i, t, "en", "s", None, True, 1.5, 3, "k") for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long, kept boolean, llr double, node long, uid string")


@pytest.fixture(scope="session")
def none(odd):
    return odd.limit(0)
