import datetime as dt
import math
from decimal import Decimal

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidelog.functions import decoders as d
from tidelog.functions import sql_redo


def test_literals():
    assert d.text(bytes.fromhex("7468616e6b73")) == "thanks"
    assert d.number(bytes.fromhex("3f534966")) == Decimal("-0.1828")
    assert d.binary_float(bytes.fromhex("bfddb3d7")) == pytest.approx(math.sqrt(3), rel=1e-6)
    assert d.binary_double(bytes.fromhex("bffbb67ae8584caa")) == math.sqrt(3)
    assert d.number(bytes.fromhex("c1024a153351")) == Decimal("1.73205080")
    assert d.number(b"") is None and d.number(b"\x80") == 0
    with pytest.raises(ValueError):
        d.number(b"\xc1\x00")


@given(st.decimals(allow_nan=False, allow_infinity=False, min_value=Decimal("-1e30"), max_value=Decimal("1e30"), places=6))
def test_number_round_trip(x):
    assert d.number(d.number_bytes(x)) == x


def test_dates_and_intervals():
    assert d.timestamp(bytes([120, 124, 2, 29, 24, 60, 1])) == dt.datetime(2024, 2, 29, 23, 59, 0)
    assert d.timestamp(b"\x00") is None
    assert d.timestamp(bytes([120, 124, 1, 1, 1, 1, 1]) + (500_000_000).to_bytes(4, "big")).microsecond == 500_000
    assert d.timestamp_tz(bytes([120, 124, 1, 1, 1, 1, 1, 0, 0, 0, 0, 22, 60])) == "2024-01-01T02:00:00+02:00"
    ym = (0x80000000 + 3).to_bytes(4, "big") + bytes([67])
    ds = (0x80000000 + 77).to_bytes(4, "big") + bytes([74, 93, 75]) + (0x80000000).to_bytes(4, "big")
    assert d.interval(ym) == "P3Y7M" and d.interval(ds) == "P77DT14H33M15S"
    with pytest.raises(ValueError):
        d.interval(b"abc")


def test_boolean_text_vector_gzip():
    assert d.boolean(b"\x01") is True and d.boolean(b"") is None
    with pytest.raises(ValueError):
        d.boolean(b"\x02")
    with pytest.raises(ValueError):
        d.text(b"x", "NOPE")
    assert d.text("Спасибо".encode("cp1251"), "CL8MSWIN1251") == "Спасибо"
    assert d.vector(b"\xdb\x00\x00\x00\x04\x00\x00\x00\x03\x01\xff\x02") == {"I": [1, -1, 2]}
    assert d.vector(b"\xdb\x00\x00\x00\x05\x00\x00\x00\x03\xa0") == {"B": [True, False, True]}
    import gzip

    assert d.gunzip(gzip.compress(b"abc")) == "abc" and d.gunzip(b"plain") == "plain"


def test_udfs_in_spark(spark):
    rows = [(bytearray(d.number_bytes(Decimal("12.5"))),), (None,), (bytearray(b"\xc1\x00"),)]
    df = spark.createDataFrame(rows, "b binary")
    assert [r[0] for r in df.select(d.udf(d.number, "decimal(38,2)", strict=False)("b")).collect()] == [Decimal("12.50"), None, None]
    one = spark.createDataFrame([(bytearray([120, 124, 2, 29, 24, 60, 1]),)], "b binary")
    assert one.select(d.ora_date(F.col("b"))).first()[0] == dt.datetime(2024, 2, 29, 23, 59, 0)


def test_sql_redo_texts(spark):
    texts = ["insert into \"O\".\"T\"(\"A\",\"B\",\"C\") values ('x''y',NULL,12)", 'update "O"."T" set "A" = \'n\' where "A" = \'o\' and "B" IS NULL', 'delete from "O"."T" where "A" = \'x, y\'']
    df = spark.createDataFrame([(t,) for t in texts], "sql_redo string")
    r = df.select(sql_redo.operation().alias("op"), sql_redo.insert_values().alias("i"), sql_redo.set_values().alias("s"), sql_redo.where_values().alias("w")).collect()
    assert [x.op for x in r] == [1, 3, 2]
    assert r[0].i == {"A": "x'y", "B": None, "C": "12"}
    assert r[1].s == {"A": "n"} and r[1].w == {"A": "o", "B": None} and r[2].w == {"A": "x, y"}


def test_names(spark):
    df = spark.createDataFrame([("C:\\ora\\a\\1.arc",), ("/u01/x/2.arc",)], "n string")
    got = [r[0] for r in df.select(sql_redo.convert_file_name(F.col("n"), {"C:\\ora": "/mnt", "/u01": "/u02"})).collect()]
    assert got == ["/mnt/a/1.arc", "/u02/x/2.arc"]
    assert [r[0] for r in spark.createDataFrame([('"aB"',), ("ab",)], "n string").select(sql_redo.canonical_name(F.col("n"))).collect()] == ["aB", "AB"]


def test_sql_redo_of_long_values_and_key_words_in_texts(spark):
    long = "x where \n''" * 100_000
    rows = [(f"insert into \"O\".\"T\"(\"A\",\"B\") values ('{long}',TO_DATE('1, 2', 'f'));", f"update \"O\".\"T\" set \"A\" = '{long}', \"B\" = NULL where \"A\" = 'a set b' and \"C\" IS NULL")]
    r = spark.createDataFrame(rows, "i string, u string").select(sql_redo.insert_values("i").alias("i"), sql_redo.set_values("u").alias("s"), sql_redo.where_values("u").alias("w")).first()
    plain = long.replace("''", "'")
    assert r.i == {"A": plain, "B": "TO_DATE('1, 2', 'f')"} and r.s == {"A": plain, "B": None} and r.w == {"A": "a set b", "C": None}
