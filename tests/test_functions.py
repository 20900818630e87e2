from datetime import date, datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import names, values
from tidemark.functions.fingerprints import multiset_hash, row_text
from tidemark.operators import compat


def test_identifier_is_bounded_and_stable():
    long = "x" * 60 + "2026_01_01"
    assert len(names.bounded_identifier(long).encode()) <= 63
    assert names.bounded_identifier(long) == names.bounded_identifier(long)
    assert names.bounded_identifier(long) != names.bounded_identifier(long + "a")
    assert len(names.bounded_identifier("é" * 60).encode()) <= 63
    assert names.bounded_identifier("short") == "short"


def test_partition_names():
    day = date(2026, 4, 2)
    assert names.range_name("orders", day, "daily", "{table}_p{yyyymmdd}") == "orders_p20260402"
    assert names.range_name("orders", day, "daily") == "orders_2026_04_02"
    assert names.range_name("orders", day, "monthly") == "orders_2026_04"
    assert names.list_name("t", "a-b c:d.e") == "t_a_b_c_d_e"
    assert names.list_name("t", 4101, "{table}_p{value}") == "t_p4101"
    assert names.default_name("t") == "t_default"
    with pytest.raises(ValueError):
        names.range_name("t", day, "daily", "{table}_{yyyymm}")
    with pytest.raises(ValueError):
        names.list_name("t", 1, "{table}")
    with pytest.raises(TypeError):
        names.as_date("2026-01-01")
    assert names.as_date(datetime(2026, 1, 2, 3)) == date(2026, 1, 2)
    assert names.next_period(date(2026, 1, 1), "monthly") == date(2026, 2, 1)
    assert names.next_period(date(2026, 12, 31), "daily") == date(2027, 1, 1)
    assert names.period_start(day, "monthly") == date(2026, 4, 1)


def test_name_columns_agree_with_the_driver(spark):
    rows = [(date(2026, 4, 2), "a-b"), (date(1999, 12, 31), "é" * 70)]
    df = spark.createDataFrame(rows, "d date, v string")
    got = df.select(names.range_name_column("t" * 70, F.col("d"), "daily").alias("r"), names.list_name_column("t", F.col("v")).alias("l")).collect()
    for (d, v), g in zip(rows, got):
        assert g["r"] == names.range_name("t" * 70, d, "daily")
        assert g["l"] == names.list_name("t", v)


def test_sequences():
    s = names.Sequence(1)
    assert s.after(100).next_value == 101 and s.after(100).stored() == (100, True)
    assert names.Sequence(1, 1, 1, 100).stored() == (1, False)
    assert names.Sequence(151).after(100).next_value == 151
    assert names.Sequence(-1, -1, -(2**63), -1).after(-100).next_value == -101
    assert names.Sequence.read(150, True).next_value == 151 and names.Sequence.read(150, False).next_value == 150
    assert s.after(None) == s


@pytest.mark.parametrize("text,want", [(None, None), ("", None), ("  ", None), (' {"a": 1} ', '{"a": 1}'), ("{'a': 1}", '{"a": 1}'), ("[1, 2]", "[1, 2]"), ("true", "true"), ("True", "true"), ("1", "1")])
def test_json_text(text, want):
    assert values.json_text(text) == want


@pytest.mark.parametrize("text", ['{"a":NaN}', "{'a': 1} x", "[1,2", "01x", "__import__('os')", "nan", "'just text'"])
def test_json_text_refuses(text):
    with pytest.raises(ValueError):
        values.json_text(text)


def test_json_columns(spark):
    texts = ['{"a":1}', '{"a":1} x', "{'a': 1}", "", None, "[1,2", '{"a":NaN}', "1] [2", '1} {"x":2']
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = df.select(values.json_checked(F.col("t")).alias("j")).collect()
    assert [r["j"]["text"] for r in got] == ['{"a":1}', None, '{"a": 1}', None, None, None, None, None, None]
    assert [r["j"]["error"] is None for r in got] == [True, False, True, True, True, False, False, False, False]


def test_array_literal(spark):
    df = spark.createDataFrame([(["a", None, 'x"y', "b\\c"],), ([],), (None,)], "a array<string>")
    assert [r[0] for r in df.select(values.array_literal(F.col("a"))).collect()] == ['{"a",NULL,"x\\"y","b\\\\c"}', "{}", None]


def test_row_json(spark):
    df = spark.sql("SELECT cast('1234567890.123456789' as decimal(20,9)) AS d, cast('ab' as binary) AS b, timestamp_ntz'2026-01-02 03:04:05' AS t, cast(null as int) AS n")
    assert df.select(values.row_json(df.schema)).first()[0] == '{"d":"1234567890.123456789","b":"YWI=","t":"2026-01-02T03:04:05","n":null}'


def test_typed(spark):
    assert values.typed("None", T.LongType()) is None
    row = spark.range(1).select(values.typed("20260704", T.LongType()).alias("a"), values.typed("1234567890.123456789", T.DecimalType(20, 9)).alias("b")).first()
    assert row["a"] == 20260704 and str(row["b"]) == "1234567890.123456789"


def test_all_allowed_conversions():
    assert sum(map(len, compat.WIDER.values())) == 40
    for a, targets in compat.WIDER.items():
        assert compat.compatible(a, a) == (True, False)
        for b in targets:
            assert compat.compatible(a, b) == (True, True)


@pytest.mark.parametrize("a,b", [("integer", "smallint"), ("integer", "real"), ("numeric", "double precision"), ("double precision", "real"), ("character", "character varying"), ("timestamptz", "timestamp without time zone"), ("text", "json"), ("integer", "boolean"), ("array<int>", "array<string>")])
def test_refused_conversions(a, b):
    assert compat.compatible(a, b) == (False, False)


def test_spellings():
    assert compat.compatible("varchar(20)", "character varying(5)") == (True, False)
    assert compat.compatible("float8", "int4") == (True, True)
    assert compat.compatible("array<int>", "array<integer>") == (True, False)


def test_conversion_keeps_exact_values_only(spark):
    df = spark.createDataFrame([(1.0,), (1.5,), (1e12,), (None,)], "x double")
    assert [r[0] for r in df.select(compat.converted(F.col("x"), "double", T.IntegerType())).collect()] == [1, None, None, None]


def test_fingerprint(spark):
    rows = [(1, "a"), (2, None), (2, None), (3, "c")]
    h = lambda r: spark.createDataFrame(r, "k int, v string").agg(multiset_hash(row_text(["k", "v"])).alias("h")).first()["h"]
    assert h(rows) == h(rows[::-1])
    assert h(rows) != h(rows[:3] + [(3, "d")]) and h(rows) != h(rows[:-1]) and h(rows) != h(rows + rows[:1])
    assert h([]) == "0:0"
    half = spark.sql("SELECT conv(substring(md5('abc'), 1, 16), 16, -10) AS x").first()["x"]
    assert int(half) == int.from_bytes(bytes.fromhex("900150983cd24fb0"), "big", signed=True)
