import datetime as dt

import pytest
from pyspark.sql import functions as F

from starloom.functions.calendar import date_dimension, day_range, with_hierarchy
from starloom.functions.derive import apply_derived, arithmetic, compare, date_diff, date_to_key
from starloom.functions.masking import hash_pii, missing_pii, redact
from starloom.functions.rules import date_ok, email_ok, phone_ok, type_ok
from starloom.functions.text import canonical_text, normalize_timestamp, null_text_to_null
from starloom.specs import Arithmetic, DateDiff, Expr, Term, columns


def values(df, col):
    return [r[0] for r in df.select(col).collect()]


@pytest.fixture
def spans(spark):
    data = [
        ("2024-01-01 00:00:00", "2024-01-01 00:00:30"),  # 0.5 min -> 0
        ("2024-01-01 00:00:00", "2024-01-01 00:01:30"),  # 1.5 min -> 2
        ("2024-01-01 00:00:00", "2024-01-01 00:02:30"),  # 2.5 min -> 2
        ("2024-01-01 00:01:30", "2024-01-01 00:00:00"),  # -1.5 -> -2
        ("2024-01-02 00:00:00", "2024-01-01 23:00:00"),
        (None, "2024-01-01 00:00:00"),
        ("not a date", "2024-01-01 00:00:00"),
    ]
    return spark.createDataFrame(data, "a string, b string")


def test_date_diff_rounds_half_even(spans):
    assert values(spans, date_diff("a", "b", "m")) == [0, 2, 2, -2, -60, 0, 0]
    assert values(spans, date_diff("a", "b", "s")) == [30, 90, 150, -90, -3600, 0, 0]
    assert values(spans, date_diff("a", "b", "h")) == [0, 0, 0, 0, -1, 0, 0]


def test_date_diff_days_floor(spans):
    assert values(spans, date_diff("a", "b", "d")) == [0, 0, 0, -1, -1, 0, 0]


def test_date_diff_can_keep_null(spans):
    assert values(spans, date_diff("a", "b", null_as_zero=False))[-2:] == [None, None]
    with pytest.raises(ValueError):
        date_diff("a", "b", "week")


def test_date_diff_ignores_clock_changes(spark):
    df = spark.sql("select timestamp_ntz'2024-03-10 01:00:00' a, timestamp_ntz'2024-03-10 04:00:00' b")
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert values(df, date_diff("a", "b", "h")) == [3]
        assert values(df, date_to_key("b")) == [20240310]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_compare_null_operand(spark):
    df = spark.createDataFrame([(1, 2), (2, 2), (None, 2), (None, None)], "a int, b int")
    expected = {
        "<": [True, False, False, False],
        "<=": [True, True, False, False],
        ">": [False, False, False, False],
        ">=": [False, True, False, False],
        "==": [False, True, False, False],
        "!=": [True, False, True, True],
    }
    for op, want in expected.items():
        assert values(df, compare("a", op, "b")) == want, op


def test_compare_text_as_number_or_time(spark):
    df = spark.createDataFrame([("10", "9")], "a string, b string")
    assert values(df, compare("a", ">", "b")) == [False]
    assert values(df, compare("a", ">", "b", "number")) == [True]
    df = spark.createDataFrame([("2024-01-02", "2024-01-01 23:00:00")], "a string, b string")
    assert values(df, compare("a", ">", "b", "timestamp")) == [True]


def test_arithmetic(spark):
    df = spark.createDataFrame([("4", "2", 0), ("x", None, 3)], "a string, b string, z int")
    assert values(df, arithmetic([Term("a", "-", 2), Term("b", "+")])) == [10.0, 0.0]
    assert values(df, arithmetic([Term("a"), Term("b", "-", 0.5)])) == [3.0, 0.0]
    assert values(df, arithmetic([Term("a"), Term("b", "*", 3, right_column="z")])) == [0.0, 0.0]
    assert values(df, arithmetic([Term("a"), Term("z", "/")])) == [None, 0.0]
    with pytest.raises(ValueError):
        arithmetic([Term("a"), Term("b", "%")])


def test_derived_columns_see_earlier_ones(spark):
    df = spark.sql("select timestamp_ntz'2024-01-01' s, timestamp_ntz'2024-01-01 02:00:00' e")
    steps = [DateDiff("m", "e", "s"), Arithmetic("twice", (Term("m", factor=2),)), Expr("big", "twice > 200")]
    assert apply_derived(df, steps).select("m", "twice", "big").first() == (120, 240.0, True)


def test_masking(spark):
    df = spark.createDataFrame([("a@b.c", 5), (None, 6)], "email string, id int")
    hashed = hash_pii(df, ["email", "phone"]).collect()
    assert len(hashed[0].email) == 64 and hashed[1].email is None
    assert missing_pii(df, ["email", "phone"]) == ["phone"]
    assert values(redact(df, ["email"]), "email") == ["***", "***"]


@pytest.mark.parametrize(
    "kind, good, bad",
    [
        ("int", ["1", " -7 ", "+3"], ["1.5", "x", "", "99999999999"]),
        ("bigint", ["201234567890"], ["1e3"]),
        ("double", ["1", "-1.5", ".5", "1e3", "2."], ["1,5", "abc", "1d"]),
        ("boolean", ["true", "False", "TRUE"], ["yes", "1", "t"]),
        ("date", ["2024-01-31", "2024-01-31 10:00:00"], ["N/A", "invalid-date", "2024-02-30"]),
        ("timestamp_ntz", ["2024-01-31 10:00:00", "2024-01-31"], ["soon"]),
        ("string", ["anything", "1"], []),
    ],
)
def test_type_ok(spark, kind, good, bad):
    dtype = columns(f"c {kind}")["c"].dataType
    df = spark.createDataFrame([(v, True) for v in good] + [(v, False) for v in bad], "c string, ok boolean")
    assert df.filter(type_ok(F.col("c"), dtype) != F.col("ok")).collect() == []
    null = spark.createDataFrame([(None,)], "c string")
    assert values(null, type_ok(F.col("c"), dtype)) == [None]


def test_rules(spark):
    df = spark.createDataFrame([("a@b.co", "+2012345678", "2024-01-01"), ("notanemail", "abc1234", "N/A"), ("@no-domain", "", "x")], "e string, p string, d string")
    assert values(df, email_ok(F.col("e"))) == [True, False, False]
    assert values(df, phone_ok(F.col("p"))) == [True, False, False]
    assert values(df, date_ok(F.col("d"))) == [True, False, False]


def test_text(spark):
    df = spark.createDataFrame([("2024-01-02",), ("2024-01-02 03:04:05.6",), ("x",), (None,)], "t string")
    assert values(df, normalize_timestamp(F.col("t"))) == ["2024-01-02 00:00:00", "2024-01-02 03:04:05", "x", None]
    df = spark.createDataFrame([("nan",), (" NaN ",), ("a",), (None,)], "t string")
    assert values(df, null_text_to_null(F.col("t"))) == [None, None, "a", None]


def test_canonical_text(spark):
    df = spark.createDataFrame([("1.0", 2.0), (" a ", 2.5), ("2024-01-02 10:00:00", None)], "t string, d double")
    s, d = df.schema["t"].dataType, df.schema["d"].dataType
    assert values(df, canonical_text(F.col("t"), s)) == ["1", "a", "2024-01-02"]
    assert values(df, canonical_text(F.col("d"), d)) == ["2", "2.5", None]


def test_date_dimension(spark):
    days = day_range(spark, "2024-02-28", "2024-03-03")
    out = {r.date_id: r for r in date_dimension(days).collect()}
    assert sorted(out) == [20240228, 20240229, 20240301, 20240302, 20240303]
    saturday = out[20240302]
    assert (saturday.day, saturday.month, saturday.quarter, saturday.day_of_week, saturday.is_weekend) == (
        "Saturday",
        "March",
        "Q1",
        5,
        True,
    )
    levels = with_hierarchy(days).filter("day = 29").first()
    assert levels.full_date == dt.date(2024, 2, 29)
    assert (levels.year, levels.month_no, levels.quarter) == (2024, 2, "Qtr 1")
