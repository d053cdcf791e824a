import datetime as dt

from pyspark.sql import functions as F

from qualstar.functions.dates import (can_canonicalise, compare_dates_ge, days_between, is_strict_iso_date,
                                      parse_flexible)


def col_of(spark, values, fn):
    df = spark.createDataFrame([(v,) for v in values], "s string")
    return [r[0] for r in df.select(fn(F.col("s"))).collect()]


def test_five_layouts(spark):
    vals = ["2024-01-15", "15/01/2024", "01-15-2024", "2024-01-15T10:30:00", "2024-01-15T10:30:00.123456",
            "2024-1-5", "5/1/2024", "2024-01-15T10:30:00.5"]
    got = col_of(spark, vals, parse_flexible)
    assert got == [dt.datetime(2024, 1, 15), dt.datetime(2024, 1, 15), dt.datetime(2024, 1, 15),
                   dt.datetime(2024, 1, 15, 10, 30), dt.datetime(2024, 1, 15, 10, 30, 0, 123456),
                   dt.datetime(2024, 1, 5), dt.datetime(2024, 1, 5), dt.datetime(2024, 1, 15, 10, 30, 0, 500000)]


def test_placeholders_blank_and_garbage(spark):
    vals = [None, "", "   ", "NOT_A_DATE", "invalid_date", "n/a", "NA", "NULL", "2024-02-30", "24-01-15",
            "2024-001-05", "-2024-01-01", "0000-01-01", "2024-01-15 trailing", "15.01.2024"]
    assert col_of(spark, vals, parse_flexible) == [None] * len(vals)


def test_whitespace_is_stripped(spark):
    assert col_of(spark, ["  2024-01-15\t", "\n15/01/2024 "], parse_flexible) == [dt.datetime(2024, 1, 15)] * 2


def test_strict_iso(spark):
    vals = ["2024-01-15", " 2024-01-15 ", "2024-1-15", "2024-02-30", "15/01/2024", "2024-01-15T00:00:00", None, "",
            "abcd-ef-gh"]
    assert col_of(spark, vals, is_strict_iso_date) == [True, True, False, False, False, False, False, False, False]


def test_can_canonicalise(spark):
    vals = ["2024-01-15", "01-15-2024", "NOT_A_DATE", None]
    assert col_of(spark, vals, can_canonicalise) == [True, True, False, False]


def test_day_difference_floors(spark):
    df = spark.createDataFrame([("2024-01-15", "2024-01-01"), ("2024-01-01", "2024-01-15"),
                                ("2024-01-05", "2024-01-01T10:30:00"), ("2024-01-01", "2024-01-01T10:30:00"),
                                ("bad", "2024-01-01")], "a string, b string")
    out = df.select(days_between(parse_flexible("a"), parse_flexible("b")).alias("d"),
                    compare_dates_ge("a", "b").alias("ge")).collect()
    assert [r.d for r in out] == [14, -14, 3, -1, None]
    assert [r.ge for r in out] == [True, False, True, False, None]


def test_days_since(spark):
    from qualstar.functions.dates import days_since
    df = spark.createDataFrame([("2024-01-01",), ("2023-12-31T12:00:00",), ("bad",)], "s string")
    got = [r[0] for r in df.select(days_since("s", "2024-01-31 00:00:00")).collect()]
    assert got == [30, 30, None]
