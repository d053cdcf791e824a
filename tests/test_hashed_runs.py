"""Single runs and shared runs that tell rows apart by id and hash (F12, F13)."""

import contextlib
import io
import re

import pytest
from pyspark.sql import functions as F

from qualstar.operators import dq
from qualstar.operators.rules import default_rules
from qualstar.params import GRANT_COLUMNS, DQParams
from qualstar.sources.adapters import grant_applications, times_resubmitted

SF = "/root/testdata/sf0.001"
P = DQParams(as_of="2001-12-01 00:00:00")
RULES = default_rules(P)
ROW = ("A1", "S1234567A", "Education Bursary", 1.0, 3, "2001-01-15", "Approved", 100.0, 50.0, "2001-01-20")


def _direct(df):
    return dq.score_aggregates_direct(df, RULES, P).first().asDict()


def _by_rows(df):
    return dq.score_aggregates(dq.evaluate_weighted(df, RULES, P), RULES).first().asDict()


def _rows(spark, *changes):
    names = [n for n, _ in GRANT_COLUMNS]
    rows = [tuple(c.get(n, v) for n, v in zip(names, ROW)) for c in changes]
    return spark.createDataFrame(rows, ", ".join(f"{n} {t}" for n, t in GRANT_COLUMNS))


def test_different_rows_are_not_collapsed_in_full(spark, monkeypatch):
    df = grant_applications(spark, SF).dropDuplicates()
    want = _by_rows(df)
    full = []
    monkeypatch.setattr(dq, "_direct_full", lambda *a: full.append(a), raising=False)
    monkeypatch.setattr(dq, "collapse_copies", full.append)     # the run before shuffled the full rows
    assert _direct(df) == want and not full


@pytest.mark.parametrize("changes", [
    [{}, {}, {}],                                                                  # copies
    [{"household_income": 0.0}, {"household_income": -0.0}],                       # equal, other bits
    [{"household_income": float("nan")}, {"household_income": float("nan")}, {}],
    [{"citizen_nric": None, "grant_scheme_name": "x"}, {"citizen_nric": "x", "grant_scheme_name": None}],   # a NULL moves
    [{"application_id": None}, {"application_id": None}, {"application_id": None, "household_size": 4}, {}],
    [{"application_date": d} for d in (None, "NA", "15/1/2001", "1-15-2001", " 2001-01-15 ", "2001-01-15T10:00:00", "2001-02-30")],
    [{"decision_date": d} for d in (None, "2001-1-20", " 2001-01-20", "20/01/2001", "na", "2001-02-30", "2001-01-20T00:00:00")],
])
def test_as_by_rows(spark, changes):
    df = _rows(spark, *changes)
    assert _direct(df) == _by_rows(df)


def test_rows_with_one_hash_are_told_apart(spark, monkeypatch):
    df = grant_applications(spark, SF).limit(500).localCheckpoint()
    df = df.unionByName(df.withColumn("household_size", F.col("household_size") + 1)).unionByName(df.limit(50))
    want = _by_rows(df)
    monkeypatch.setattr(dq, "_row_hash", lambda columns: F.lit(1).cast("long"), raising=False)
    assert _direct(df) == want


def test_text_under_a_collation(spark):
    df = _rows(spark, {}, {"grant_scheme_name": "EDUCATION BURSARY"}).withColumn("grant_scheme_name", F.collate("grant_scheme_name", "UTF8_LCASE"))
    assert _direct(df)["pass_U002"] == 1


def test_no_rows(spark):
    got = _direct(_rows(spark, {}).limit(0))
    assert got["total_rows"] == 0 and not any(got.values())


@pytest.mark.parametrize("times", [{"": None}, {"_run0": F.lit, "_run1": times_resubmitted}])
def test_rows_are_judged_once_in_methods_that_compile(spark, times):
    times = {s: t if t is None else (t(1) if t is F.lit else t()).cast("long") for s, t in times.items()}
    old = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        out = dq._direct_hashed(grant_applications(spark, SF), times, RULES, P, "application_id")
        plan = io.StringIO()
        with contextlib.redirect_stdout(plan):
            out.explain("codegen")
        executed = out._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", old)
    assert max(int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", plan.getvalue())) < 8000
    assert executed.count("FileScan parquet") == 2 and executed.count("ReusedExchange") == 1    # lineitem and orders
