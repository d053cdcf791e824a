"""Plans of the DQ run at size: what a row costs must not hang on how many rules there are."""

import contextlib
import io
import re

import pytest
from pyspark.sql import functions as F

from qualstar.functions.dates import is_strict_iso_date, parse_flexible
from qualstar.operators import dq
from qualstar.operators.rules import default_rules
from qualstar.params import DQParams
from qualstar.plans import registry_io
from qualstar.sources.adapters import grant_applications, grant_applications_resubmitted

SF = "/root/testdata/sf0.001"
P = DQParams(as_of="2001-12-01 00:00:00")


def test_rule_aggregate_is_small_enough_for_the_jit(spark):
    """The JVM compiles no method above 8 000 bytes; the rules ran interpreted."""
    old = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = io.StringIO()
        with contextlib.redirect_stdout(plan):
            dq.score_aggregates_direct(grant_applications(spark, SF), default_rules(P), P).explain("codegen")
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", old)
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", plan.getvalue())]
    assert sizes and max(sizes) < 8000


def test_resubmission_reads_the_tables_once(spark):
    twice = grant_applications_resubmitted(spark, SF)
    assert twice._jdf.queryExecution().executedPlan().toString().count("FileScan parquet") == 2   # lineitem and orders
    once = grant_applications(spark, SF)
    assert twice.exceptAll(once.unionByName(once.filter("application_status = 'Rejected'"))).isEmpty()
    assert twice.count() == once.count() + once.filter("application_status = 'Rejected'").count()


@pytest.mark.parametrize("space", [" ", "\t", "\n", "\r\n", "　", "\x1c", "\x85"])
def test_white_space_of_any_kind(spark, space):
    df = spark.createDataFrame([(f"{space}2024-01-15{space}",), (f"{space}15/1/2024{space}",), (f"2024{space}-01-15",)], "s string")
    got = [tuple(r) for r in df.select(parse_flexible("s").cast("string"), is_strict_iso_date("s")).collect()]
    assert got == [("2024-01-15 00:00:00", True), ("2024-01-15 00:00:00", False), (None, False)]


def test_no_date_is_parsed_with_a_formatter(spark):
    df = spark.createDataFrame([("2024-01-15",)], "s string")
    plan = df.select(parse_flexible(F.col("s")))._jdf.queryExecution().analyzed().toString()
    assert "gettimestamp" not in plan.lower() and "to_timestamp" not in plan.lower()


def test_stream_uniqueness_keeps_little_and_sees_copies_later(spark, monkeypatch):
    seen = {}
    read = registry_io.uniqueness_results
    monkeypatch.setattr(registry_io, "uniqueness_results", lambda s, counts: seen.update(counts=counts) or read(s, counts))
    out = registry_io.q_stream_uniqueness(spark, SF)
    changes = spark.read.parquet(seen["counts"])
    assert changes.select(F.max(F.length("content"))).first()[0] == 16          # 64 characters of hex before
    copied = changes.filter("copies > 1")
    assert copied.count() > 0 and copied.join(changes.filter("copies = 1"), ["application_id", "content"]).count() == copied.count()
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "Union" not in plan                                                  # both rules from one pass over the counts
