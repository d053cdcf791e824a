"""Malformed CSV records, routed layers, result CSV, run history, uniqueness over a stream."""

import os
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from qualstar.operators.dq import rule_counts
from qualstar.operators.rules import rules_by_id
from qualstar.params import DQParams, TAX_COLUMNS
from qualstar.plans import history
from qualstar.plans.dq import run_analysis
from qualstar.plans.tax import Paths, run_full_pipeline
from qualstar.sinks import writers
from qualstar.sources import checked
from qualstar.sources.files import GRANT_SCHEMA, TAX_SCHEMA, read_postal_lookup
from qualstar.streaming.uniqueness import compact_counts, start_uniqueness_monitor, uniqueness_results

from test_pipeline import GRANT_ROWS, TAX_ROWS, write_csv

HEADER = ",".join(n for n, _ in TAX_COLUMNS)


def tax_line(i, **changes):
    values = dict(zip([n for n, _ in TAX_COLUMNS], TAX_ROWS[0], strict=True)) | {"taxpayer_id": f"T{i}"} | changes
    return ",".join(values.values())


@pytest.fixture()
def csv(tmp_dir):
    lines = [tax_line(1), tax_line(2, annual_income_sgd="abc"), tax_line(3) + ",more,and more", ",".join(tax_line(4).split(",")[:7]),
             tax_line(5, full_name='"Tan ""W"", Wei"'), tax_line(6, number_of_dependents="1.5", tax_paid_sgd="x"), tax_line(7, foreign_income_sgd=""), "T8"]
    path = os.path.join(tmp_dir, "returns.csv")
    with open(path, "w") as f:
        f.write("\n".join([HEADER, *lines]) + "\n")
    return path


def test_malformed_records_are_kept_apart(spark, csv):
    got = checked.read_tax_csv_checked(spark, csv)
    assert got.good.columns == TAX_SCHEMA.names
    good = {r.taxpayer_id: r for r in got.good.collect()}
    assert sorted(good) == ["T1", "T5", "T7"] and good["T5"].full_name == 'Tan "W", Wei' and good["T7"].foreign_income_sgd is None
    bad = {r.taxpayer_id: (r.n_fields, r.bad_fields) for r in got.bad.collect()}
    assert bad == {"T2": (18, "annual_income_sgd"), "T3": (20, ""), "T4": (7, ""), "T6": (18, "tax_paid_sgd,number_of_dependents"), "T8": (1, "")}
    assert {r.record for r in got.bad.filter("taxpayer_id = 'T2'").collect()} == {tax_line(2, annual_income_sgd="abc")}
    assert all(r.source_file.endswith("returns.csv") for r in got.bad.collect())


def test_a_record_is_judged_by_all_its_fields_whichever_are_read(spark, csv):
    got = checked.read_tax_csv_checked(spark, csv)
    assert got.good.count() == 3 and got.bad.count() == 5
    assert sorted(r[0] for r in got.good.select("taxpayer_id").collect()) == ["T1", "T5", "T7"]
    assert {r.outcome: r.n_rows for r in checked.reject_counts(got, 18).collect()} == {"good": 3, "wrong_field_count": 3, "bad_value": 2}


def test_quarantine_of_the_bronze_step(spark, tmp_dir, csv):
    paths = Paths(*(os.path.join(tmp_dir, p) for p in ("bronze", "silver", "rejected", "gold")), quarantine=os.path.join(tmp_dir, "quarantine"))
    out = run_full_pipeline(spark, csv, paths, ingestion_timestamp="2024-01-01T00:00:00")
    assert out["bronze"].count() == 3 and spark.read.parquet(paths.quarantine).count() == 5
    assert sum(out["class_counts"].values()) == 3


def test_header_only_file(spark, tmp_dir):
    path = os.path.join(tmp_dir, "empty.csv")
    with open(path, "w") as f:
        f.write(HEADER + "\n")
    got = checked.read_tax_csv_checked(spark, path)
    assert got.good.count() == 0 and got.bad.count() == 0


def test_csv_lines_have_a_header_in_every_file(spark, tmp_dir):
    path = os.path.join(tmp_dir, "lines")
    writers.write_csv_lines(spark.range(100).select(F.col("id").cast("string").alias("x")).repartition(7), path, "id")
    assert sorted(r.id for r in spark.read.schema("id long").option("header", True).csv(path).collect()) == list(range(100))


# --- routed layers ---------------------------------------------------------------

def routed(spark, tmp_dir):
    rows = spark.range(1200).selectExpr("id", "cast(if(id % 50 = 0, null, 2000 + id % 6) as int) assessment_year", "if(id % 3 = 0, 'rejected', 'silver') to")
    path = os.path.join(tmp_dir, "layers")
    seen = writers.write_routed(rows.drop("to"), path, F.expr("if(id % 3 = 0, 'rejected', 'silver')"), metrics={"odd": F.count_if(F.col("id") % 2 == 1)})
    return rows, path, seen


def test_one_write_routes_all_rows(spark, tmp_dir):
    rows, path, seen = routed(spark, tmp_dir)
    assert seen == {"rows": 1200, "odd": 600}
    schema = rows.drop("to").schema
    for to in ("silver", "rejected"):
        got = writers.read_routed(spark, path, schema, to)
        assert set(got.columns) == {"id", "assessment_year"}
        assert sorted(map(tuple, got.select("id", "assessment_year").collect()), key=str) == sorted(map(tuple, rows.filter(F.col("to") == to).drop("to").collect()), key=str)
    assert writers.read_routed(spark, path, schema, "nowhere").count() == 0
    with pytest.raises(writers.WriteGuardError):
        writers.write_routed(rows.drop("assessment_year"), path, F.lit("x"))


def test_readers_scan_their_folders_only(spark, tmp_dir):
    rows, path, _ = routed(spark, tmp_dir)
    schema = rows.drop("to").schema
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    fixed = writers.read_routed(spark, path, schema, "silver").filter("assessment_year >= 2004")
    text = plan(fixed)
    assert "PartitionFilters: [isnotnull(output" in text and "assessment_year" in text.split("PartitionFilters")[1].split("PushedFilters")[0]
    years = os.path.join(tmp_dir, "years")
    spark.createDataFrame([(2000 + i, i / 10) for i in range(6)], "assessment_year int, share double").write.parquet(years)
    joined = writers.read_routed(spark, path, schema, "silver").join(spark.read.parquet(years).filter("share >= 0.4"), "assessment_year")
    assert "dynamicpruning" in plan(joined)
    assert joined.count() == rows.filter("to = 'silver' and assessment_year >= 2004").count()


def test_the_job_with_routed_layers(spark, tmp_dir):
    src = os.path.join(tmp_dir, "returns.csv")
    write_csv(src, [c for c, _ in TAX_COLUMNS], TAX_ROWS)
    apart = Paths(*(os.path.join(tmp_dir, p) for p in ("b1", "s1", "r1", "g1")))
    one = Paths(*(os.path.join(tmp_dir, p) for p in ("b2", "s2", "r2", "g2")), layers=os.path.join(tmp_dir, "layers"))
    a, b = (run_full_pipeline(spark, src, p, ingestion_timestamp="2024-01-01T00:00:00") for p in (apart, one))
    assert a["class_counts"] == b["class_counts"]
    for layer in ("silver", "rejected"):
        cols = sorted(a[layer].columns)
        assert sorted(b[layer].columns) == cols
        assert sorted(map(str, a[layer].select(cols).collect())) == sorted(map(str, b[layer].select(cols).collect()))
    assert {k: v.count() for k, v in a["gold"].items()} == {k: v.count() for k, v in b["gold"].items()}


def test_rows_without_a_year_are_left_out_in_one_pass(spark, tmp_dir):
    rows = spark.range(100).selectExpr("id", "cast(if(id % 10 = 0, null, 2020) as int) assessment_year")
    path = os.path.join(tmp_dir, "t")
    assert writers.write_partitioned(rows, path, on_null="drop") == 90 == spark.read.parquet(path).count()
    assert writers.write_partitioned(rows.filter("assessment_year is null"), path, on_null="drop") == 0
    assert spark.read.schema("id long, assessment_year int").parquet(path).count() == 0


# --- results and history ------------------------------------------------------------

def test_result_csv_round_trip(spark, tmp_dir):
    schema = "name string, n long, rate double, at timestamp, ok boolean"
    rows = [('say "hi", you', 1, 0.1, datetime(2024, 1, 2, 3, 4, 5, 678000), True), ("", None, None, None, None), (None, -5, 1e-9, datetime(1999, 12, 31), False),
            ("two\nlines", 2 ** 60, 33.33, None, True), ("back\\slash", 0, 2.5, None, None), ("ünï", 3, 1.0, None, None)]
    df = spark.createDataFrame(rows, schema)
    path = os.path.join(tmp_dir, "out")
    writers.write_small_csv(df, path)
    assert sorted(map(str, writers.read_result_csv(spark, path, df.schema).collect())) == sorted(map(str, df.collect()))
    with pytest.raises(Exception, match="(?i)malformed"):
        writers.read_result_csv(spark, path, spark.createDataFrame([], "name long, n long, rate double, at timestamp, ok boolean").schema).collect()


def test_a_replayed_run_replaces_its_records(spark, tmp_dir):
    base, out = os.path.join(tmp_dir, "hist"), os.path.join(tmp_dir, "out")
    rows = [tuple(None if v == "" else (float(v) if t == "double" else int(v) if t == "int" else v) for v, t in zip(r, (f.dataType.simpleString() for f in GRANT_SCHEMA), strict=True)) for r in GRANT_ROWS]
    data = spark.createDataFrame(rows, GRANT_SCHEMA)
    params = DQParams(as_of="2024-06-01 00:00:00")

    def run(id_, day, df):
        return run_analysis(spark, df, out, params, execution_id=id_, execution_timestamp=datetime(2024, 6, day), history_dir=base)

    run("1", 1, data)
    run("02", 2, data.limit(1))
    with pytest.raises(Exception):
        run("x", 3, os.path.join(tmp_dir, "missing.csv"))
    run("1", 4, data.limit(2))
    got = {r.execution_id: (r.status, r.total_rows, r.execution_timestamp.day) for r in history.load(spark, base, "dq_execution").collect()}
    assert got == {"1": ("SUCCESS", 2, 4), "02": ("SUCCESS", 1, 2), "x": ("FAILED", 0, 3)}
    scores = history.load_scores(spark, base)
    assert scores.count() == 12 and {(r.execution_id, r.total_rows) for r in scores.collect()} == {("1", 2), ("02", 1)}
    assert history.load_scores(spark, base, "dq_rule_results").count() == 50
    # A replay that fails takes the run's scores out of account.
    with pytest.raises(Exception):
        run("02", 5, os.path.join(tmp_dir, "missing.csv"))
    assert {r.execution_id for r in history.load_scores(spark, base).collect()} == {"1"}
    assert {r.execution_id for r in history.dimension_trend(history.load_scores(spark, base)).collect()} == {"1"}


def test_lookup_from_json_with_gaps(spark, tmp_dir):
    path = os.path.join(tmp_dir, "d.json")
    with open(path, "w") as f:
        f.write('[\n {"district": 1, "area": "A", "postal_codes": ["01", "02"], "region": "Core", "more": 1},\n {"district": 2, "area": null, "postal_codes": [], "region": "West"},\n {"area": "C", "postal_codes": ["03"]}\n]')
    got = sorted(map(tuple, read_postal_lookup(spark, path).collect()))
    assert got == [("01", "Core", "A"), ("02", "Core", "A"), ("03", None, "C")]


# --- uniqueness over batches -----------------------------------------------------------

def test_uniqueness_over_batches_restarts_and_replays(spark, tmp_dir):
    inbox, counts, ck = (os.path.join(tmp_dir, p) for p in ("inbox", "counts", "ck"))
    row = lambda i, income=1.0: (f"A{i}" if i is not None else None, None, "S", income, 1, None, "Pending", None, None, None)
    batches = [[row(1), row(2), row(3)] + [row(9)] * 500, [row(1), row(2, 5.0), row(4), row(None)], [row(1), row(None)] + [row(9)] * 300 + [row(9, 2.0)]]
    seen = []
    for k, rows in enumerate(batches):
        spark.createDataFrame(rows, GRANT_SCHEMA).coalesce(1).write.mode("append").parquet(inbox)
        seen += rows
        # A new query from the same checkpoint each time, as after a restart.
        start_uniqueness_monitor(spark, inbox, counts, ck, source_format="parquet").awaitTermination()
        got = {(r.rule_id, r.application_id, r.passed): r.n_rows for r in uniqueness_results(spark, counts).collect()}
        whole = spark.createDataFrame(seen, GRANT_SCHEMA)
        rules = rules_by_id(DQParams(as_of="2024-06-01 00:00:00"))
        want = {(u, r.application_id, r.passed): r.n_rows for u in ("U001", "U002") for r in rule_counts(whole, rules[u]).collect()}
        assert got == want, k
    assert got["U001", "A9", False] == 801 and got["U002", "A9", True] == 2 and got["U002", "A9", False] == 799
    # A batch that is run again writes the same counts.
    again = spark.read.parquet(f"{counts}/batch_id=1")
    rows = again.collect()
    spark.createDataFrame(rows, again.schema).write.mode("overwrite").parquet(f"{counts}/batch_id=1")
    assert {(r.rule_id, r.application_id, r.passed): r.n_rows for r in uniqueness_results(spark, counts).collect()} == want
    small = os.path.join(tmp_dir, "small")
    compact_counts(spark, counts, small)
    assert {(r.rule_id, r.application_id, r.passed): r.n_rows for r in uniqueness_results(spark, small).collect()} == want
