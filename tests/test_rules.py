import datetime as dt

import pytest
from pyspark.sql import functions as F

from qualstar.operators import dq
from qualstar.operators.rules import Rule, default_rules, rules_by_id
from qualstar.params import DQParams

SCHEMA = ("application_id string, citizen_nric string, grant_scheme_name string, household_income double, "
          "household_size int, application_date string, application_status string, requested_amount double, "
          "approved_amount double, decision_date string")
P = DQParams(as_of="2024-06-01 00:00:00")


def row(**kw):
    base = dict(application_id="A1", citizen_nric="S1234567A", grant_scheme_name="Education Bursary",
                household_income=1000.0, household_size=3, application_date="2024-01-01",
                application_status="Approved", requested_amount=500.0, approved_amount=400.0,
                decision_date="2024-01-10")
    base.update(kw)
    return tuple(base[k] for k in ["application_id", "citizen_nric", "grant_scheme_name", "household_income",
                                   "household_size", "application_date", "application_status",
                                   "requested_amount", "approved_amount", "decision_date"])


def rule_values(spark, rule_id, rows, params=P):
    df = spark.createDataFrame(rows, SCHEMA)
    table = dq.evaluate_all(df, [rules_by_id(params)[rule_id]], params)
    col = f"rule_{rule_id}_pass"
    return sorted(((r["application_id"], r[col]) for r in table.select("application_id", col).collect()), key=str)


def passes(spark, rule_id, **kw):
    return rule_values(spark, rule_id, [row(**kw)])[0][1]


@pytest.mark.parametrize("rid,kw,expected", [
    ("C001", dict(application_id="  "), False), ("C001", dict(application_id=None), False),
    ("C002", dict(application_date=None), False), ("C003", dict(application_status=""), False),
    ("C004", dict(requested_amount=None), False),
    ("C005", dict(approved_amount=None), False), ("C005", dict(application_status="Pending", approved_amount=None), True),
    ("C006", dict(application_status="Rejected", decision_date=None), False),
    ("V001", dict(citizen_nric="INVALID_NRIC"), False), ("V001", dict(citizen_nric=None), False),
    ("V002", dict(household_income=-1.0), False), ("V002", dict(household_income=1e7), False),
    ("V002", dict(household_income=None), None),
    ("V003", dict(requested_amount=None), None), ("V004", dict(approved_amount=-5.0), False),
    ("V005", dict(household_size=21), False), ("V005", dict(household_size=0), False),
    ("V006", dict(application_status="Pending"), False), ("V006", dict(application_status=None), True),
    ("V007", dict(decision_date="N/A"), False), ("V007", dict(application_date=None), None),
    ("V007", dict(citizen_nric=None, decision_date=None), True),
    ("CF001", dict(decision_date="10/01/2024"), False), ("CF001", dict(decision_date=None), True),
    ("CF002", dict(application_date="01-15-2024"), True), ("CF002", dict(application_date=None), False),
    ("CF002", dict(application_date="NOT_A_DATE"), False),
    ("CF003", dict(application_status="approved"), False), ("CF003", dict(application_status=None), None),
    ("CF004", dict(grant_scheme_name="healthcare subsidy"), True), ("CF004", dict(grant_scheme_name="X"), False),
    ("CS001", dict(decision_date="2023-12-31"), False), ("CS001", dict(decision_date="INVALID_DATE"), False),
    ("CS001", dict(decision_date=None), True),
    ("CS002", dict(approved_amount=600.0), False), ("CS002", dict(approved_amount=0.0), False),
    ("CS002", dict(approved_amount=None), None),
    ("CS003", dict(application_status="Pending"), False), ("CS004", dict(decision_date=None), False),
])
def test_rule_cases(spark, rid, kw, expected):
    assert passes(spark, rid, **kw) is expected


@pytest.mark.parametrize("lag,expected", [(14, True), (29, True), (30, True), (31, False), (45, False), (-14, False)])
def test_t001_sla(spark, lag, expected):
    dec = (dt.date(2024, 1, 1) + dt.timedelta(days=lag)).isoformat()
    assert passes(spark, "T001", decision_date=dec) is expected


def test_t001_not_applicable_and_invalid(spark):
    assert passes(spark, "T001", application_status="Pending", decision_date="2025-01-01") is True
    assert passes(spark, "T001", decision_date=None) is True
    assert passes(spark, "T001", decision_date="INVALID_DATE") is False
    # 30 days and 13.5 hours floors to 30 -> within SLA
    assert passes(spark, "T001", application_date="2024-01-01T10:30:00", decision_date="2024-02-01") is True


@pytest.mark.parametrize("days,expected", [(365, True), (5 * 365, True), (5 * 365 + 1, False), (6 * 365, False)])
def test_t002_age(spark, days, expected):
    app = (dt.date(2024, 6, 1) - dt.timedelta(days=days)).isoformat()
    assert passes(spark, "T002", application_date=app) is expected


def test_t002_missing_and_unparsable(spark):
    assert passes(spark, "T002", application_date=None) is True
    assert passes(spark, "T002", application_date="NOT_A_DATE") is False


def test_u001_marks_every_copy_and_nulls_group(spark):
    rows = [row(application_id="A"), row(application_id="A", household_size=4), row(application_id="B"),
            row(application_id=None), row(application_id=None, household_size=5)]
    got = rule_values(spark, "U001", rows)
    assert sorted(got, key=str) == sorted([("A", False), ("A", False), ("B", True), (None, False), (None, False)], key=str)


def test_u002_first_copy_passes(spark):
    rows = [row(application_id="A")] * 3 + [row(application_id="B")]
    got = rule_values(spark, "U002", rows)
    assert sorted(got) == [("A", False), ("A", False), ("A", True), ("B", True)]


def test_broken_rule_is_all_false(spark):
    broken = Rule("X001", "broken", "Validity", lambda df, p: F.col("no_such_column") > 1)
    df = spark.createDataFrame([row(), row(application_id="A2")], SCHEMA)
    w = dq.evaluate_weighted(df, [broken], P)
    assert [r[0] for r in w.select("rule_X001_pass").collect()] == [False, False]


def test_missing_column_counts_as_all_fail_and_empty_input(spark):
    df = spark.createDataFrame([row()], SCHEMA).drop("decision_date")
    rules = default_rules(P)
    agg = dq.score_aggregates(dq.evaluate_weighted(df, rules, P), rules)
    res = {r.rule_id: r for r in dq.rule_results(agg, rules, "x").collect()}
    assert res["CS003"].failure_rate == 100.0 and res["C001"].failure_rate == 0.0
    empty = spark.createDataFrame([], SCHEMA)
    agg = dq.score_aggregates(dq.evaluate_weighted(empty, rules, P), rules)
    assert {r.failure_rate for r in dq.rule_results(agg, rules, "x").collect()} == {0.0}
    assert {r.score for r in dq.dimension_scores(agg, rules, "x").collect()} == {0.0}


def test_one_pass_counts_equal_row_level_brute_force(spark):
    """Collapsed, weighted one-pass counts == per-row evaluation with windows
    (count per id, row_number per identical row) on a fixture with a hot copy
    group (a third of the rows identical) and null ids."""
    hot = [row(application_id="HOT", decision_date="2024-03-30")] * 30
    rest = [row(application_id=f"A{i % 37}", household_size=i % 25, household_income=float(i * 100 - 500),
                application_status=["Approved", "Rejected", "Pending", "approved", None][i % 5],
                decision_date=[None, "2024-01-05", "INVALID_DATE", "05/01/2024"][i % 4],
                application_date=["2024-01-01", "01/01/2024", "NOT_A_DATE", None, "2019-01-01"][i % 5],
                approved_amount=[None, 100.0, 900.0][i % 3]) for i in range(60)]
    nulls = [row(application_id=None)] * 2
    rows = hot + rest + nulls
    df = spark.createDataFrame(rows, SCHEMA)
    rules = default_rules(P)
    agg = dq.score_aggregates(dq.evaluate_weighted(df, rules, P), rules).first()

    table = dq.evaluate_all(df, rules, P)
    assert table.count() == len(rows)
    from pyspark.sql import Window
    w_id = Window.partitionBy("application_id")
    w_all = Window.partitionBy(*df.columns).orderBy("application_id")
    brute = table.withColumns({
        "rule_U001_pass": F.count(F.lit(1)).over(w_id) == 1,
        "rule_U002_pass": F.row_number().over(w_all) == 1,
    })
    exprs = [F.count_if(F.col(r.column) == True).alias(r.rule_id) for r in rules]  # noqa: E712
    dims = {}
    for r in rules:
        dims.setdefault(r.dimension, []).append(F.coalesce(F.col(r.column), F.lit(False)))
    from functools import reduce
    exprs += [F.count_if(reduce(lambda a, b: a & b, cs)).alias("dim_" + d) for d, cs in dims.items()]
    b = brute.agg(*exprs).first()
    assert agg["total_rows"] == len(rows)
    for r in rules:
        assert agg[f"pass_{r.rule_id}"] == b[r.rule_id], r.rule_id
    for d in dims:
        assert agg[f"dim_{d}"] == b["dim_" + d], d


def test_rule_pass_rates_dict(spark):
    rules = default_rules(P)
    df = spark.createDataFrame([row(), row(application_id="A2", citizen_nric=None)], SCHEMA)
    rates = dq.rule_pass_rates(dq.score_aggregates(dq.evaluate_weighted(df, rules, P), rules), rules)
    assert len(rates) == 25 and rates["V001"]["pass_rate"] == 50.0 and rates["C001"]["failing_rows"] == 0


@pytest.mark.parametrize("dec,expected", [("2024-03-31", True), ("2024-04-01", False)])
def test_t001_is_wall_clock_across_dst(spark, dec, expected):
    """30 days after 2024-03-01 crosses the US DST switch; the lag must still
    be 30 whole days (31 fails), whatever the session time zone."""
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert passes(spark, "T001", application_date="2024-03-01", decision_date=dec) is expected
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_direct_aggregates_equal_joined_path(spark):
    rows = ([row(application_id="HOT")] * 7 + [row(application_id="HOT", household_size=9)] * 2 +
            [row(application_id=f"A{i % 5}", household_income=float(i)) for i in range(12)] +
            [row(application_id=None)] * 2 + [row(application_id="U1")])
    df = spark.createDataFrame(rows, SCHEMA)
    rules = default_rules(P)
    a = dq.score_aggregates(dq.evaluate_weighted(df, rules, P), rules).first().asDict()
    b = dq.score_aggregates_direct(df, rules, P).first().asDict()
    assert a == b
    # a rule set where U001 shares a dimension with a row rule takes the join path
    mixed = [r if r.rule_id != "V001" else type(r)(r.rule_id, r.rule_name, "Uniqueness", r.build) for r in rules]
    assert dq.score_aggregates_direct(df, mixed, P).first().asDict() == \
        dq.score_aggregates(dq.evaluate_weighted(df, mixed, P), mixed).first().asDict()


def test_v005_double_sizes_and_typed_dates(spark):
    import datetime as dt
    schema = SCHEMA.replace("household_size int", "household_size double") \
        .replace("application_date string", "application_date date").replace("decision_date string", "decision_date date")
    base = dict(zip([c.split()[0] for c in SCHEMA.split(", ")], row()))
    rows = []
    for i, (size, app, dec) in enumerate([(3.0, dt.date(2024, 1, 1), dt.date(2024, 1, 10)),
                                          (2.5, dt.date(2024, 1, 1), None),
                                          (25.0, None, dt.date(2023, 1, 1))]):
        r = dict(base, application_id=f"A{i}", household_size=size, application_date=app, decision_date=dec)
        rows.append(tuple(r[c.split()[0]] for c in SCHEMA.split(", ")))
    df = spark.createDataFrame(rows, schema)
    rules = [rules_by_id(P)[x] for x in ("V005", "CF001", "CF002", "CS001", "T001")]
    got = {r.application_id: r for r in dq.evaluate_all(df, rules, P).collect()}
    assert [got[f"A{i}"].rule_V005_pass for i in range(3)] == [True, False, False]
    assert all(got[f"A{i}"].rule_CF001_pass for i in range(3))          # typed dates conform
    assert [got[f"A{i}"].rule_CF002_pass for i in range(3)] == [True, True, False]  # NULL fails
    assert [got[f"A{i}"].rule_CS001_pass for i in range(3)] == [True, True, True]
    assert [got[f"A{i}"].rule_T001_pass for i in range(3)] == [True, True, True]
