"""The row-level rule table: what it shuffles, and that copies and repeated ids stay exact."""

import contextlib
import io
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from qualstar.operators import dq
from qualstar.operators.rules import default_rules, rules_by_id
from qualstar.params import DQParams
from qualstar.sources.adapters import grant_applications
from qualstar.sources.files import GRANT_SCHEMA
from tests.test_skew import P, SKEW_CONF, _apps

SF = "/root/testdata/sf0.001"
ORACLE_P = DQParams(as_of="2001-12-01 00:00:00")


@pytest.fixture()
def conf(spark):
    old = {}

    def use(settings):
        for k, v in settings.items():
            old.setdefault(k, spark.conf.get(k, None))
            spark.conf.set(k, v)
    yield use
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def _full_rows_shuffled(df) -> int:
    """Rows with all columns of an application that exchanges wrote (AQE off)."""
    execution = df._jdf.queryExecution()
    execution.toRdd().count()
    todo, n = [execution.executedPlan()], 0
    while todo:
        node = todo.pop()
        if node.nodeName() == "Exchange" and {"requested_amount", "decision_date"} <= {
                node.output().apply(i).name() for i in range(node.output().size())}:
            n += node.metrics().apply("shuffleRecordsWritten").value()
        todo += [node.children().apply(i) for i in range(node.children().size())]
    return n


def test_a_row_without_copies_is_shuffled_once(spark, conf):
    conf({"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"})
    rows = grant_applications(spark, SF)
    n = rows.count()
    table = dq.evaluate_all(rows, default_rules(ORACLE_P), ORACLE_P)
    assert _full_rows_shuffled(table) < 1.2 * n         # 3 n before: collapsed, joined and spread


def test_no_step_is_too_large_for_the_jit(spark, conf):
    """The JVM compiles no method above 8 000 bytes; all rules were projected in one."""
    conf({"spark.sql.adaptive.enabled": "false"})
    plan = io.StringIO()
    with contextlib.redirect_stdout(plan):
        dq.evaluate_all(grant_applications(spark, SF), default_rules(ORACLE_P), ORACLE_P).explain("codegen")
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", plan.getvalue())]
    assert sizes and max(sizes) < 8000


def _row(i, income=1.0, status="Pending"):
    return (i, None, "Education Bursary", income, 1, "2024-01-01", status, 5.0, None, None)


def test_copies_of_any_number_and_many_rows_of_an_id_are_exact(spark):
    rnd = random.Random(4)
    rows = [_row(f"A{rnd.randrange(60)}", rnd.choice([0.0, -0.0, float("nan"), None, float(rnd.randrange(3))]),
                 rnd.choice(["Pending", "Approved", None])) for _ in range(600)]
    rows += [_row("MANY", float(k)) for k in range(200)] + [_row(None), _row(None), _row(None, 2.0)]
    rows += [_row("HOT")] * 5000 + [_row("NINE")] * 9 + [_row("EIGHT")] * 8 + [_row("ONE")]
    df = spark.createDataFrame(rows, GRANT_SCHEMA).repartition(5)
    rules = default_rules(P)
    table = dq.evaluate_all(df, rules, P)
    assert table.columns == df.columns + [r.column for r in rules]

    def same(income):                                   # as the rows are compared: 0.0 is -0.0, NaN is NaN
        return "nan" if income is not None and income != income else income if income is None else income + 0.0

    def key(r):
        return r[0], same(r[3]), r[6]
    ids, groups = Counter(r[0] for r in rows), Counter(map(key, rows))
    got = table.select("application_id", "household_income", "application_status", "rule_U001_pass", "rule_U002_pass").collect()
    assert Counter((r[0], same(r[1]), r[2]) for r in got) == groups
    assert all(r.rule_U001_pass == (ids[r[0]] == 1) for r in got)
    assert Counter((r[0], same(r[1]), r[2]) for r in got if r.rule_U002_pass) == Counter(groups.keys())
    # Each outcome as the collapsed form has it.
    want = dq.score_aggregates(dq.evaluate_weighted(df, rules, P), rules).first()
    for r in rules:
        assert table.filter(r.column).count() == want[f"pass_{r.rule_id}"], r.rule_id


@pytest.mark.parametrize("ids", [["U001"], ["U002"], ["C002", "T002"], ["U002", "U001"]])
def test_some_rules_only(spark, ids):
    rows = [_row("A"), _row("A"), _row("B"), _row("B", 2.0), _row(None)]
    table = dq.evaluate_all(spark.createDataFrame(rows, GRANT_SCHEMA), [rules_by_id(P)[i] for i in ids], P)
    assert table.columns == GRANT_SCHEMA.names + [f"rule_{i}_pass" for i in ids]
    passed = {i: sorted(str(r.application_id) for r in table.filter(f"rule_{i}_pass").collect()) for i in ids}
    want = {"U001": ["None"], "U002": ["A", "B", "B", "None"], "C002": ["A", "A", "B", "B", "None"]}
    want["T002"] = want["C002"]
    assert passed == {i: want[i] for i in ids}


def test_a_hot_id_is_split(spark, conf):
    conf(SKEW_CONF)
    n = 30000
    table = dq.evaluate_all(_apps(spark, n), default_rules(P), P)
    assert table.filter("rule_U001_pass").count() == n - n // 3 and table.filter("rule_U002_pass").count() == n
    table.collect()
    assert "SortMergeJoin(skew=true)" in table._jdf.queryExecution().executedPlan().toString()


def test_a_hot_group_is_generated_by_several_tasks(spark):
    """Also where AQE puts small partitions together."""
    n = 30000
    table = dq.evaluate_all(_apps(spark, n, hot_id=False, hot_copies=True), default_rules(P), P)
    per_task = table.filter("application_id = 'COPY'").groupBy(F.spark_partition_id().alias("p")).count().collect()
    assert sum(r["count"] for r in per_task) == n // 3 and len(per_task) > 1
    assert table.filter("application_id = 'COPY' AND rule_U002_pass").count() == 1
