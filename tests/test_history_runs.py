"""Several runs over one table, scored in one pass."""

import contextlib
import io
import re
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from qualstar.operators import dq
from qualstar.operators.rules import default_rules
from qualstar.params import DQParams
from qualstar.plans import registry, registry_io
from qualstar.plans.dq import analyse_runs
from qualstar.sources.adapters import grant_applications, grant_applications_resubmitted, times_resubmitted

SF = "/root/testdata/sf0.001"
P = DQParams(as_of="2001-12-01 00:00:00")
RULES = default_rules(P)


def _times():
    return [F.lit(1), times_resubmitted(), F.when(F.col("application_status") == "Pending", 0).otherwise(3), F.lit(0)]



def test_shared_pass_equals_each_run_alone(spark):
    odd = spark.createDataFrame([("A", 0.0), ("A", -0.0), ("A", None), (None, 1.0), (None, 1.0), ("B", float("nan"))], "application_id string, household_income double")
    ga = grant_applications(spark, SF)
    extra = odd.select(*[F.col(c) if c in odd.columns else F.lit(None).cast(t).alias(c) for c, t in ga.dtypes])
    for df in (ga, ga.unionByName(extra)):
        shared = dq.score_aggregates_runs(df, _times(), RULES, P).localCheckpoint()
        for k, times in enumerate(_times()):
            rows = df.select("*", F.explode(F.array_repeat(F.lit(1), times.cast("int"))).alias("t")).drop("t")
            alone = dq.score_aggregates(dq.evaluate_weighted(rows, RULES, P), RULES).first().asDict()
            assert dq.run_aggregates(shared, k).first().asDict() == alone
    assert dq.run_aggregates(shared, 3).first()["total_rows"] == 0


def test_history_reads_the_view_once_for_both_runs(spark, monkeypatch):
    seen = []
    monkeypatch.setattr("qualstar.plans.dq.pin", lambda df, name: seen.append(df) or df)
    runs = registry._history_runs(spark, SF)
    assert len(seen) == 1                                                       # a pinned job for each run before
    first, second = (r.dimension_scores.agg(F.max("total_rows")).first()[0] for r in runs)
    assert first == grant_applications(spark, SF).count()
    assert second == grant_applications_resubmitted(spark, SF).count()


@pytest.mark.parametrize("threshold", ["10485760", "-1"])
def test_shared_pass_is_small_enough_for_the_jit(spark, threshold):
    conf = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": threshold}
    old = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        plan = io.StringIO()
        with contextlib.redirect_stdout(plan):
            dq.score_aggregates_runs(grant_applications(spark, SF), _times()[:2], RULES, P).explain("codegen")
            dq.score_aggregates_runs(grant_applications(spark, SF), [*_times()[:2], F.lit(1)], RULES, P).explain("codegen")
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", plan.getvalue())]
    assert sizes and max(sizes) < 8000, sizes


def test_runs_by_their_own_clock_are_analysed_alone(spark):
    ga = grant_applications(spark, SF)
    runs = [("a", datetime(2001, 12, 1), F.lit(1)), ("b", datetime(2011, 12, 1), times_resubmitted())]
    a, b = analyse_runs(ga, runs, DQParams(), RULES)
    fresh = [{r.rule_id: r.passing_rows for r in x.rule_results.collect()}["T002"] for x in (a, b)]
    assert fresh[1] < fresh[0]
    assert b.execution.first()["total_rows"] == grant_applications_resubmitted(spark, SF).count()


def test_recorded_runs_share_one_pass(spark, monkeypatch):
    passes = []
    for name in ("score_aggregates_direct", "score_aggregates_runs"):
        real = getattr(dq, name)
        for module in ("qualstar.plans.dq", "qualstar.operators.dq"):
            monkeypatch.setattr(f"{module}.{name}", lambda *a, real=real, **k: passes.append(real) or real(*a, **k))
    recorded = registry_io.q_dq_history_executions(spark, SF).collect()
    assert len(passes) == 1                                                     # three before
    n, again = grant_applications(spark, SF).count(), grant_applications_resubmitted(spark, SF).count()
    assert sorted((r.execution_id[-1], r.status, r.total_rows) for r in recorded) == [("1", "SUCCESS", again), ("2", "FAILED", 0), ("3", "FAILED", 0)]
    assert n < again
