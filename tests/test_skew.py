"""Hot keys: a third of the rows on one id, a third of the rows identical.

AQE thresholds are lowered to fixture size so its skew handling engages as
it would on a cluster with real partition sizes."""

import pytest
from pyspark.sql import functions as F

from qualstar.operators import dq
from qualstar.operators.rules import default_rules
from qualstar.params import DQParams

SKEW_CONF = {
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2k",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
}
P = DQParams(as_of="2024-06-01 00:00:00")


@pytest.fixture()
def skew_conf(spark):
    old = {k: spark.conf.get(k, None) for k in SKEW_CONF}
    for k, v in SKEW_CONF.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in old.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


def _apps(spark, n, hot_id=True, hot_copies=False):
    i = F.col("id")
    app_id = F.when(i % 3 == 0, F.lit("HOT")) if hot_id else F.when(F.lit(False), F.lit(""))
    app_id = app_id.otherwise(F.concat(F.lit("A"), i.cast("string")))
    income = (F.when(i % 3 == 1, F.lit(5.0)) if hot_copies else F.when(F.lit(False), F.lit(0.0))).otherwise(i * 1.0)
    if hot_copies:
        app_id = F.when(i % 3 == 1, F.lit("COPY")).otherwise(app_id)
    return spark.range(n).select(
        app_id.alias("application_id"), F.lit("S1234567A").alias("citizen_nric"),
        F.lit("Education Bursary").alias("grant_scheme_name"), income.alias("household_income"),
        F.lit(3).alias("household_size"), F.lit("2024-01-01").alias("application_date"),
        F.lit("Pending").alias("application_status"), F.lit(100.0).alias("requested_amount"),
        F.lit(None).cast("double").alias("approved_amount"), F.lit(None).cast("string").alias("decision_date"))


def test_hot_id_join_is_split_and_counts_are_exact(skew_conf):
    spark = skew_conf
    n = 30000
    rules = default_rules(P)
    agg = dq.score_aggregates(dq.evaluate_weighted(_apps(spark, n), rules, P), rules)
    row = agg.collect()[0]
    assert row["total_rows"] == n
    assert row["pass_U001"] == n - n // 3  # every HOT row fails, all others are unique
    plan = agg._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin(skew=true)" in plan


def test_hot_copy_group_collapses_before_the_shuffle(skew_conf):
    spark = skew_conf
    n = 30000
    df = _apps(spark, n, hot_id=False, hot_copies=True)
    rules = default_rules(P)
    w = dq.evaluate_weighted(df, rules, P)
    assert w.count() == n - n // 3 + 1  # the 10 000 identical rows are one collapsed row
    assert w.filter("application_id = 'COPY'").first()["_copies"] == n // 3
    row = dq.score_aggregates(w, rules).collect()[0]
    assert row["pass_U002"] == n - n // 3 + 1 and row["pass_U001"] == n - n // 3
    # the row-level table fans the hot group out again, over several tasks
    table = dq.expand_copies(w, rules, chunk=1000)
    per_task = (table.filter("application_id = 'COPY'").groupBy(F.spark_partition_id().alias("p")).count()
                .collect())
    assert sum(r["count"] for r in per_task) == n // 3 and len(per_task) > 1
    assert table.filter("application_id = 'COPY' AND rule_U002_pass").count() == 1
