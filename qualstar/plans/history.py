"""Queries over the appended DQ history tables (execution, dimension
scores, rule results): trend per dimension, drill-down to failing rules,
report across executions, alerts below a threshold.

History tables hold one row per dimension (or rule) per run, so they grow
with the number of runs, not with the data; the windows below partition by
dimension / rule and order by time.  A replayed run (same execution_id) is
counted once: the latest record per id wins.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType


def _latest_per_execution(df: DataFrame, keys) -> DataFrame:
    w = Window.partitionBy("execution_id", *keys).orderBy(F.desc("execution_timestamp"))
    return df.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def load(spark: SparkSession, history_dir: str, table: str) -> DataFrame:
    """A history table as recorded; execution ids are text whatever they look like."""
    path = f"{history_dir.rstrip('/')}/{table}"
    columns = spark.read.parquet(path).schema
    return spark.read.schema(StructType([StructField(f.name, StringType() if f.name == "execution_id" else f.dataType) for f in columns])).parquet(path)


def load_scores(spark: SparkSession, history_dir: str, table: str = "dq_dimension_scores") -> DataFrame:
    """Scores or rule results of the runs that succeeded: a run that was
    replayed counts with its last record only, and a run whose replay failed,
    or that stopped between two tables, not at all."""
    done = load(spark, history_dir, "dq_execution").filter("status = 'SUCCESS'").select("execution_id", "execution_timestamp")
    return load(spark, history_dir, table).join(done, ["execution_id", "execution_timestamp"], "left_semi")


def dimension_trend(scores: DataFrame) -> DataFrame:
    """Score per dimension and run with the change against the previous run."""
    s = _latest_per_execution(scores, ["dimension_name"])
    w = Window.partitionBy("dimension_name").orderBy("execution_timestamp", "execution_id")
    return s.select("dimension_name", "execution_id", "execution_timestamp", "score",
                    F.lag("score").over(w).alias("previous_score"),
                    (F.col("score") - F.lag("score").over(w)).alias("score_change"))


def failing_rules(rule_results: DataFrame, execution_id: str, min_failure_rate: float = 0.0) -> DataFrame:
    """Drill-down: rules of one run with a failure rate above the bound, worst first."""
    r = _latest_per_execution(rule_results, ["rule_id"])
    return (r.filter((F.col("execution_id") == execution_id) & (F.col("failure_rate") > min_failure_rate))
            .select("rule_id", "dimension_name", "rule_name", "failing_rows", "failure_rate")
            .orderBy(F.desc("failure_rate"), "rule_id"))


def score_report(scores: DataFrame) -> DataFrame:
    """One row per run, one column per dimension."""
    s = _latest_per_execution(scores, ["dimension_name"])
    dims = ["Completeness", "Uniqueness", "Validity", "Conformity", "Consistency", "Timeliness"]
    return (s.groupBy("execution_id", "execution_timestamp").pivot("dimension_name", dims)
            .agg(F.first("score")).orderBy("execution_timestamp"))


def alerts(scores: DataFrame, threshold: float) -> DataFrame:
    """Dimensions whose score in the latest run is below ``threshold``."""
    s = _latest_per_execution(scores, ["dimension_name"])
    w = Window.partitionBy("dimension_name").orderBy(F.desc("execution_timestamp"), F.desc("execution_id"))
    latest = s.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")
    return latest.filter(F.col("score") < threshold).select("dimension_name", "execution_id", "score")
