"""Data-quality monitoring run: rules -> one aggregation -> result tables.

One scan, one count of rows by id and hash (identical rows are counted in full
where a hash repeats), one aggregation for all rule and dimension counts.  The one-row aggregate is pinned in the checkpoint folder
so the five result tables are all derived from that single job.
"""

from __future__ import annotations

import logging
import uuid
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.dq import (dimension_scores, direct_applies, rule_results, run_aggregates, score_aggregates, score_aggregates_direct,
                            score_aggregates_runs)
from ..operators.rules import Rule, default_rules
from ..params import DQParams
from ..session import pin
from ..sinks.writers import replace_history, write_small_csv
from ..sources.files import read_grant_csv

log = logging.getLogger(__name__)


@dataclass
class DQRun:
    execution_id: str
    execution_timestamp: datetime
    execution: DataFrame
    dimension_scores: DataFrame
    rule_results: DataFrame
    scores_minimal: DataFrame
    scores_full: DataFrame


def execution_record(spark: SparkSession, execution_id: str, ts: datetime, params: DQParams,
                     total_rows, status: str) -> DataFrame:
    """dq_execution: one row; ``total_rows`` is a Column (from the aggregate) or an int."""
    total = total_rows if not isinstance(total_rows, int) else F.lit(total_rows)
    return spark.range(1).select(
        F.lit(execution_id).alias("execution_id"),
        F.lit(ts).cast("timestamp").alias("execution_timestamp"),
        F.lit(params.dataset_name).alias("dataset_name"),
        F.lit(params.dataset_version).cast("string").alias("dataset_version"),
        total.cast("long").alias("total_rows"),
        F.lit(status).alias("status"))


def analyse(df: DataFrame, params: DQParams = DQParams(), rules: list[Rule] | None = None,
            execution_id: str | None = None, execution_timestamp: datetime | None = None,
            pin_aggregate: bool = True) -> DQRun:
    """Evaluate all rules over ``df`` and build the result tables (lazy apart
    from the pinned one-row aggregate)."""
    spark = df.sparkSession
    rules = rules if rules is not None else default_rules(params)
    execution_id = execution_id or str(uuid.uuid4())
    ts = execution_timestamp or datetime.now(timezone.utc).replace(tzinfo=None)
    if params.as_of is None:
        params = DQParams(**{**params.__dict__, "as_of": ts.isoformat(sep=" ")})
    return _results(score_aggregates_direct(df, rules, params), params, rules, execution_id, ts, pin_aggregate)


def analyse_weighted(weighted: DataFrame, params: DQParams, rules: list[Rule], execution_id: str,
                     ts: datetime, pin_aggregate: bool = True) -> DQRun:
    """Result tables from an already evaluated (collapsed) rule table."""
    return _results(score_aggregates(weighted, rules), params, rules, execution_id, ts, pin_aggregate)


def analyse_runs(df: DataFrame, runs: list[tuple[str, datetime, Column]], params: DQParams,
                 rules: list[Rule] | None = None) -> list[DQRun]:
    """Several runs over rows of one table: ``(execution id, timestamp, how
    often the run sees a row)`` each.  The same results as :func:`analyse` of
    each run's rows, in one pass over the table.  Runs that date the rows'
    age by their own clock (no ``as_of``), or whose rules need a join, are
    analysed one by one."""
    rules = rules if rules is not None else default_rules(params)
    if params.as_of is None or not direct_applies(df, rules):
        return [analyse(df.select("*", F.explode(F.array_repeat(F.lit(1), times.cast("int"))).alias("_time")).drop("_time"),
                        params, rules, id_, ts) for id_, ts, times in runs]
    shared = pin(score_aggregates_runs(df, [times for _, _, times in runs], rules, params), "dq-aggregates")
    return [_results(run_aggregates(shared, k), params, rules, id_, ts, False) for k, (id_, ts, _) in enumerate(runs)]


def _results(aggregates: DataFrame, params: DQParams, rules: list[Rule], execution_id: str,
             ts: datetime, pin_aggregate: bool) -> DQRun:
    if pin_aggregate:
        aggregates = pin(aggregates, "dq-aggregates")
    dims = dimension_scores(aggregates, rules, execution_id)
    results = rule_results(aggregates, rules, execution_id)
    execution = aggregates.select(
        F.lit(execution_id).alias("execution_id"), F.lit(ts).cast("timestamp").alias("execution_timestamp"),
        F.lit(params.dataset_name).alias("dataset_name"),
        F.lit(params.dataset_version).cast("string").alias("dataset_version"),
        F.col("total_rows").cast("long").alias("total_rows"), F.lit("SUCCESS").alias("status"))
    minimal = dims.select("dimension_name", "score")
    full = dims.withColumns({"execution_timestamp": F.lit(ts.isoformat()),
                             "dataset_name": F.lit(params.dataset_name)})
    return DQRun(execution_id, ts, execution, dims, results, minimal, full)


def run_analysis(spark: SparkSession, data, output_dir: str, params: DQParams = DQParams(),
                 rules: list[Rule] | None = None, execution_id: str | None = None,
                 execution_timestamp: datetime | None = None, history_dir: str | None = None,
                 aggregates: DataFrame | None = None) -> DQRun:
    """Load (path or DataFrame), analyse, write the five result tables as CSV.
    ``aggregates`` are this run's of a pass that several runs share
    (``operators.dq.run_aggregates``, scored by the same rules and parameters).

    On failure an execution record with status FAILED is still written, then
    the error is raised again."""
    execution_id = execution_id or str(uuid.uuid4())
    ts = execution_timestamp or datetime.now(timezone.utc).replace(tzinfo=None)
    out = output_dir.rstrip("/")
    try:
        df = read_grant_csv(spark, data) if isinstance(data, str) else data
        if aggregates is None:
            run = analyse(df, params, rules, execution_id, ts)
        else:
            run = _results(aggregates, params, rules if rules is not None else default_rules(params), execution_id, ts, False)
        write_small_csv(run.execution, f"{out}/dq_execution")
        write_small_csv(run.dimension_scores, f"{out}/dq_dimension_scores")
        write_small_csv(run.scores_minimal, f"{out}/dq_dimension_scores_minimal")
        write_small_csv(run.rule_results, f"{out}/dq_rule_results")
        write_small_csv(run.scores_full, f"{out}/dq_dimension_scores_full")
        if history_dir:
            record_history(run, history_dir)
        return run
    except Exception:
        log.exception("data-quality analysis failed")
        try:
            failed = execution_record(spark, execution_id, ts, params, 0, "FAILED")
            write_small_csv(failed, f"{out}/dq_execution")
            if history_dir:
                replace_history(failed, f"{history_dir.rstrip('/')}/dq_execution")
        except Exception:  # noqa: BLE001
            log.exception("could not save the FAILED execution record")
        raise


def record_history(run: DQRun, history_dir: str) -> None:
    """Put this run into the history tables (execution, dimension scores, rule
    results), in place of what a run with its id left there.  The execution row
    comes last: scores count once it says SUCCESS (``history.load_scores``)."""
    base = history_dir.rstrip("/")
    ts = F.lit(run.execution_timestamp).cast("timestamp")
    replace_history(run.dimension_scores.withColumn("execution_timestamp", ts), f"{base}/dq_dimension_scores")
    replace_history(run.rule_results.withColumn("execution_timestamp", ts), f"{base}/dq_rule_results")
    replace_history(run.execution, f"{base}/dq_execution")
