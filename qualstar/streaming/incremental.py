"""Incremental runs over a folder that receives new CSV files (daily drops).

The row operators are stateless, so they run unchanged on a file stream:

* ``start_tax_streams`` scores each new tax-return file and appends Accept +
  Quarantine rows to the silver folder and Reject rows to the rejected
  folder (parquet, partitioned by assessment year).  Both use Spark's file
  sink, which commits each micro-batch exactly once through its metadata
  log, so a restarted query neither loses nor duplicates rows.
* ``start_class_counts`` keeps running totals per class (state: one row per
  class, so bounded).
* ``start_dq_monitor`` runs the rule analysis on every micro-batch of grant
  applications and puts the results into the history tables.  Uniqueness
  (U001/U002) is judged within a batch there (``uniqueness`` has both rules
  over all batches); ``execution_id`` is derived from the query id and batch
  id, so a replayed batch replaces its own record.

``trigger="available_now"`` processes what is there and stops (a scheduled
daily run); ``"continuous"`` keeps polling every ``interval``.
"""

from __future__ import annotations

import hashlib
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.score import class_counts, route
from ..params import DQParams, TaxParams
from ..plans.dq import analyse, record_history
from ..plans.tax import silver_transform
from ..sources.files import GRANT_SCHEMA, TAX_SCHEMA


def _trigger(writer, trigger: str, interval: str):
    if trigger == "available_now":
        return writer.trigger(availableNow=True)
    return writer.trigger(processingTime=interval)


def read_tax_stream(spark: SparkSession, input_dir: str, max_files_per_trigger: int | None = None,
                    source_format: str = "csv") -> DataFrame:
    reader = spark.readStream.schema(TAX_SCHEMA)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    if source_format == "csv":
        return reader.option("header", True).csv(input_dir)
    return reader.format(source_format).load(input_dir)


def scored_stream(spark: SparkSession, input_dir: str, p: TaxParams = TaxParams(),
                  source_format: str = "csv") -> DataFrame:
    stream = read_tax_stream(spark, input_dir, source_format=source_format)
    ts = datetime.now(timezone.utc).replace(tzinfo=None).isoformat()
    with_lineage = stream.withColumns({
        "ingestion_timestamp": F.lit(ts),
        "source_file": F.col("_metadata.file_path"),
        "raw_record_hash": F.hash(*[F.col(c) for c in stream.columns]),
    })
    return silver_transform(with_lineage, p)


def start_tax_streams(spark: SparkSession, input_dir: str, silver_dir: str, rejected_dir: str,
                      checkpoint_root: str, p: TaxParams = TaxParams(), trigger: str = "available_now",
                      interval: str = "1 minute") -> list[StreamingQuery]:
    scored = scored_stream(spark, input_dir, p)
    silver, rejected = route(scored, p, drop_null_year=True)
    out = []
    for name, df, path in (("silver", silver, silver_dir), ("rejected", rejected, rejected_dir)):
        w = (df.writeStream.format("parquet").option("path", path)
             .option("checkpointLocation", f"{checkpoint_root.rstrip('/')}/{name}")
             .partitionBy("assessment_year").outputMode("append"))
        out.append(_trigger(w, trigger, interval).queryName(f"tax_{name}").start())
    return out


def start_class_counts(spark: SparkSession, input_dir: str, checkpoint_root: str, query_name: str = "tax_classes",
                       p: TaxParams = TaxParams(), trigger: str = "available_now",
                       interval: str = "1 minute", source_format: str = "csv") -> StreamingQuery:
    """Running rows per class, all three, into an in-memory table ``query_name``."""
    counts = class_counts(scored_stream(spark, input_dir, p, source_format))
    w = (counts.writeStream.format("memory").queryName(query_name).outputMode("complete")
         .option("checkpointLocation", f"{checkpoint_root.rstrip('/')}/{query_name}"))
    return _trigger(w, trigger, interval).start()


def start_dq_monitor(spark: SparkSession, input_dir: str, history_dir: str, checkpoint_root: str,
                     params: DQParams = DQParams(), trigger: str = "available_now",
                     interval: str = "1 minute") -> StreamingQuery:
    stream = spark.readStream.schema(GRANT_SCHEMA).option("header", True).csv(input_dir)
    checkpoint = f"{checkpoint_root.rstrip('/')}/dq_monitor"
    # Stable across restarts of this monitor (same checkpoint), distinct
    # between monitors: a replayed batch writes the same execution_id again.
    prefix = "dq-" + hashlib.sha1(checkpoint.encode()).hexdigest()[:12]

    def per_batch(batch: DataFrame, batch_id: int) -> None:
        if batch.isEmpty():
            return
        run = analyse(batch, params, execution_id=f"{prefix}-{batch_id}")
        record_history(run, history_dir)

    w = stream.writeStream.foreachBatch(per_batch).option("checkpointLocation", checkpoint)
    return _trigger(w, trigger, interval).queryName("dq_monitor").start()
