"""Uniqueness rules (U001, U002) over a stream of application files, across batches.

The stream keeps one state row per application id and row content: how often
that row has come so far.  Counting is a streaming aggregation, so copies are
combined before the shuffle and a hot id is as many keys as it has different
rows.  Every batch writes the counts that it changed to a folder of its own.
Counts only grow and a replayed batch writes its folder again with the same
counts, so the largest count of a row is the right one, however often a batch
ran; :func:`uniqueness_results` derives both rules from those.

The state grows with the rows that have come, so it is kept in RocksDB (memory of
a fixed size, files on the executors' disks) and not in maps in the executors' heaps.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..sources.files import GRANT_SCHEMA

_COUNTS = "application_id string, content binary, copies long, batch_id long"

_STATE_ON_DISK = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # One limit for all stores of an executor; each would take its own caches otherwise.
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    # A count of the state's rows costs another look-up for each row that is put.
    "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false",
}


@contextmanager
def _state_on_disk(spark: SparkSession) -> Iterator[None]:
    """A query started within keeps its state in RocksDB, but for what the session
    has set itself.  A query takes the settings when it starts, and one started
    again the provider that its checkpoint names."""
    new = {k: v for k, v in _STATE_ON_DISK.items() if k not in spark.conf.getAll}
    try:
        for k, v in new.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k in new:
            spark.conf.unset(k)


def _content(columns) -> Column:
    """The first 16 bytes of a row's SHA-256; NULL differs from every text.

    Bytes, as hex would be twice as long in state, shuffles and files.  Only rows
    of one application id are told apart by them: a thousand million different
    rows of one id would have two alike with probability 2e-21."""
    digest = F.unhex(F.sha2(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}), 256))
    return F.substring(digest, 1, 16)


def start_uniqueness_monitor(spark: SparkSession, input_dir: str, counts_dir: str, checkpoint: str,
                             max_files_per_trigger: int | None = None, source_format: str = "csv",
                             trigger: str = "available_now", interval: str = "1 minute") -> StreamingQuery:
    """Count the rows of every new file of grant applications; counts go below ``counts_dir``."""
    reader = spark.readStream.schema(GRANT_SCHEMA)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    rows = reader.option("header", True).csv(input_dir) if source_format == "csv" else reader.format(source_format).load(input_dir)
    counts = (rows.select("application_id", _content(GRANT_SCHEMA.names).alias("content"))
              .groupBy("application_id", "content").agg(F.count(F.lit(1)).alias("copies")))

    def per_batch(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{counts_dir.rstrip('/')}/batch_id={batch_id}")

    w = counts.writeStream.outputMode("update").foreachBatch(per_batch).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if trigger == "available_now" else w.trigger(processingTime=interval)
    with _state_on_disk(spark):
        return w.queryName("dq_uniqueness").start()


def row_counts(spark: SparkSession, counts_dir: str) -> DataFrame:
    """(application_id, content, copies) of every different row that has come."""
    changes = spark.read.schema(_COUNTS).parquet(counts_dir)
    return changes.groupBy("application_id", "content").agg(F.max("copies").alias("copies"))


def uniqueness_results(spark: SparkSession, counts_dir: str) -> DataFrame:
    """(rule_id, application_id, passed, n_rows), as a batch over all files gives.

    U001: an id passes if it has come once.  U002: of equal rows one passes."""
    counts = row_counts(spark, counts_dir)
    ids = counts.groupBy("application_id").agg(F.sum("copies").alias("n"), F.count(F.lit(1)).alias("first"))
    return ids.selectExpr("stack(3, 'U001', n = 1, n, 'U002', true, first, 'U002', false, n - first) AS (rule_id, passed, n_rows)",
                          "application_id").filter("n_rows > 0").select("rule_id", "application_id", "passed", "n_rows")


def compact_counts(spark: SparkSession, counts_dir: str, into: str) -> None:
    """One row for each different row in place of all its changes, as a folder
    that later batches' folders may be put beside."""
    row_counts(spark, counts_dir).write.mode("errorifexists").parquet(f"{into.rstrip('/')}/batch_id=-1")
