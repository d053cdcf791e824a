"""Sinks: year-partitioned parquet layers, layers routed in one write, plain
parquet tables, small CSV result tables, and history tables."""

from __future__ import annotations

import logging

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

log = logging.getLogger(__name__)


class WriteGuardError(ValueError):
    pass


def _check_path(path: str | None) -> str:
    if path is None or not str(path).strip():
        raise WriteGuardError(f"output path is empty: {path!r}")
    return str(path)


def partition_profile(df: DataFrame, column: str) -> tuple[int, int]:
    """(rows, rows with NULL ``column``) in one aggregation."""
    row = df.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col(column).isNull()).alias("nulls")).first()
    return int(row["n"]), int(row["nulls"])


def write_partitioned(df: DataFrame, path: str, column: str = "assessment_year", on_null: str = "raise",
                      mode: str = "overwrite", profile: tuple[int, int] | None = None,
                      rebalance: bool = False) -> int:
    """Parquet (snappy) partitioned by ``column``.

    Guards: empty path or missing column raise; NULL partition values raise
    (``on_null='raise'``), stay in Spark's partition for NULL (``'keep'``) or
    are left out (``'drop'``).  Returns the number of rows written.  Overwrite
    replaces the whole table, so that it holds this run's rows only; an empty
    frame is skipped with a warning, and empties a table that is there.  With
    ``'keep'`` and ``'drop'`` the rows are counted while they are written, in
    one pass; ``'raise'`` needs the count before.
    ``profile`` = (rows, NULL rows) when the caller has counted already.

    No shuffle by default: each task writes one file per year it holds, and
    with ~128 MB input splits and a handful of years those files are already
    of a useful size, so the whole layer is not moved over the network for
    its write.  ``rebalance=True`` (for inputs made of many tiny partitions)
    adds AQE's rebalance on the partition column, which merges small
    partitions and splits a dominant year over several tasks.
    """
    path = _check_path(path)
    if df is None:
        raise WriteGuardError("DataFrame is None")
    if column not in df.columns:
        raise WriteGuardError(f"{column} column is missing from DataFrame")
    if not df.schema[column].dataType.typeName() in ("integer", "long", "short", "byte"):
        raise WriteGuardError(f"{column} must be an integer column, got {df.schema[column].dataType}")
    if on_null == "keep" and profile is None:
        seen = Observation()
        _write(df.observe(seen, F.count(F.lit(1)).alias("n")), path, column, mode, rebalance)
        return int(seen.get["n"])
    if on_null == "drop" and profile is None and not df.filter(F.col(column).isNotNull()).isEmpty():
        seen = Observation()
        counted = df.observe(seen, F.count(F.lit(1)).alias("n"), F.count_if(F.col(column).isNull()).alias("nulls"))
        _write(counted.filter(F.col(column).isNotNull()), path, column, mode, rebalance)
        n, nulls = int(seen.get["n"]), int(seen.get["nulls"])
        if nulls:
            log.warning("left out %d of %d rows with NULL %s", nulls, n, column)
        return n - nulls
    n, nulls = profile if profile is not None else partition_profile(df, column)
    if nulls and on_null != "keep":
        if on_null == "raise":
            raise WriteGuardError(f"found {nulls} NULL values in partition column {column}")
        log.warning("leaving out %d of %d rows with NULL %s", nulls, n, column)
        df = df.filter(F.col(column).isNotNull())
        n -= nulls
    if n == 0:
        log.warning("no records to write to %s, skipping", path)
        if mode == "overwrite" and _exists(df.sparkSession, path):
            df.limit(0).write.mode(mode).parquet(path)   # an earlier run's rows must not stay
        return 0
    _write(df, path, column, mode, rebalance)
    return n


def _exists(spark, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def _write(df: DataFrame, path: str, column: str, mode: str, rebalance: bool) -> None:
    if rebalance:
        df = df.hint("rebalance", column)
    (df.write.mode(mode).option("compression", "snappy")
     .option("partitionOverwriteMode", "static").partitionBy(column).parquet(path))


def write_table(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Unpartitioned parquet (snappy), e.g. dimensions."""
    df.write.mode(mode).option("compression", "snappy").parquet(_check_path(path))


#: Value of the routing column of a layer table.
ROUTE = "output"


def write_routed(df: DataFrame, path: str, route: Column, column: str = "assessment_year", metrics: dict[str, Column] | None = None) -> dict[str, int]:
    """One write of all rows, partitioned by where they go (``route``, text)
    and then by ``column``, instead of a filtered scan and write for each
    destination.  Readers of a destination, or of some years of it, list and
    scan those folders only (:func:`read_routed`).  ``metrics`` (aggregates over
    the rows) are observed during the write and returned with ``rows``."""
    path = _check_path(path)
    if column not in df.columns:
        raise WriteGuardError(f"{column} column is missing from DataFrame")
    seen = Observation()
    (df.withColumn(ROUTE, route).observe(seen, F.count(F.lit(1)).alias("rows"), *[c.alias(k) for k, c in (metrics or {}).items()])
     .write.mode("overwrite").option("compression", "snappy").option("partitionOverwriteMode", "static").partitionBy(ROUTE, column).parquet(path))
    return {k: int(v) for k, v in seen.get.items()}


def read_routed(spark: SparkSession, path: str, schema: StructType, route: str | None = None) -> DataFrame:
    """The rows of a :func:`write_routed` table that went to ``route`` (None:
    all, with the routing column).  ``schema`` is that of the rows written."""
    rows = spark.read.schema(StructType([*schema.fields, StructField(ROUTE, StringType())])).parquet(path)
    return rows if route is None else rows.filter(F.col(ROUTE) == route).drop(ROUTE)


def write_csv_lines(lines: DataFrame, path: str, header: str, mode: str = "errorifexists") -> None:
    """Ready-made CSV records (one text column) as text files, each with the header line first."""
    first = lines.select(F.col(lines.columns[0]).alias("value"), (F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)) == 0).alias("first"))
    rows = first.select(F.explode(F.when(F.col("first"), F.array(F.lit(header), "value")).otherwise(F.array("value"))).alias("value"))
    rows.write.mode(mode).text(_check_path(path))


def write_small_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """One CSV file with header — for result tables of a few dozen rows only.

    Text with quotes, commas and line breaks, NULL and empty text survive a
    round trip through :func:`read_result_csv`."""
    df.coalesce(1).write.mode(mode).option("header", True).option("escape", '"').option("quoteAll", False).csv(_check_path(path))


#: Stands for quoted empty text while a CSV is read, which Spark would take for NULL.
_EMPTY = "\x01"


def read_result_csv(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """A result table of :func:`write_small_csv` with its types restored; a value
    that is none of its column's type stops the read."""
    rows = (spark.read.schema(schema).option("header", True).option("escape", '"').option("multiLine", True)
            .option("emptyValue", _EMPTY).option("mode", "FAILFAST").csv(_check_path(path)))
    text = [f.name for f in schema.fields if f.dataType == StringType()]
    return rows.withColumns({n: F.when(F.col(n) == _EMPTY, "").otherwise(F.col(n)) for n in text})


def append_history(df: DataFrame, path: str, partition_by: str | None = None) -> None:
    """Append rows to a history table (parquet)."""
    w = df.write.mode("append").option("compression", "snappy")
    if partition_by:
        w = w.partitionBy(partition_by)
    w.parquet(_check_path(path))


def replace_history(df: DataFrame, path: str, key: str = "execution_id") -> None:
    """Write the rows of some runs to a history table with a folder for each
    run: what a run of the same ``key`` wrote before is replaced when the write
    commits, so a replay leaves no second record and other runs are untouched."""
    if key not in df.columns:
        raise WriteGuardError(f"{key} column is missing from DataFrame")
    (df.write.mode("overwrite").option("compression", "snappy").option("partitionOverwriteMode", "dynamic")
     .partitionBy(key).parquet(_check_path(path)))
