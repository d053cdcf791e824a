"""Spark session settings and the reliable-checkpoint location."""

from __future__ import annotations

import atexit
import re
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every job here relies on.  UTC makes day arithmetic free of DST
# steps; AQE re-plans joins from runtime sizes and splits skewed partitions.
SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # The 25 rules + 31 sums fuse into one stage whose generated method is
    # larger than the JVM JIT compiles (8 000 bytes of bytecode); such a
    # stage then runs interpreted.  At this limit Spark compiles those
    # operators separately instead (measured: DQ run 14 s -> 9 s at sf0.1).
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def build_session(master: str | None = None, app_name: str = "qualstar",
                  shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for k, v in SESSION_DEFAULTS.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared checkpoint folder of the cluster.

    Uses the context's directory if one is set, else ``spark.checkpoint.dir``
    from the session.  With neither, a local master (one machine, no executors
    elsewhere) gets a folder in its SQL warehouse; a cluster is refused, since
    a folder of the library's choosing need not be shared by its machines.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not re.match(r"local(\[|$)", sc.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        configured = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_qualstar_checkpoints"
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


_PINNED: dict[str, SparkSession] = {}
_KEPT: dict[str, SparkSession] = {}


def scratch_path(spark: SparkSession, name: str, keep: bool = False) -> str:
    """A new folder name below the checkpoint folder.  What is written there
    goes with :func:`release_pins`, or, with ``keep``, at the end of the program."""
    path = f"{checkpoint_dir(spark).rstrip('/')}/tables/{name}-{uuid.uuid4().hex}"
    (_KEPT if keep else _PINNED)[path] = spark
    return path


def pin(df: DataFrame, name: str = "pinned") -> DataFrame:
    """Materialise ``df`` as a parquet table in the shared checkpoint folder
    and continue from the stored table (lineage cut).

    Used where later steps must all see exactly the same rows (key
    assignment after a range partitioning, a scored layer that several
    jobs read), also when an executor is lost and tasks are recomputed.
    One write job; the read-back is columnar, so later steps scan only the
    columns they use, and the planner sees the table's real size.  The table
    stays until :func:`unpin`, :func:`release_pins` or the end of the program.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.mode("errorifexists").parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._pinned_path = path
    return out


def _delete(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def unpin(*frames: DataFrame) -> None:
    """Delete the tables behind frames that :func:`pin` returned."""
    for df in frames:
        path = getattr(df, "_pinned_path", None)
        if path and _PINNED.pop(path, None):
            _delete(df.sparkSession, path)


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a folder that :func:`scratch_path` named."""
    if _PINNED.pop(path, None) or _KEPT.pop(path, None):
        _delete(spark, path)


def release_pins(spark: SparkSession) -> None:
    """Delete every pinned table of this session.  Frames that still read one
    can't be used afterwards: write results out first."""
    for path, owner in list(_PINNED.items()):
        if owner is spark:
            del _PINNED[path]
            _delete(spark, path)


@atexit.register
def _release_all() -> None:
    for path, spark in [*_PINNED.items(), *_KEPT.items()]:
        if spark.sparkContext._jsc is not None:
            try:
                _delete(spark, path)
            except Exception:  # the JVM may already be down
                return
