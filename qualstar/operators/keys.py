"""Dense 0-based surrogate keys without a single-task window.

``row_number() OVER (ORDER BY k) - 1`` moves every row into one partition.
Here the rows are range-partitioned on the full ordering key, sorted inside
each partition, and numbered there; a prefix sum over the per-partition row
counts (one row per partition, so its size is bounded by the partition count,
not the data) turns local positions into global ones.  The same order as the
global window results, because range partitions are ordered and each sorts
its rows with the same key.

The range-partitioned rows (with their partition index and position) are
pinned in the shared checkpoint folder before they are counted and numbered,
so a recomputation after a lost executor cannot re-sample different range
bounds and hand out other keys.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import pin

_POS_BITS = 33  # monotonically_increasing_id = partition index << 33 | position


def _order_cols(order_by) -> list[Column]:
    out = []
    for c in order_by:
        out.append(F.col(c).asc_nulls_first() if isinstance(c, str) else c)
    return out


def assign_dense_keys(df: DataFrame, order_by, key: str, num_partitions: int | None = None,
                      pin_result: bool = True) -> DataFrame:
    """Add ``key`` = 0-based position of each row in ``order_by`` order.

    Rows must be distinct in ``order_by`` for the keys to be reproducible (the
    dimensions call it after ``distinct`` with their full natural key).
    Ascending order, NULLs first, as Spark sorts by default.
    """
    ordered = _order_cols(order_by)
    # Without an explicit count AQE may merge adjacent range partitions to
    # its advisory size; merged partitions keep the global order, so a small
    # dimension uses few tasks and a large one as many as its size needs.
    ranged = (df.repartitionByRange(num_partitions, *ordered) if num_partitions
              else df.repartitionByRange(*ordered))
    ranged = (ranged.sortWithinPartitions(*ordered)
              .withColumn("_qs_mid", F.monotonically_increasing_id()))
    if pin_result:
        ranged = pin(ranged, f"keys-{key}")
    located = ranged.withColumns({
        "_qs_part": F.shiftright(F.col("_qs_mid"), _POS_BITS),
        "_qs_pos": F.col("_qs_mid").bitwiseAND(F.lit((1 << _POS_BITS) - 1)),
    })
    # One row per partition: cheap to aggregate, bounded, safe to broadcast.
    counts = located.groupBy("_qs_part").agg(F.count(F.lit(1)).alias("_qs_n"))
    offsets = counts.select(
        "_qs_part",
        (F.sum("_qs_n").over(Window.orderBy("_qs_part").rowsBetween(Window.unboundedPreceding, -1)))
        .alias("_qs_offset"))
    keyed = located.join(F.broadcast(offsets), "_qs_part", "left")
    return keyed.withColumn(key, (F.coalesce(F.col("_qs_offset"), F.lit(0)) + F.col("_qs_pos")).cast("long")) \
        .drop("_qs_mid", "_qs_part", "_qs_pos", "_qs_offset")
