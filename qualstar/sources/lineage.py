"""Lineage columns added at ingestion."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LINEAGE_COLUMNS = ["ingestion_timestamp", "source_file", "raw_record_hash"]


def add_lineage(df: DataFrame, source_file: str | None = None,
                ingestion_timestamp: str | None = None, data_columns=None) -> DataFrame:
    """Add ``ingestion_timestamp`` (ISO text, UTC), ``source_file`` and
    ``raw_record_hash`` (Murmur3 over the data columns, Spark's ``hash``).

    ``source_file=None`` records the real file of each row from the scan's
    metadata, which also works when one read covers many files.
    """
    cols = list(data_columns or [c for c in df.columns if c not in LINEAGE_COLUMNS])
    ts = ingestion_timestamp or datetime.now(timezone.utc).replace(tzinfo=None).isoformat()
    if source_file is not None:
        src = F.lit(source_file)
    elif "_metadata" in df.columns or _has_metadata(df):
        src = F.col("_metadata.file_path")
    else:
        src = F.lit(None).cast("string")
    return df.withColumns({
        "ingestion_timestamp": F.lit(ts),
        "source_file": src,
        "raw_record_hash": F.hash(*[F.col(c) for c in cols]),
    })


def _has_metadata(df: DataFrame) -> bool:
    try:
        df.select("_metadata.file_path").schema
        return True
    except Exception:
        return False


def record_fingerprint(df: DataFrame, data_columns=None):
    """64-bit fingerprint that tells NULL apart from any value (for dedup use)."""
    cols = list(data_columns or df.columns)
    parts = []
    for c in cols:
        parts += [F.col(c).isNull(), F.col(c)]
    return F.xxhash64(*parts)
