"""Tax-return pipeline: bronze -> silver/rejected -> gold star schema.

Layers are handed on through the written parquet (each layer is read back
from storage), so a later layer never recomputes an earlier one and an
executor loss costs at most the tasks of the running layer.
"""

from __future__ import annotations

import logging
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.clean import apply_cpf_correction, clean_all
from ..operators.score import CLASSES, route, score_and_classify
from ..operators.star import build_star_schema
from ..operators.validate import apply_all_validations
from ..params import TaxParams
from ..sinks.writers import read_routed, write_partitioned, write_routed, write_table
from ..session import pin, unpin
from ..sources.checked import read_tax_csv_checked
from ..sources.files import read_postal_lookup, read_tax_csv
from ..sources.lineage import add_lineage

log = logging.getLogger(__name__)


def silver_transform(df: DataFrame, p: TaxParams = TaxParams()) -> DataFrame:
    """Validate -> correct CPF -> clean -> score and classify (all row-local,
    one stage, no shuffle)."""
    return score_and_classify(clean_all(apply_cpf_correction(apply_all_validations(df, p)), p), p)


@dataclass
class Paths:
    bronze: str
    silver: str
    rejected: str
    gold: str
    unplaced: str | None = None     # scored returns without an assessment year; default: beside rejected
    quarantine: str | None = None   # malformed CSV records (None: loaded with NULL for what can't be read)
    layers: str | None = None       # one routed table in place of silver, rejected and unplaced, written in one pass

    @property
    def unplaced_path(self) -> str:
        return self.unplaced or self.rejected.rstrip("/") + "_unplaced"


def run_bronze(spark: SparkSession, source, bronze_path: str, source_file: str | None = None,
               ingestion_timestamp: str | None = None, null_years: str = "raise",
               quarantine_path: str | None = None) -> DataFrame:
    """CSV path (typed read) or a DataFrame with the 18 columns -> bronze.

    With ``quarantine_path``, CSV records with a wrong number of fields or a
    value that doesn't fit its column go there, as text with what is wrong;
    without it they are loaded with NULL in place of what can't be read.

    A NULL assessment year stops the run by default (``null_years='raise'``);
    ``'keep'`` holds such rows in the layer's partition for NULL, and the
    silver step writes them to their own output; ``'drop'`` leaves them out."""
    if isinstance(source, str) and quarantine_path:
        checked = read_tax_csv_checked(spark, source)
        write_table(checked.bad, quarantine_path)
        raw, name = checked.good, source_file or source
    elif isinstance(source, str):
        raw, name = read_tax_csv(spark, source), source_file or source
    else:
        raw, name = source, source_file
    df = add_lineage(raw, source_file=name, ingestion_timestamp=ingestion_timestamp)
    write_partitioned(df, bronze_path, on_null=null_years)
    # With its schema: a layer that has the partition for NULL only would lose the column's type.
    return spark.read.schema(df.schema).parquet(bronze_path)


def run_silver(bronze: DataFrame, silver_path: str, rejected_path: str, p: TaxParams = TaxParams(),
               unplaced_path: str | None = None):
    """Scores every return once (written to the shared scratch folder), writes
    Accept + Quarantine to silver, Reject to rejected and returns without an
    assessment year to ``unplaced_path``, so every return is in one output.
    Returns both layers read back from storage, and the class counts."""
    scored = pin(silver_transform(bronze, p), "scored")
    try:
        # One aggregation: rows per class, and rows / NULL years per route
        # (the write guards), instead of a count job per number.
        floor = F.lit(min(p.accept_threshold, p.quarantine_threshold))
        keep = F.col("data_quality_score") >= floor
        null_year = F.col("assessment_year").isNull()
        prof = scored.agg(
            *[F.count_if(F.col("dq_classification") == c).alias(c) for c in CLASSES],
            F.count_if(keep).alias("silver_n"), F.count_if(keep & null_year).alias("silver_null"),
            F.count_if(~keep).alias("rejected_n"), F.count_if(~keep & null_year).alias("rejected_null"),
        ).first()
        counts = {c: int(prof[c]) for c in CLASSES}
        silver, rejected = route(scored, p, drop_null_year=False)
        n_silver = write_partitioned(silver, silver_path, on_null="drop",
                                     profile=(prof["silver_n"], prof["silver_null"]))
        n_rejected = write_partitioned(rejected, rejected_path, on_null="drop",
                                       profile=(prof["rejected_n"], prof["rejected_null"]))
        write_table(scored.filter(null_year), unplaced_path or rejected_path.rstrip("/") + "_unplaced")
    finally:
        unpin(scored)
    spark = bronze.sparkSession
    out_silver = spark.read.parquet(silver_path) if n_silver else None
    out_rejected = spark.read.parquet(rejected_path) if n_rejected else None
    return out_silver, out_rejected, counts


def run_routed(bronze: DataFrame, layers_path: str, p: TaxParams = TaxParams()):
    """Like :func:`run_silver`, with one write: every scored return goes to the
    folder of its output (silver, rejected, or unplaced without an assessment
    year) and year, and the class counts are observed on the way.  No scratch
    table, and the bronze layer is scanned and scored once."""
    scored = silver_transform(bronze, p)
    floor = F.lit(min(p.accept_threshold, p.quarantine_threshold))
    to = (F.when(F.col("assessment_year").isNull(), "unplaced").when(F.col("data_quality_score") >= floor, "silver").otherwise("rejected"))
    seen = write_routed(scored, layers_path, to, metrics={c: F.count_if(F.col("dq_classification") == c) for c in CLASSES})
    silver, rejected = (read_routed(bronze.sparkSession, layers_path, scored.schema, r) for r in ("silver", "rejected"))
    return silver, rejected, {c: seen[c] for c in CLASSES}


def run_gold(silver: DataFrame, gold_path: str, p: TaxParams = TaxParams(), lookup_path: str | None = None):
    lookup = read_postal_lookup(silver.sparkSession, lookup_path)
    star = build_star_schema(silver, p, lookup)
    base = gold_path.rstrip("/")
    for name, df in star.items():
        if name == "fact_tax_returns":
            # Silver holds no NULL years: nothing to guard, so the fact plan runs once.
            write_partitioned(df, f"{base}/{name}", on_null="keep")
        else:
            write_table(df, f"{base}/{name}")
    spark = silver.sparkSession
    return {name: spark.read.parquet(f"{base}/{name}") for name in star}


def run_full_pipeline(spark: SparkSession, source, paths: Paths, p: TaxParams = TaxParams(),
                      lookup_path: str | None = None, source_file: str | None = None,
                      ingestion_timestamp: str | None = None, bronze_null_years: str = "raise") -> dict:
    """Bronze -> silver/rejected -> gold.  ``source`` is a CSV path or a DataFrame."""
    bronze = run_bronze(spark, source, paths.bronze, source_file, ingestion_timestamp, bronze_null_years, paths.quarantine)
    if paths.layers:
        silver, rejected, counts = run_routed(bronze, paths.layers, p)
    else:
        silver, rejected, counts = run_silver(bronze, paths.silver, paths.rejected, p, paths.unplaced_path)
    if silver is None or paths.layers and silver.isEmpty():
        log.warning("no accepted or quarantined returns; gold layer not built")
        gold = {}
    else:
        gold = run_gold(silver, paths.gold, p, lookup_path)
    return {"bronze": bronze, "silver": silver, "rejected": rejected, "gold": gold, "class_counts": counts}
