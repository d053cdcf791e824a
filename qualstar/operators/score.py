"""Weighted quality score, classification and routing of tax returns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from ..params import TaxParams

_WEIGHTED = [("_nric_score", "nric"), ("_postal_score", "postal_code"), ("_date_score", "filing_date"),
             ("_calc_score", "tax_calculation"), ("_cpf_score", "cpf"),
             ("_completeness_score", "completeness")]

CLASSES = ["Accept", "Quarantine", "Reject"]


def calculate_dq_score(df: DataFrame, p: TaxParams = TaxParams()) -> DataFrame:
    """``data_quality_score`` = weighted sum of the six component scores as
    Decimal(3,2), so the thresholds compare exact decimals, not doubles."""
    total = None
    for col, key in _WEIGHTED:
        term = F.col(col) * F.lit(float(p.weights[key]))
        total = term if total is None else total + term
    return df.withColumn("data_quality_score", total.cast(DecimalType(3, 2)))


def classify_records(df: DataFrame, p: TaxParams = TaxParams()) -> DataFrame:
    s = F.col("data_quality_score")
    acc, qua = F.lit(p.accept_threshold), F.lit(p.quarantine_threshold)
    return df.withColumns({
        "dq_classification": F.when(s >= acc, "Accept").when(s >= qua, "Quarantine").otherwise("Reject"),
        "is_valid_record": s >= acc,
        "is_quarantined": (s >= qua) & (s < acc),
        "is_rejected": s < qua,
    })


def score_and_classify(df: DataFrame, p: TaxParams = TaxParams()) -> DataFrame:
    return classify_records(calculate_dq_score(df, p), p)


def class_counts(df: DataFrame) -> DataFrame:
    """Rows per class in one aggregation (all three classes, zero if absent)."""
    agg = df.agg(*[F.count_if(F.col("dq_classification") == c).alias(c) for c in CLASSES])
    stack = ", ".join(f"'{c}', `{c}`" for c in CLASSES)
    return agg.selectExpr(f"stack({len(CLASSES)}, {stack}) AS (dq_classification, record_count)")


def route(df: DataFrame, p: TaxParams = TaxParams(), drop_null_year: bool = True):
    """(silver, rejected): Accept + Quarantine vs Reject.  Rows without an
    assessment year cannot be written into the year-partitioned layers and are
    left out of both when ``drop_null_year``.

    The split tests the score against the lower threshold (the same sets as
    testing the class): the optimizer pushes a filter below the projections
    by inlining what it references, and the score is far smaller to inline
    than the class CASE, which refers to the score twice."""
    keep = F.col("assessment_year").isNotNull() if drop_null_year else F.lit(True)
    floor = F.lit(min(p.accept_threshold, p.quarantine_threshold))
    silver = df.filter((F.col("data_quality_score") >= floor) & keep)
    rejected = df.filter((F.col("data_quality_score") < floor) & keep)
    return silver, rejected


def unplaced(df: DataFrame) -> DataFrame:
    """The rows that year-partitioned layers have no place for."""
    return df.filter(F.col("assessment_year").isNull())
