"""Star schema over the accepted returns: four dimensions and one fact.

Dimensions are ``distinct`` projections (partial aggregation collapses hot
values map-side before the shuffle) numbered by ``assign_dense_keys`` on
their full natural key.  The fact resolves the four keys with left joins on
the natural keys; a dimension is broadcast only when a bounded count proves
it small, otherwise the join is a shuffle join, where AQE splits skewed
partitions of the fact side.
"""

from __future__ import annotations

from collections.abc import Collection
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import occupation_category, postal_prefix
from ..params import TaxParams
from ..sources.files import read_postal_lookup
from ..session import checkpoint_dir
from .keys import assign_dense_keys

TAXPAYER_ATTRS = ["taxpayer_id", "nric", "full_name", "filing_status", "residential_status",
                  "number_of_dependents"]
LOCATION_ATTRS = ["postal_code", "postal_code_raw", "housing_type"]

FACT_MEASURES = ["annual_income_sgd", "chargeable_income_sgd", "tax_payable_sgd", "tax_paid_sgd",
                 "total_reliefs_sgd", "cpf_contributions_sgd", "foreign_income_sgd"]
FACT_QUALITY = ["data_quality_score", "dq_classification", "is_valid_record", "is_quarantined",
                "is_rejected", "has_invalid_nric", "has_invalid_postal_code", "has_invalid_date",
                "has_calculation_error", "has_business_rule_violation", "has_completeness_issue"]


def build_dim_taxpayer(df: DataFrame) -> DataFrame:
    dim = df.select("taxpayer_id", F.col("nric_cleansed").alias("nric"), "full_name", "filing_status",
                    "residential_status", "number_of_dependents").distinct()
    dim = assign_dense_keys(dim, TAXPAYER_ATTRS, "taxpayer_key")
    return dim.select("taxpayer_key", *TAXPAYER_ATTRS)


def build_dim_time(df: DataFrame) -> DataFrame:
    fd = F.col("filing_date_cleansed")
    dim = (df.filter(fd.isNotNull())
           .select("assessment_year", fd.alias("filing_date"))
           .distinct())
    dim = assign_dense_keys(dim, ["assessment_year", "filing_date"], "time_key")
    m = F.month("filing_date")
    return dim.select(
        "time_key", "assessment_year",
        F.year("filing_date").alias("filing_year"), m.alias("filing_month"),
        F.quarter("filing_date").alias("filing_quarter"), "filing_date",
        F.col("filing_date").isNotNull().alias("is_valid_date"),
        F.when(m <= 3, "Early").when(m <= 4, "On-time").otherwise("Late").alias("tax_season_flag"))


def build_dim_location(df: DataFrame, p: TaxParams = TaxParams(), lookup: DataFrame | None = None) -> DataFrame:
    lookup = lookup if lookup is not None else read_postal_lookup(df.sparkSession)
    dim = df.select(F.col("postal_code_cleansed").alias("postal_code"),
                    F.col("postal_code").alias("postal_code_raw"), "housing_type").distinct()
    dim = assign_dense_keys(dim, LOCATION_ATTRS, "location_key")
    # The look-up has at most 100 rows (two-digit prefixes): broadcast is safe.
    dim = (dim.withColumn("postal_prefix", postal_prefix("postal_code"))
           .join(F.broadcast(lookup), "postal_prefix", "left"))
    pc = F.col("postal_code")
    valid = (pc.isNotNull() & pc.rlike(r"^\d{6}$")
             & F.coalesce(pc.try_cast("int").between(p.postal_min, p.postal_max), F.lit(False)))
    return dim.select("location_key", *LOCATION_ATTRS, "region", "planning_area",
                      valid.alias("is_valid_postal_code"))


def build_dim_occupation(df: DataFrame, p: TaxParams = TaxParams()) -> DataFrame:
    dim = df.select(F.col("occupation").alias("occupation_raw")).distinct()
    dim = dim.withColumn("occupation", F.trim(F.upper("occupation_raw")))
    dim = assign_dense_keys(dim, ["occupation", "occupation_raw"], "occupation_key")
    return dim.select("occupation_key", "occupation",
                      occupation_category("occupation_raw", p.occupation_categories).alias("occupation_category"),
                      "occupation_raw")


_TYPE_BYTES = {"string": 32, "long": 8, "double": 8, "integer": 4, "date": 4, "boolean": 1,
               "timestamp": 8, "timestamp_ntz": 8, "short": 2, "byte": 1, "float": 4}


def estimated_row_bytes(df: DataFrame) -> int:
    return max(1, sum(_TYPE_BYTES.get(f.dataType.typeName(), 16) for f in df.schema.fields))


def _bytes(conf: str) -> int:
    s = str(conf).strip().lower()
    units = {"b": 1, "k": 1 << 10, "kb": 1 << 10, "m": 1 << 20, "mb": 1 << 20, "g": 1 << 30, "gb": 1 << 30}
    for u in sorted(units, key=len, reverse=True):
        if s.endswith(u) and s[: -len(u)].lstrip("-").isdigit():
            return int(s[: -len(u)]) * units[u]
    return int(s)


def broadcast_if_small(dim: DataFrame, max_bytes: int | None = None) -> DataFrame:
    """Broadcast ``dim`` when a bounded count shows it under ``max_bytes``
    (default: the session's auto-broadcast threshold); otherwise ask for a
    sort-merge join, so the planner does not broadcast it on the strength of
    its compressed file size.  The count stops after ``max_rows + 1`` rows,
    so checking a large dimension costs no more than reading that many rows."""
    if max_bytes is None:
        max_bytes = _bytes(dim.sparkSession.conf.get("spark.sql.autoBroadcastJoinThreshold", "10485760"))
    if max_bytes <= 0:
        return dim
    max_rows = max(1, max_bytes // estimated_row_bytes(dim))
    n = dim.limit(max_rows + 1).count()
    return F.broadcast(dim) if n <= max_rows else dim.hint("shuffle_merge")


def build_fact_tax_returns(df: DataFrame, dim_taxpayer: DataFrame | None, dim_time: DataFrame | None,
                           dim_location: DataFrame | None, dim_occupation: DataFrame | None,
                           p: TaxParams = TaxParams(), with_fact_key: bool = True) -> DataFrame:
    """One row per return (``fact_grain='return'``) with its four keys, the
    money measures, the derived rates and the quality flags.  The key of a
    dimension that is None is left out, and so is its join.

    ``fact_grain='reference'`` joins taxpayer on ``taxpayer_id`` and location
    on the cleansed postal code only; both are not unique in their dimension,
    so a return can appear several times.
    """
    grain_return = p.fact_grain == "return"
    f = df.alias("f")
    attributes = {"tp": (dim_taxpayer, ["taxpayer_key", *TAXPAYER_ATTRS]), "tm": (dim_time, ["time_key", "assessment_year", "filing_date"]),
                  "lc": (dim_location, ["location_key", *LOCATION_ATTRS]), "oc": (dim_occupation, ["occupation_key", "occupation_raw"])}
    narrow = {a: dim.select(*names) for a, (dim, names) in attributes.items() if dim is not None}
    # The bounded size checks are independent small jobs: run them together.
    with ThreadPoolExecutor(max_workers=max(1, len(narrow))) as pool:
        checked = dict(zip(narrow, pool.map(broadcast_if_small, narrow.values()), strict=True))

    if grain_return:
        tp_pairs = [("f.taxpayer_id", "tp.taxpayer_id"), ("f.nric_cleansed", "tp.nric"),
                    ("f.full_name", "tp.full_name"), ("f.filing_status", "tp.filing_status"),
                    ("f.residential_status", "tp.residential_status"),
                    ("f.number_of_dependents", "tp.number_of_dependents")]
        lc_pairs = [("f.postal_code_cleansed", "lc.postal_code"), ("f.postal_code", "lc.postal_code_raw"),
                    ("f.housing_type", "lc.housing_type")]
    else:
        tp_pairs = [("f.taxpayer_id", "tp.taxpayer_id")]
        lc_pairs = [("f.postal_code_cleansed", "lc.postal_code")]

    def cond(pairs, null_safe):
        cs = [(F.col(a).eqNullSafe(F.col(b)) if null_safe else F.col(a) == F.col(b)) for a, b in pairs]
        return reduce(lambda x, y: x & y, cs)

    on = {"tp": cond(tp_pairs, grain_return), "lc": cond(lc_pairs, grain_return), "oc": cond([("f.occupation", "oc.occupation_raw")], grain_return),
          "tm": cond([("f.assessment_year", "tm.assessment_year"), ("f.filing_date_cleansed", "tm.filing_date")], False)}
    joined = f
    for a, dim in checked.items():
        joined = joined.join(dim.alias(a), on[a], "left")

    paid, payable, income = F.col("f.tax_paid_sgd"), F.col("f.tax_payable_sgd"), F.col("f.annual_income_sgd")
    cols = []
    if with_fact_key:
        cols.append(F.monotonically_increasing_id().alias("fact_key"))
    cols += [F.col(f"{a}.{names[0]}") for a, (dim, names) in attributes.items() if dim is not None]
    cols += [F.col("f.assessment_year").alias("assessment_year")]
    cols += [F.col(f"f.{m}").alias(m) for m in FACT_MEASURES]
    cols += [
        (paid / F.when(payable == 0, F.lit(1.0)).otherwise(payable)).alias("tax_compliance_rate"),
        (payable - paid).alias("tax_liability"),
        (payable / F.when(income == 0, F.lit(1.0)).otherwise(income)).alias("effective_tax_rate"),
    ]
    cols += [F.col(f"f.{q}").alias(q) for q in FACT_QUALITY]
    cols += [F.col(f"f.{c}").alias(c) for c in ("ingestion_timestamp", "source_file") if c in df.columns]
    return joined.select(*cols)


def build_star_schema(df: DataFrame, p: TaxParams = TaxParams(), lookup: DataFrame | None = None,
                      with_fact_key: bool = True, parallel: bool = True, only: Collection[str] | None = None) -> dict[str, DataFrame]:
    """Four dimensions and the fact.  The dimension builds are independent
    jobs (key assignment runs a sampling job and a pinned write each), so
    they are submitted from four driver threads and run concurrently.
    ``only`` names the dimensions that a question reads: no others are built,
    and the fact has their keys only."""
    checkpoint_dir(df.sparkSession)
    builders = {
        "dim_taxpayer": lambda: build_dim_taxpayer(df),
        "dim_time": lambda: build_dim_time(df),
        "dim_location": lambda: build_dim_location(df, p, lookup),
        "dim_occupation": lambda: build_dim_occupation(df, p),
    }
    builders = {name: fn for name, fn in builders.items() if only is None or name in only}
    if parallel:
        with ThreadPoolExecutor(max_workers=max(1, len(builders))) as pool:
            futures = {name: pool.submit(fn) for name, fn in builders.items()}
            dims = {name: f.result() for name, f in futures.items()}
    else:
        dims = {name: fn() for name, fn in builders.items()}
    dims["fact_tax_returns"] = build_fact_tax_returns(df, dims.get("dim_taxpayer"), dims.get("dim_time"),
                                                      dims.get("dim_location"), dims.get("dim_occupation"), p,
                                                      with_fact_key=with_fact_key)
    return dims
