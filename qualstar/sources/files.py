"""File sources: typed tax-return CSV, grant-application CSV, postal look-up JSON."""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, LongType, StringType, StructField, StructType

from ..params import GRANT_COLUMNS, POSTAL_DISTRICTS, TAX_COLUMNS

log = logging.getLogger(__name__)

_TYPES = {"string": StringType(), "int": IntegerType(), "double": DoubleType(), "long": LongType()}


def schema_of(columns) -> StructType:
    return StructType([StructField(n, _TYPES[t], True) for n, t in columns])


TAX_SCHEMA = schema_of(TAX_COLUMNS)
GRANT_SCHEMA = schema_of(GRANT_COLUMNS)


def missing_columns(spark: SparkSession, path: str, required) -> list[str]:
    """Required columns absent from the file's header line (reads one line per file)."""
    header = (spark.read.option("header", False).csv(path).limit(1).collect())
    present = {str(v).strip() for v in header[0]} if header else set()
    return [c for c in required if c not in present]


def read_tax_csv(spark: SparkSession, path: str, check_header: bool = True) -> DataFrame:
    """Tax returns from CSV with header and the fixed 18-column schema.

    Malformed numbers become NULL (PERMISSIVE).  Missing header columns are
    logged, not raised, so a partial file still loads.
    """
    if check_header:
        missing = missing_columns(spark, path, [n for n, _ in TAX_COLUMNS])
        if missing:
            log.warning("missing required columns in %s: %s", path, missing)
    return (spark.read.schema(TAX_SCHEMA).option("header", True).option("mode", "PERMISSIVE")
            .option("enforceSchema", True).csv(path))


def read_grant_csv(spark: SparkSession, path: str, infer: bool = False) -> DataFrame:
    """Grant applications from CSV.

    Default: explicit schema with dates as text, so the date rules see the raw
    value.  ``infer=True`` infers types (one extra pass over the file); typed
    date columns are then accepted by the date rules as already parsed.
    """
    reader = spark.read.option("header", True)
    if infer:
        return reader.option("inferSchema", True).csv(path)
    return reader.schema(GRANT_SCHEMA).csv(path)


POSTAL_JSON_SCHEMA = StructType([
    StructField("district", LongType(), True),
    StructField("area", StringType(), True),
    StructField("postal_codes", ArrayType(StringType()), True),
    StructField("region", StringType(), True),
])


def read_postal_lookup(spark: SparkSession, path: str | None = None) -> DataFrame:
    """(postal_prefix, region, planning_area), one row per two-digit prefix.

    From a JSON array of districts when ``path`` is given, else from the
    built-in district table.  The result is bounded by the 100 possible
    prefixes, which is what makes broadcasting it safe.
    """
    if path is not None:
        raw = spark.read.schema(POSTAL_JSON_SCHEMA).option("multiLine", True).json(path)
    else:
        raw = spark.createDataFrame(
            [(d, a, p, r) for d, a, p, r in POSTAL_DISTRICTS], POSTAL_JSON_SCHEMA)
    return (raw.select(F.explode("postal_codes").alias("postal_prefix"), "region",
                       F.col("area").alias("planning_area"))
            .dropDuplicates(["postal_prefix"]))


def inferred_types(spark: SparkSession, path: str) -> list[tuple[str, str, str]]:
    """(column, type of the explicit schema, type that inference finds) of a
    grant CSV: what a run with ``infer=True`` would work on."""
    found = {f.name: f.dataType.simpleString() for f in read_grant_csv(spark, path, infer=True).schema}
    return [(f.name, f.dataType.simpleString(), found.get(f.name, "missing")) for f in GRANT_SCHEMA]


def postal_lookup_rows():
    """The built-in look-up as (prefix, region, area) tuples."""
    return [(p, r, a) for _, a, ps, r in POSTAL_DISTRICTS for p in ps]
