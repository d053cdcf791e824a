"""CSV reading that keeps malformed records apart instead of nulling them.

A record with a wrong number of fields, or with a value that its column's type
can't hold, keeps its text in ``_corrupt_record``; the other columns hold what
could be read.  Spark converts the columns that a query needs only, so a bad
value in any other would go unseen; the filters here need every column, and a
record is judged by all its fields whichever a query asks for.
"""

from __future__ import annotations

import logging
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from .files import TAX_SCHEMA, missing_columns

log = logging.getLogger(__name__)

CORRUPT = "_corrupt_record"


@dataclass
class CheckedCsv:
    """``good``: typed rows with the columns of the schema.  ``bad``: (line
    order lost) record, n_fields, bad_fields and source_file of each rejected record."""
    good: DataFrame
    bad: DataFrame


def read_csv_checked(spark: SparkSession, path: str, schema: StructType, check_header: bool = True) -> CheckedCsv:
    """The records of CSV files with a header line, split by whether they fit ``schema``.

    Missing header columns are logged, not raised."""
    if check_header and (missing := missing_columns(spark, path, schema.names)):
        log.warning("missing required columns in %s: %s", path, missing)
    kept = StructType([*schema.fields, StructField(CORRUPT, StringType(), True)])
    rows = (spark.read.schema(kept).option("header", True).option("mode", "PERMISSIVE").option("enforceSchema", True)
            .option("columnNameOfCorruptRecord", CORRUPT).option("escape", '"').csv(path))
    # True of every row; it reads all columns, and the optimizer can't tell that it is true.
    whole = F.pmod(F.hash(*schema.names), F.lit(2)) < 2
    bad = (rows.filter(whole & F.col(CORRUPT).isNotNull())
           .select(F.col(schema.names[0]), F.col(CORRUPT).alias("record"), F.col("_metadata.file_path").alias("source_file")))
    return CheckedCsv(rows.filter(whole & F.col(CORRUPT).isNull()).drop(CORRUPT), diagnose(bad, schema))


def read_tax_csv_checked(spark: SparkSession, path: str) -> CheckedCsv:
    return read_csv_checked(spark, path, TAX_SCHEMA)


def field_count(record: str | Column) -> Column:
    """Fields of a CSV record: commas outside quotes, plus one."""
    record = F.col(record) if isinstance(record, str) else record
    bare = F.regexp_replace(record, '"(?:[^"]|"")*"', "")
    return (F.length(bare) - F.length(F.replace(bare, F.lit(","), F.lit(""))) + 1).cast("int")


def diagnose(bad: DataFrame, schema: StructType) -> DataFrame:
    """``bad`` with ``n_fields`` and ``bad_fields``: the columns, in order and
    joined by commas, whose text is no value of their type (empty: the number
    of fields alone is wrong)."""
    texts = ", ".join(f"`{n}` string" for n in schema.names)
    parsed = bad.withColumns({"n_fields": field_count("record"),
                              "_f": F.from_csv("record", texts, {"escape": '"', "mode": "PERMISSIVE"})})
    wrong = [F.when(F.col("_f")[f.name].isNotNull() & F.col("_f")[f.name].try_cast(f.dataType).isNull(), F.lit(f.name))
             for f in schema.fields if f.dataType != StringType()]
    return parsed.withColumn("bad_fields", F.concat_ws(",", *wrong)).drop("_f")


def reject_counts(checked: CheckedCsv, expected_fields: int) -> DataFrame:
    """(outcome, n_rows): records read, and how many were rejected for which reason
    (a wrong number of fields goes before a bad value)."""
    good = checked.good.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit("good").alias("outcome"), "n_rows")
    short = F.col("n_fields") != expected_fields
    bad = checked.bad.agg(F.count_if(short).alias("wrong_field_count"), F.count_if(~short).alias("bad_value"))
    return good.unionByName(bad.selectExpr("stack(2, 'wrong_field_count', wrong_field_count, 'bad_value', bad_value) AS (outcome, n_rows)"))
