"""Business correction and cleaning of tax returns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import digits_only
from ..params import TaxParams


def apply_cpf_correction(df: DataFrame) -> DataFrame:
    """Non-residents cannot contribute to CPF: a positive amount becomes 0.0.

    Run after validation, so the violation flag still reports the raw value."""
    fix = (F.col("residential_status") == "Non-Resident") & (F.col("cpf_contributions_sgd") > 0)
    return df.withColumn("cpf_contributions_sgd",
                         F.when(fix, F.lit(0.0)).otherwise(F.col("cpf_contributions_sgd")))


def _postal_cleansed(p: TaxParams):
    stripped = digits_only("postal_code")
    ok = stripped.rlike(r"^\d{6}$") & stripped.try_cast("int").between(p.postal_min, p.postal_max)
    return F.when(ok, stripped).otherwise(F.col("postal_code"))


def _filing_date_cleansed(p: TaxParams):
    fd = F.col("filing_date")
    # try_to_date: impossible dates (2024-13-45) become NULL instead of failing
    # the job; d/M/yyyy reads one- and two-digit day and month.
    return (F.when(fd.rlike(r"^\d{4}-\d{2}-\d{2}$"), F.try_to_date(fd, "yyyy-MM-dd"))
            .when(fd.rlike(p.dmy_pattern), F.try_to_date(fd, "d/M/yyyy")))


def _nric_cleansed():
    n = F.col("nric")
    return F.when(n.isNotNull() & (n != ""), n)


def clean_postal_code(df: DataFrame, p: TaxParams = TaxParams()) -> DataFrame:
    """Digits only when that gives a valid code; otherwise the raw value is kept."""
    return df.withColumn("postal_code_cleansed", _postal_cleansed(p))


def clean_filing_date(df: DataFrame, p: TaxParams = TaxParams()) -> DataFrame:
    return df.withColumn("filing_date_cleansed", _filing_date_cleansed(p))


def clean_nric(df: DataFrame) -> DataFrame:
    return df.withColumn("nric_cleansed", _nric_cleansed())


def clean_all(df: DataFrame, p: TaxParams = TaxParams()) -> DataFrame:
    return df.withColumns({
        "postal_code_cleansed": _postal_cleansed(p),
        "filing_date_cleansed": _filing_date_cleansed(p),
        "nric_cleansed": _nric_cleansed(),
    })
