from pyspark.sql import functions as F

from qualstar.operators.validate import (apply_all_validations, validate_completeness, validate_cpf_rule,
                                         validate_filing_date, validate_nric, validate_postal_code,
                                         validate_tax_calculation)
from qualstar.params import TaxParams

COLS = ("nric string, postal_code string, filing_date string, assessment_year int, annual_income_sgd double, "
        "chargeable_income_sgd double, total_reliefs_sgd double, residential_status string, "
        "cpf_contributions_sgd double")


def mixed(spark):
    rows = [
        ("S7412083K", "258104", "2024-06-02", 2023, 64200.0, 60200.0, 4000.0, "Resident", 12840.0),
        ("", "25-810", "2024-19-77", 2023, 51000.0, 40000.0, 11000.0, "Non-Resident", 900.0),
        ("T7654321B", "520123", "2022-12-31", 2023, 60000.0, 50000.0, 10000.0, "Resident", 12000.0),
    ]
    return spark.createDataFrame(rows, COLS)


def flags(df, col):
    return [r[col] for r in df.select(col).collect()]


def test_mixed_rows(spark):
    df = apply_all_validations(mixed(spark))
    assert flags(df, "has_invalid_nric") == [False, True, False]
    assert flags(df, "has_invalid_postal_code") == [False, True, False]
    # Format + year only: the impossible date passes, the early filing fails.
    assert flags(df, "has_invalid_date") == [False, False, True]
    assert flags(df, "has_calculation_error") == [False, False, False]
    assert flags(df, "has_business_rule_violation") == [False, True, False]
    assert flags(df, "_nric_score") == [1.0, 0.0, 1.0]


def test_postal_bounds(spark):
    df = spark.createDataFrame([(c,) for c in ["99999", "830000", "100000", "829999", "010000", None, "",
                                              "12345678901234567890"]], "postal_code string")
    out, _ = validate_postal_code(df)
    assert flags(out, "has_invalid_postal_code") == [True, True, False, False, False, True, True, True]


def test_nric_allow_empty(spark):
    df = spark.createDataFrame([(None,), ("",), ("S1234567A",), ("X1234567A",)], "nric string")
    out, _ = validate_nric(df)
    assert flags(out, "has_invalid_nric") == [True, True, False, True]
    out, _ = validate_nric(df, TaxParams(nric_allow_empty=True))
    assert flags(out, "has_invalid_nric") == [False, False, False, True]


def test_dmy_dates_and_year(spark):
    df = spark.createDataFrame([("15/03/2024", 2024), ("5/3/2023", 2024), ("2024-01-01", 2024), ("2023-12-31", 2024),
                                (None, 2024), ("", 2024), ("2024/01/01", 2024)],
                               "filing_date string, assessment_year int")
    out, _ = validate_filing_date(df)
    assert flags(out, "has_invalid_date") == [False, True, False, True, True, True, True]


def test_null_calculation_inputs_give_null_flag_and_zero_score(spark):
    df = spark.createDataFrame([(None, None, None)],
                               "annual_income_sgd double, chargeable_income_sgd double, total_reliefs_sgd double")
    out, valid = validate_tax_calculation(df)
    assert flags(out, "has_calculation_error") == [None]
    assert out.select(F.when(valid, 1.0).otherwise(0.0).alias("s")).first()["s"] == 0.0


def test_tolerance(spark):
    df = spark.createDataFrame([(100.0, 89.9, 10.0), (100.0, 89.95, 10.0), (100.0, 90.2, 10.0)],
                               "annual_income_sgd double, chargeable_income_sgd double, total_reliefs_sgd double")
    out, _ = validate_tax_calculation(df)
    assert flags(out, "has_calculation_error") == [False, False, True]


def test_cpf_rule_and_switch(spark):
    df = spark.createDataFrame([("Non-Resident", 0.0), ("Non-Resident", 10.0), ("Resident", 10.0), (None, 10.0),
                                ("Non-Resident", None)], "residential_status string, cpf_contributions_sgd double")
    out, _ = validate_cpf_rule(df)
    assert flags(out, "has_business_rule_violation") == [False, True, False, False, None]
    out, _ = validate_cpf_rule(df, TaxParams(cpf_non_resident_must_be_zero=False))
    assert flags(out, "has_business_rule_violation") == [False] * 5


def test_completeness_per_type(spark):
    df = spark.createDataFrame([("a", 1, 1.0), ("", 1, 1.0), ("a", None, 1.0), ("a", 1, float("nan")), ("a", 1, None)],
                               "s string, i int, d double")
    out, _ = validate_completeness(df)
    assert flags(out, "has_completeness_issue") == [False, True, True, True, True]


def test_no_columns_frame(spark):
    df = spark.range(2).select()
    out, _ = validate_completeness(df)
    assert flags(out, "has_completeness_issue") == [False, False]


def test_null_assessment_year_gives_null_date_flag_and_zero_score(spark):
    df = spark.createDataFrame([("2024-03-15", None), ("15/03/2024", None), ("invalid-date", None)],
                               "filing_date string, assessment_year int")
    out, valid = validate_filing_date(df)
    assert flags(out, "has_invalid_date") == [None, None, True]
    assert [r[0] for r in out.select(F.when(valid, 1.0).otherwise(0.0)).collect()] == [0.0, 0.0, 0.0]


def test_flags_and_scores_of_a_complete_valid_row(spark):
    from qualstar.params import TAX_COLUMNS
    from qualstar.sources.files import schema_of
    row = ("TP1", "S1234567A", "Tan", "Single", 2023, "2024-03-15", 85000.0, 72050.0, 8205.0, 8500.0, 12950.0, 0,
           "Engineer", "Resident", "119077", "HDB 4-room", 17000.0, 0.0)
    out = apply_all_validations(spark.createDataFrame([row], schema_of(TAX_COLUMNS))).first()
    assert not any(out[f] for f in ["has_invalid_nric", "has_invalid_postal_code", "has_invalid_date",
                                    "has_calculation_error", "has_business_rule_violation",
                                    "has_completeness_issue"])
    assert all(out[s] == 1.0 for s in ["_nric_score", "_postal_score", "_date_score", "_calc_score", "_cpf_score",
                                       "_completeness_score"])
