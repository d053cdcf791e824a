import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from qualstar.operators.clean import apply_cpf_correction, clean_all
from qualstar.operators.score import class_counts, classify_records, calculate_dq_score, route
from qualstar.params import TaxParams


def test_cleaning_rows(spark):
    rows = [("ABC123", "15/03/2024", ""), ("11-9077", "2024-03-15", None), ("119077", "invalid-date", "S1234567A"),
            ("999999", "2024-13-45", "T1"), (None, "5/3/2024", "")]
    df = clean_all(spark.createDataFrame(rows, "postal_code string, filing_date string, nric string"))
    out = df.collect()
    assert [r.postal_code_cleansed for r in out] == ["ABC123", "119077", "119077", "999999", None]
    assert [r.filing_date_cleansed for r in out] == [dt.date(2024, 3, 15), dt.date(2024, 3, 15), None, None,
                                                     dt.date(2024, 3, 5)]
    assert [r.nric_cleansed for r in out] == [None, None, "S1234567A", "T1", None]


def test_cpf_correction(spark):
    df = spark.createDataFrame([("Non-Resident", 5000.0), ("Resident", 5000.0), ("Non-Resident", 0.0)],
                               "residential_status string, cpf_contributions_sgd double")
    assert [r[0] for r in apply_cpf_correction(df).select("cpf_contributions_sgd").collect()] == [0.0, 5000.0, 0.0]


def _scores(spark, rows):
    cols = "_nric_score double, _postal_score double, _date_score double, _calc_score double, _cpf_score double, _completeness_score double"
    return classify_records(calculate_dq_score(spark.createDataFrame(rows, cols)))


def test_scores_and_boundaries(spark):
    # weights: nric .25, postal .15, date .20, calc .15, cpf .10, completeness .15
    rows = [(1.0,) * 6,                          # 1.00 Accept
            (0.0, 1.0, 0.0, 1.0, 1.0, 1.0),      # 0.55 Reject
            (1.0, 1.0, 0.0, 1.0, 1.0, 1.0),      # 0.80 Accept (boundary)
            (1.0, 1.0, 0.0, 0.0, 0.0, 0.0),      # 0.40 Reject
            (0.0,) * 6,                          # 0.00 Reject
            (1.0, 0.0, 0.0, 1.0, 1.0, 1.0)]      # 0.65 Quarantine
    out = _scores(spark, rows).collect()
    assert [r.data_quality_score for r in out] == [Decimal("1.00"), Decimal("0.55"), Decimal("0.80"),
                                                   Decimal("0.40"), Decimal("0.00"), Decimal("0.65")]
    assert [r.dq_classification for r in out] == ["Accept", "Reject", "Accept", "Reject", "Reject", "Quarantine"]
    assert [r.is_valid_record for r in out] == [True, False, True, False, False, False]
    assert [r.is_quarantined for r in out] == [False, False, False, False, False, True]


def test_threshold_exactly_point_six(spark):
    # 0.25 + 0.20 + 0.15 = 0.60 (doubles may land just below; the Decimal cast fixes it)
    r = _scores(spark, [(1.0, 0.0, 1.0, 0.0, 0.0, 1.0)]).collect()[0]
    assert r.data_quality_score == Decimal("0.60")
    assert r.dq_classification == "Quarantine" and r.is_quarantined and not r.is_rejected


def test_class_counts_and_route(spark):
    rows = [(1.0,) * 6, (0.0,) * 6, (1.0, 0.0, 1.0, 0.0, 0.0, 1.0)]
    df = _scores(spark, rows).withColumn("assessment_year", F.lit(2023))
    counts = {r[0]: r[1] for r in class_counts(df).collect()}
    assert counts == {"Accept": 1, "Quarantine": 1, "Reject": 1}
    silver, rejected = route(df, TaxParams())
    assert silver.count() == 2 and rejected.count() == 1
