import pytest

from qualstar.operators.rules import default_rules
from qualstar.params import DQParams, TaxParams


def test_weights_must_fit_the_score_type():
    with pytest.raises(ValueError):
        TaxParams(weights={"nric": 5.0, "postal_code": 5.0, "filing_date": 0, "tax_calculation": 0, "cpf": 0,
                           "completeness": 0})
    with pytest.raises(ValueError):
        TaxParams(fact_grain="daily")


def test_rule_names_follow_parameters():
    names = {r.rule_id: r.rule_name for r in default_rules(DQParams(sla_days=14, max_age_years=3))}
    assert names["T001"] == "decision_lag <= 14 days"
    assert names["T002"] == "application_date not > 3 years old"
    assert len(names) == 25


def test_custom_thresholds_change_classes(spark):
    from qualstar.operators.score import classify_records, calculate_dq_score
    cols = ("_nric_score double, _postal_score double, _date_score double, _calc_score double, "
            "_cpf_score double, _completeness_score double")
    df = spark.createDataFrame([(1.0, 1.0, 0.0, 1.0, 1.0, 1.0)], cols)  # 0.80
    p = TaxParams(accept_threshold=0.9, quarantine_threshold=0.5)
    assert classify_records(calculate_dq_score(df, p), p).first().dq_classification == "Quarantine"
