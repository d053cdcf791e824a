import os
from datetime import datetime

from qualstar.params import DQParams, GRANT_COLUMNS
from qualstar.plans import history
from qualstar.plans.dq import analyse, record_history
from tests.test_pipeline import GRANT_ROWS

SCHEMA = ", ".join(f"{c} {t}" for c, t in GRANT_COLUMNS)


def _df(spark, rows):
    conv = []
    for r in rows:
        conv.append(tuple(None if v == "" else (float(v) if t == "double" else int(v) if t == "int" else v)
                          for v, (_, t) in zip(r, GRANT_COLUMNS)))
    return spark.createDataFrame(conv, SCHEMA)


def test_trend_drilldown_report_alert(spark, tmp_dir):
    hist = os.path.join(tmp_dir, "hist")
    p = DQParams(as_of="2024-06-01 00:00:00")
    r1 = analyse(_df(spark, GRANT_ROWS[:1]), p, execution_id="r1", execution_timestamp=datetime(2024, 6, 1))
    record_history(r1, hist)
    r2 = analyse(_df(spark, GRANT_ROWS), p, execution_id="r2", execution_timestamp=datetime(2024, 6, 2))
    record_history(r2, hist)
    record_history(r2, hist)  # replayed run is counted once
    scores = history.load(spark, hist, "dq_dimension_scores")
    trend = {(r.dimension_name, r.execution_id): r for r in history.dimension_trend(scores).collect()}
    assert len(trend) == 12
    assert trend[("Uniqueness", "r1")].score == 100.0 and trend[("Uniqueness", "r1")].previous_score is None
    assert trend[("Uniqueness", "r2")].score_change == round(100 / 3, 2) - 100.0
    fails = history.failing_rules(history.load(spark, hist, "dq_rule_results"), "r2", 50.0).collect()
    ids = [f.rule_id for f in fails]
    assert "U001" in ids and "V002" in ids and all(f.failure_rate > 50 for f in fails)
    report = history.score_report(scores).collect()
    assert [r.execution_id for r in report] == ["r1", "r2"]
    low = {r.dimension_name for r in history.alerts(scores, 50.0).collect()}
    assert "Uniqueness" in low
