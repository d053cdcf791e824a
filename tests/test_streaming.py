import os

from qualstar.params import DQParams, GRANT_COLUMNS, TAX_COLUMNS
from qualstar.streaming import start_class_counts, start_dq_monitor, start_tax_streams
from tests.test_pipeline import GRANT_ROWS, TAX_ROWS, write_csv


def test_tax_stream_routes_new_files_exactly_once(spark, tmp_dir):
    inbox = os.path.join(tmp_dir, "inbox")
    os.makedirs(inbox)
    write_csv(os.path.join(inbox, "day1.csv"), [c for c, _ in TAX_COLUMNS], TAX_ROWS[:2])
    silver, rejected, ck = (os.path.join(tmp_dir, d) for d in ("silver", "rejected", "ck"))
    for q in start_tax_streams(spark, inbox, silver, rejected, ck):
        q.awaitTermination()
    assert spark.read.parquet(silver).count() == 1 and spark.read.parquet(rejected).count() == 1
    # second drop, restart: only the new file is processed
    write_csv(os.path.join(inbox, "day2.csv"), [c for c, _ in TAX_COLUMNS], TAX_ROWS[2:])
    for q in start_tax_streams(spark, inbox, silver, rejected, ck):
        q.awaitTermination()
    assert spark.read.parquet(silver).count() == 2 and spark.read.parquet(rejected).count() == 2
    q = start_class_counts(spark, inbox, ck)
    q.awaitTermination()
    counts = {r.dq_classification: r.record_count for r in spark.sql("SELECT * FROM tax_classes").collect()}
    assert counts == {"Accept": 2, "Quarantine": 0, "Reject": 2}


def test_dq_monitor_appends_history(spark, tmp_dir):
    inbox = os.path.join(tmp_dir, "grants")
    os.makedirs(inbox)
    write_csv(os.path.join(inbox, "g1.csv"), [c for c, _ in GRANT_COLUMNS], GRANT_ROWS)
    hist, ck = os.path.join(tmp_dir, "hist"), os.path.join(tmp_dir, "ck")
    start_dq_monitor(spark, inbox, hist, ck, DQParams(as_of="2024-06-01 00:00:00")).awaitTermination()
    assert spark.read.parquet(os.path.join(hist, "dq_rule_results")).count() == 25
    assert spark.read.parquet(os.path.join(hist, "dq_execution")).first().total_rows == 3
