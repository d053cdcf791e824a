import os

from qualstar.cli import main
from qualstar.params import GRANT_COLUMNS, TAX_COLUMNS
from tests.test_pipeline import GRANT_ROWS, TAX_ROWS, write_csv


def test_cli_tax_and_dq(spark, tmp_dir):
    src = os.path.join(tmp_dir, "returns.csv")
    write_csv(src, [c for c, _ in TAX_COLUMNS], TAX_ROWS)
    res = main(["tax", "--csv-path", src, "--out", os.path.join(tmp_dir, "tax"), "--unknown-flag", "x"])
    assert res["class_counts"]["Accept"] == 2 and len(res["gold_tables"]) == 5
    g = os.path.join(tmp_dir, "grants.csv")
    write_csv(g, [c for c, _ in GRANT_COLUMNS], GRANT_ROWS)
    res = main(["dq", "--data-path", g, "--out", os.path.join(tmp_dir, "dq"), "--as-of", "2024-06-01 00:00:00"])
    assert set(res["scores"]) == {"Completeness", "Uniqueness", "Validity", "Conformity", "Consistency", "Timeliness"}
