"""Command line: ``python -m qualstar tax ...`` and ``python -m qualstar dq ...``.

tax  CSV of returns -> bronze, silver, rejected, gold (parquet under --out)
dq   CSV of grant applications -> five result tables (CSV under --out),
     optionally appended to history tables (--history)
"""

from __future__ import annotations

import argparse
import json
import logging
import sys

from .params import DQParams, TaxParams
from .session import build_session


def _parser() -> argparse.ArgumentParser:
    ap = argparse.ArgumentParser(prog="qualstar")
    sub = ap.add_subparsers(dest="command", required=True)
    t = sub.add_parser("tax", help="tax-return pipeline")
    t.add_argument("--csv-path", required=True)
    t.add_argument("--out", required=True, help="folder for bronze/silver/rejected/gold")
    t.add_argument("--postal-lookup", default=None, help="JSON array of postal districts (default: built in)")
    t.add_argument("--fact-grain", choices=["return", "reference"], default="return")
    t.add_argument("--null-years", choices=["raise", "drop"], default="raise")
    d = sub.add_parser("dq", help="data-quality analysis")
    d.add_argument("--data-path", required=True)
    d.add_argument("--out", required=True)
    d.add_argument("--history", default=None)
    d.add_argument("--sla-days", type=int, default=DQParams().sla_days)
    d.add_argument("--max-age-years", type=int, default=DQParams().max_age_years)
    d.add_argument("--as-of", default=None, help="reference time for age rules (default: now)")
    d.add_argument("--infer-schema", action="store_true")
    ap.add_argument("--master", default=None)
    return ap


def main(argv=None) -> dict:
    # Unknown arguments are ignored (as schedulers add their own).
    args, _unknown = _parser().parse_known_args(argv)
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(levelname)s %(name)s %(message)s")
    spark = build_session(args.master)
    out = args.out.rstrip("/")
    if args.command == "tax":
        from .plans.tax import Paths, run_full_pipeline
        res = run_full_pipeline(spark, args.csv_path,
                                Paths(f"{out}/bronze", f"{out}/silver", f"{out}/rejected", f"{out}/gold"),
                                TaxParams(fact_grain=args.fact_grain), lookup_path=args.postal_lookup,
                                bronze_null_years=args.null_years)
        summary = {"class_counts": res["class_counts"], "gold_tables": sorted(res["gold"])}
    else:
        from .plans.dq import run_analysis
        from .sources.files import read_grant_csv
        params = DQParams(sla_days=args.sla_days, max_age_years=args.max_age_years, as_of=args.as_of)
        data = read_grant_csv(spark, args.data_path, infer=True) if args.infer_schema else args.data_path
        run = run_analysis(spark, data, out, params, history_dir=args.history)
        summary = {"execution_id": run.execution_id,
                   "scores": {r.dimension_name: r.score for r in run.scores_minimal.collect()}}
    print(json.dumps(summary))
    return summary


if __name__ == "__main__":
    main(sys.argv[1:])
