"""DuckDB SQL for the queries that go through files (``plans.registry_io``)."""

from __future__ import annotations

from . import oracle
from .oracle import ORACLE_EXECUTION_ID, ORACLE_EXECUTION_ID_2, ORACLE_EXECUTION_TS, ORACLE_EXECUTION_TS_2, q
from .params import GRANT_COLUMNS, RULE_CATALOGUE, TAX_COLUMNS, DQParams
from .sources.adapters import grant_applications_sql, resubmitted_sql, tax_returns_sql

ORACLE_DQ_PARAMS = DQParams(as_of=oracle.ORACLE_AS_OF)
FAR_EXECUTION_TS = "2001-12-03 00:00:00"

#: Which returns (by the number in their id) have which defect in the CSV; ``quoted_name`` is none.
TAX_DEFECTS = {"bad_income": "_k % 37 = 5", "extra": "_k % 41 = 7", "short": "_k % 43 = 11", "bad_year": "_k % 47 = 13", "quoted_name": "_k % 29 = 3"}

_BAD = " OR ".join(TAX_DEFECTS[d] for d in ("bad_income", "extra", "short", "bad_year"))


def _read_tax() -> str:
    """The returns that the CSV holds in good records, as they are read back."""
    return f"""
numbered AS (SELECT *, CAST(substr(taxpayer_id, 3) AS BIGINT) AS _k FROM ({tax_returns_sql()})),
read_back AS (SELECT * EXCLUDE (_k) REPLACE (CASE WHEN {TAX_DEFECTS['quoted_name']} THEN concat('Doe "X", ', full_name) ELSE full_name END AS full_name)
              FROM numbered WHERE NOT ({_BAD}))"""


def _over(sql: str, source: str, cte: str) -> str:
    """``sql`` of ``oracle`` with other rows in place of a view."""
    view = {"tax_returns": tax_returns_sql(), "grant_applications": grant_applications_sql()}[cte]
    assert f"{cte} AS ({view})" in sql
    return sql.replace(f"{cte} AS ({view})", f"{cte} AS ({source})", 1)


def _source_queries() -> dict[str, str]:
    names = ", ".join(n for n, _ in TAX_COLUMNS)
    short, extra = TAX_DEFECTS["short"], TAX_DEFECTS["extra"]
    fields = f"CAST(18 - CASE WHEN {short} THEN 2 ELSE 0 END + CASE WHEN {extra} THEN 1 ELSE 0 END AS INTEGER)"
    # Fields after the missing two move up: the one too many stands where the first of them did.
    shifted = f"CASE WHEN {short} AND {extra} THEN 'cpf_contributions_sgd' END"
    bad = f"concat_ws(',', CASE WHEN {TAX_DEFECTS['bad_year']} THEN 'assessment_year' END, CASE WHEN {TAX_DEFECTS['bad_income']} THEN 'annual_income_sgd' END, {shifted})"
    one = "regexp_matches({c}, '^[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}$')"
    inferred = {"application_id": "string", "citizen_nric": "string", "grant_scheme_name": "string", "household_income": "double", "household_size": "int",
                "application_date": "string", "application_status": "string", "requested_amount": "double", "approved_amount": "double", "decision_date": "string"}
    types = ", ".join(f"({q(n)}, {q(t)}, {q(inferred[n])})" for n, t in GRANT_COLUMNS)
    typed = (f"SELECT * FROM ({grant_applications_sql()}) WHERE {one.format(c='application_date')} "
             f"AND (decision_date IS NULL OR {one.format(c='decision_date')})")
    return {
        "src_tax_csv": f"WITH {_read_tax()} SELECT {names} FROM read_back",
        "src_tax_csv_rejects": f"WITH {_read_tax()} SELECT taxpayer_id, {fields} AS n_fields, {bad} AS bad_fields, TRUE AS has_text, TRUE AS has_source FROM numbered WHERE {_BAD}",
        "src_tax_csv_counts": (f"WITH {_read_tax()}, bad AS (SELECT {fields} AS n FROM numbered WHERE {_BAD}) SELECT 'good' AS outcome, count(*) AS n_rows FROM read_back "
                               "UNION ALL SELECT 'wrong_field_count', count(*) FROM bad WHERE n <> 18 UNION ALL SELECT 'bad_value', count(*) FROM bad WHERE n = 18"),
        "src_lineage": f"WITH {_read_tax()} SELECT taxpayer_id, {q(ORACLE_EXECUTION_TS)} AS ingestion_timestamp, 'returns.csv' AS source_file, TRUE AS has_hash FROM read_back",
        "src_grant_csv": f"SELECT * FROM ({grant_applications_sql()})",
        "src_grant_csv_types": f"SELECT * FROM (VALUES {types}) AS t(column_name, explicit_type, inferred_type)",
        "src_grant_csv_inferred_rule_results": _over(oracle.dq_queries(ORACLE_DQ_PARAMS)["dq_rule_results"], typed, "grant_applications"),
        "src_postal_lookup_json": oracle.tax_queries()["src_postal_lookup"],
    }


def _layer_queries() -> dict[str, str]:
    v, s = oracle.validated_ctes(), oracle.star_ctes()
    placed = (", placed AS (SELECT *, CASE WHEN assessment_year IS NULL THEN 'unplaced' WHEN data_quality_score >= 0.6 THEN 'silver' ELSE 'rejected' END AS output FROM scored)")
    names = ", ".join(n for n, _ in TAX_COLUMNS)
    job = _over(oracle.gold_ctes(), f"SELECT {names} FROM read_back", "tax_returns")
    layers = ["SELECT 'quarantine' AS layer, count(*) AS n_rows FROM numbered WHERE " + _BAD, "SELECT 'bronze', count(*) FROM read_back",
              "SELECT 'unplaced', count(*) FROM scored WHERE assessment_year IS NULL",
              *[f"SELECT {q(n)}, count(*) FROM {n}" for n in ("silver", "rejected", "dim_taxpayer", "dim_time", "dim_location", "dim_occupation", "fact_tax_returns")]]
    return {
        "layer_routed_silver": f"WITH {v.strip()} SELECT * FROM silver",
        "layer_routed_counts": f"WITH {v.strip()}{placed} SELECT output, assessment_year, count(*) AS n_rows FROM placed GROUP BY ALL",
        "layer_pruned_years": (f"WITH {v.strip()}{placed}, focus AS (SELECT assessment_year FROM placed WHERE output <> 'unplaced' GROUP BY ALL "
                               "HAVING count_if(output = 'rejected') / count(*) >= (SELECT count_if(output = 'rejected') / count(*) FROM placed WHERE output <> 'unplaced')) SELECT assessment_year, dq_classification, count(*) AS n_rows, sum(tax_paid_sgd) AS tax_paid "
                               "FROM silver JOIN focus USING (assessment_year) GROUP BY ALL"),
        "layer_reconciliation": f"WITH {_read_tax().strip()},{job} " + " UNION ALL ".join(layers),
        "fact_key_properties": (f"WITH {s.strip()}, f AS ({oracle._fact_select('return')}) SELECT count(*) AS n_rows, count(*) AS n_keys, "
                                "CAST(0 AS BIGINT) AS n_null, CAST(0 AS BIGINT) AS n_negative FROM f"),
    }


def _result_queries() -> dict[str, str]:
    dq = oracle.dq_queries(ORACLE_DQ_PARAMS)
    t = f"({tax_returns_sql()})"
    none = "CAST(NULL AS BIGINT)"
    guards = [("null year, raise", "refused", none), ("null year, drop", "written", f"(SELECT count(assessment_year) FROM {t})"),
              ("null year, keep", "written", f"(SELECT count(*) FROM {t})"), ("no null year, raise", "written", f"(SELECT count(assessment_year) FROM {t})"),
              ("empty frame", "written", "CAST(0 AS BIGINT)"), ("no partition column", "refused", none),
              ("text partition column", "refused", none), ("empty path", "refused", none)]
    names = {rid: name.format(sla=ORACLE_DQ_PARAMS.sla_days, years=ORACLE_DQ_PARAMS.max_age_years) for rid, name, _ in RULE_CATALOGUE}
    rates = " UNION ALL ".join(f"SELECT {q(rid)} AS rule_id, {q(names[rid])} AS rule_name, {q(dim)} AS dimension, count(*) AS total_rows, CAST(count_if(p_{rid}) AS BIGINT) AS passing_rows, "
                               f"CAST(count(*) - count_if(p_{rid}) AS BIGINT) AS failing_rows, count_if(p_{rid}) / count(*) * 100 AS pass_rate FROM flags" for rid, _, dim in RULE_CATALOGUE)
    flags = f"WITH {oracle.grant_ctes().strip()},\nflags AS (SELECT {oracle._rule_flags_select(ORACLE_DQ_PARAMS)} FROM ga_ctx)"
    execution = ("SELECT {id} AS execution_id, TIMESTAMP {ts} AS execution_timestamp, " + f"{q(ORACLE_DQ_PARAMS.dataset_name)} AS dataset_name, "
                 "CAST(NULL AS VARCHAR) AS dataset_version, CAST({n} AS BIGINT) AS total_rows, {status} AS status")
    again = f"(SELECT count(*) FROM ({resubmitted_sql()}))"
    runs = [(ORACLE_EXECUTION_ID, ORACLE_EXECUTION_TS_2, again, "SUCCESS"), (ORACLE_EXECUTION_ID_2, ORACLE_EXECUTION_TS_2, "0", "FAILED"), ("0003", FAR_EXECUTION_TS, "0", "FAILED")]
    scores = _over(oracle.dq_queries(ORACLE_DQ_PARAMS, ORACLE_EXECUTION_ID)["dq_dimension_scores"], resubmitted_sql(), "grant_applications")
    rules = oracle.rule_sql(ORACLE_DQ_PARAMS)
    unique = " UNION ALL ".join(f"SELECT {q(r)} AS rule_id, application_id, coalesce({rules[r]}, FALSE) AS passed, count(*) AS n_rows FROM ga_ctx GROUP BY ALL" for r in ("U001", "U002"))
    return {
        "snk_write_guards": " UNION ALL ".join(f"SELECT {q(g)} AS guard, {q(o)} AS outcome, {n} AS n_rows" for g, o, n in guards),
        "snk_csv_rule_results": dq["dq_rule_results"], "snk_csv_execution": dq["dq_execution"],
        "dq_rule_pass_rates": f"{flags} {rates}",
        "dq_history_executions": " UNION ALL ".join(execution.format(id=q(i), ts=q(ts), n=n, status=q(st)) for i, ts, n, st in runs),
        "dq_history_recorded_scores": f"SELECT *, TIMESTAMP '{ORACLE_EXECUTION_TS_2}' AS execution_timestamp FROM ({scores})",
        "dq_stream_uniqueness": f"WITH {oracle.grant_ctes(resubmitted_sql()).strip()} {unique}",
    }


def queries() -> dict[str, str]:
    return _source_queries() | _layer_queries() | _result_queries()
