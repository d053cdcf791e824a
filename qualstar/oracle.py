"""Oracle SQL (DuckDB dialect) for every registered query.

Written as plain SQL over the driver's tables, independently of the
DataFrame code, so a check can run both and compare.  The adapter views are
shared text (``sources.adapters``); everything after them is restated here.
"""

from __future__ import annotations

from .params import (DATE_PLACEHOLDERS, GRANT_SCHEMES, NRIC_PATTERN, OCCUPATION_CATEGORIES,
                     PLACEHOLDER_SUBSTRINGS, RULE_CATALOGUE, SCORE_WEIGHTS, TAX_COLUMNS, DQParams,
                     OTHER_CATEGORY)
from .sources.adapters import grant_applications_sql, resubmitted_sql, tax_returns_sql
from .sources.files import postal_lookup_rows

ORACLE_AS_OF = "2001-12-01 00:00:00"
ORACLE_EXECUTION_ID = "00000000-0000-0000-0000-000000000001"
ORACLE_EXECUTION_TS = "2001-12-01 00:00:00"


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


# --------------------------------------------------------------------------
# Tax returns
# --------------------------------------------------------------------------

def _completeness_sql() -> str:
    parts = []
    for name, typ in TAX_COLUMNS:
        if typ == "string":
            parts.append(f"({name} IS NULL OR {name} = '')")
        elif typ == "double":
            parts.append(f"({name} IS NULL OR isnan({name}))")
        else:
            parts.append(f"({name} IS NULL)")
    return " OR ".join(parts)


_M32 = 4294967295


def _mul32(a: str, c: int) -> str:
    return f"(({a}) * {c}::UBIGINT & {_M32}::UBIGINT)"


def _rot32(a: str, n: int) -> str:
    return f"((({a}) * {1 << n}::UBIGINT & {_M32}::UBIGINT) | (({a}) >> {32 - n}))"


def _murmur3(columns: list[tuple[str, str]], seed: int = 42) -> str:
    """SQL for the 32-bit Murmur3 row hash of typed columns, each column's hash
    seeding the next and NULL leaving it as it is.

    A row is a list of numbers: words of 32 bits to mix in, and 2^32 plus the
    bytes of a value where its hash is finished; one fold goes over the list.
    """
    def byte(i):
        return f"('0x' || substr(hex(encode({{c}})), ({i}) * 2 + 1, 2))::UBIGINT"

    text = ("list_concat(list_transform(range(strlen({c}) // 4), lambda i: "
            + " + ".join(f"({byte(f'i * 4 + {k}')} * {1 << 8 * k}::UBIGINT)" for k in range(4))
            + "), list_transform(range(strlen({c}) // 4 * 4, strlen({c})), lambda i: "
            + f"{byte('i')} + CASE WHEN {byte('i')} > 127 THEN 4294967040::UBIGINT ELSE 0::UBIGINT END), "
            + "[(4294967296 + strlen({c}))::UBIGINT])")
    bits = "({c} + 0.0::DOUBLE)::BIT::UBIGINT"
    words = {"string": text,
             "int": f"[({{c}}::BIGINT & {_M32})::UBIGINT, 4294967300::UBIGINT]",
             "double": f"[{bits} & {_M32}::UBIGINT, {bits} >> 32, 4294967304::UBIGINT]"}
    row = ", ".join(f"CASE WHEN {c} IS NULL THEN []::UBIGINT[] ELSE {words[t].format(c=c)} END" for c, t in columns)
    mixed = _mul32(_rot32(_mul32("k", 0xCC9E2D51), 15), 0x1B873593)
    step = f"({_rot32(f'xor(h, {mixed})', 13)} * 5::UBIGINT + {0xE6546B64}::UBIGINT & {_M32}::UBIGINT)"
    end = "xor(h, k - 4294967296::UBIGINT)"
    for shift, factor in ((16, 0x85EBCA6B), (13, 0xC2B2AE35), (16, None)):
        end = f"xor({end}, ({end}) >> {shift})"
        end = _mul32(end, factor) if factor else end
    fold = f"list_reduce(flatten([{row}]), lambda h, k: CASE WHEN k < 4294967296 THEN {step} ELSE {end} END, {seed}::UBIGINT)"
    return f"(({fold})::BIGINT + 2147483648) % 4294967296 - 2147483648"


def hash_query() -> dict[str, str]:
    value = _murmur3([(c, t) for c, t in TAX_COLUMNS])
    return {"src_hash": f"SELECT taxpayer_id, ({value})::INTEGER AS raw_record_hash FROM ({tax_returns_sql()})"}


def validated_ctes() -> str:
    """tax_returns -> checks -> validated (flags + scores) -> scored."""
    w = SCORE_WEIGHTS
    return f"""
tax_returns AS ({tax_returns_sql()}),
checks AS (
  SELECT *,
    (nric IS NOT NULL AND nric <> '' AND regexp_matches(nric, '{NRIC_PATTERN}')) AS ok_nric,
    (postal_code IS NOT NULL AND postal_code <> '' AND regexp_matches(postal_code, '^\\d{{6}}$')
      AND (CASE WHEN regexp_matches(postal_code, '^\\d+$') THEN TRY_CAST(postal_code AS BIGINT) ELSE -1 END) >= 10000
      AND (CASE WHEN regexp_matches(postal_code, '^\\d+$') THEN TRY_CAST(postal_code AS BIGINT) ELSE -1 END) <= 829999) AS ok_postal,
    (filing_date IS NOT NULL AND filing_date <> ''
      AND (regexp_matches(filing_date, '^\\d{{4}}-\\d{{2}}-\\d{{2}}$') OR regexp_matches(filing_date, '^\\d{{1,2}}/\\d{{1,2}}/\\d{{4}}$'))
      AND (CASE WHEN regexp_matches(filing_date, '^\\d{{4}}-\\d{{2}}-\\d{{2}}$') THEN TRY_CAST(regexp_extract(filing_date, '^(\\d{{4}})', 1) AS INTEGER)
                WHEN regexp_matches(filing_date, '^\\d{{1,2}}/\\d{{1,2}}/\\d{{4}}$') THEN TRY_CAST(regexp_extract(filing_date, '(\\d{{4}})$', 1) AS INTEGER)
                ELSE -1 END) >= CAST(assessment_year AS INTEGER)) AS ok_date,
    (abs(chargeable_income_sgd - (annual_income_sgd - total_reliefs_sgd)) <= 0.1) AS ok_calc,
    (CASE WHEN residential_status = 'Non-Resident' THEN cpf_contributions_sgd = 0 ELSE TRUE END) AS ok_cpf,
    ({_completeness_sql()}) AS missing_any
  FROM tax_returns),
validated AS (
  SELECT * EXCLUDE (ok_nric, ok_postal, ok_date, ok_calc, ok_cpf, missing_any),
    NOT ok_nric AS has_invalid_nric,
    NOT ok_postal AS has_invalid_postal_code,
    NOT ok_date AS has_invalid_date,
    NOT ok_calc AS has_calculation_error,
    NOT ok_cpf AS has_business_rule_violation,
    missing_any AS has_completeness_issue,
    CASE WHEN ok_nric THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS _nric_score,
    CASE WHEN ok_postal THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS _postal_score,
    CASE WHEN ok_date THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS _date_score,
    CASE WHEN ok_calc THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS _calc_score,
    CASE WHEN ok_cpf THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS _cpf_score,
    CASE WHEN NOT missing_any THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS _completeness_score
  FROM checks),
corrected AS (
  SELECT * REPLACE (CASE WHEN residential_status = 'Non-Resident' AND cpf_contributions_sgd > 0
                         THEN 0.0::DOUBLE ELSE cpf_contributions_sgd END AS cpf_contributions_sgd)
  FROM validated),
cleaned AS (
  SELECT *,
    CASE WHEN regexp_matches(regexp_replace(postal_code, '[^0-9]', '', 'g'), '^\\d{{6}}$')
              AND TRY_CAST(regexp_replace(postal_code, '[^0-9]', '', 'g') AS INTEGER) BETWEEN 10000 AND 829999
         THEN regexp_replace(postal_code, '[^0-9]', '', 'g') ELSE postal_code END AS postal_code_cleansed,
    CASE WHEN regexp_matches(filing_date, '^\\d{{4}}-\\d{{2}}-\\d{{2}}$') THEN CAST(try_strptime(filing_date, '%Y-%m-%d') AS DATE)
         WHEN regexp_matches(filing_date, '^\\d{{1,2}}/\\d{{1,2}}/\\d{{4}}$') THEN CAST(try_strptime(filing_date, '%d/%m/%Y') AS DATE)
    END AS filing_date_cleansed,
    CASE WHEN nric IS NOT NULL AND nric <> '' THEN nric END AS nric_cleansed
  FROM corrected),
scored0 AS (
  SELECT *, CAST(_nric_score * {w['nric']} + _postal_score * {w['postal_code']} + _date_score * {w['filing_date']}
              + _calc_score * {w['tax_calculation']} + _cpf_score * {w['cpf']}
              + _completeness_score * {w['completeness']} AS DECIMAL(3,2)) AS data_quality_score
  FROM cleaned),
scored AS (
  SELECT *,
    CASE WHEN data_quality_score >= 0.8 THEN 'Accept' WHEN data_quality_score >= 0.6 THEN 'Quarantine' ELSE 'Reject' END AS dq_classification,
    data_quality_score >= 0.8 AS is_valid_record,
    (data_quality_score >= 0.6 AND data_quality_score < 0.8) AS is_quarantined,
    data_quality_score < 0.6 AS is_rejected
  FROM scored0),
silver AS (
  SELECT * FROM scored WHERE dq_classification IN ('Accept', 'Quarantine') AND assessment_year IS NOT NULL),
rejected AS (
  SELECT * FROM scored WHERE dq_classification = 'Reject' AND assessment_year IS NOT NULL)"""


def _with(body: str, ctes: str) -> str:
    return f"WITH {ctes.strip()}\n{body}"


def _occupation_case(col: str) -> str:
    whens = [f"WHEN {col} IS NULL OR {col} = '' THEN '{OTHER_CATEGORY}'"]
    for cat, kws in OCCUPATION_CATEGORIES:
        cond = " OR ".join(f"contains(upper({col}), {q(k.upper())})" for k in kws)
        whens.append(f"WHEN {cond} THEN {q(cat)}")
    return "CASE " + " ".join(whens) + f" ELSE '{OTHER_CATEGORY}' END"


def _lookup_values() -> str:
    rows = ", ".join(f"({q(p)}, {q(r)}, {q(a)})" for p, r, a in postal_lookup_rows())
    return f"(VALUES {rows}) AS lk(postal_prefix, region, planning_area)"


def star_ctes() -> str:
    return validated_ctes() + f""",
dim_taxpayer AS (
  SELECT CAST(row_number() OVER (ORDER BY taxpayer_id NULLS FIRST, nric NULLS FIRST, full_name NULLS FIRST,
            filing_status NULLS FIRST, residential_status NULLS FIRST, number_of_dependents NULLS FIRST) - 1 AS BIGINT) AS taxpayer_key,
         taxpayer_id, nric, full_name, filing_status, residential_status, number_of_dependents
  FROM (SELECT DISTINCT taxpayer_id, nric_cleansed AS nric, full_name, filing_status, residential_status,
               number_of_dependents FROM silver)),
dim_time AS (
  SELECT CAST(row_number() OVER (ORDER BY assessment_year NULLS FIRST, filing_date NULLS FIRST) - 1 AS BIGINT) AS time_key,
         assessment_year, CAST(year(filing_date) AS INTEGER) AS filing_year,
         CAST(month(filing_date) AS INTEGER) AS filing_month, CAST(quarter(filing_date) AS INTEGER) AS filing_quarter,
         filing_date, filing_date IS NOT NULL AS is_valid_date,
         CASE WHEN month(filing_date) <= 3 THEN 'Early' WHEN month(filing_date) <= 4 THEN 'On-time' ELSE 'Late' END AS tax_season_flag
  FROM (SELECT DISTINCT assessment_year, filing_date_cleansed AS filing_date FROM silver
        WHERE filing_date_cleansed IS NOT NULL)),
loc0 AS (
  SELECT CAST(row_number() OVER (ORDER BY postal_code NULLS FIRST, postal_code_raw NULLS FIRST, housing_type NULLS FIRST) - 1 AS BIGINT) AS location_key,
         postal_code, postal_code_raw, housing_type,
         CASE WHEN postal_code IS NOT NULL AND regexp_matches(postal_code, '^\\d{{2,}}') THEN regexp_extract(postal_code, '^(\\d{{2}})', 1) END AS postal_prefix
  FROM (SELECT DISTINCT postal_code_cleansed AS postal_code, postal_code AS postal_code_raw, housing_type FROM silver)),
dim_location AS (
  SELECT location_key, postal_code, postal_code_raw, housing_type, lk.region, lk.planning_area,
         (postal_code IS NOT NULL AND regexp_matches(postal_code, '^\\d{{6}}$')
          AND coalesce(TRY_CAST(postal_code AS INTEGER) BETWEEN 10000 AND 829999, FALSE)) AS is_valid_postal_code
  FROM loc0 LEFT JOIN {_lookup_values()} ON loc0.postal_prefix = lk.postal_prefix),
dim_occupation AS (
  SELECT CAST(row_number() OVER (ORDER BY occupation NULLS FIRST, occupation_raw NULLS FIRST) - 1 AS BIGINT) AS occupation_key,
         occupation, {_occupation_case('occupation_raw')} AS occupation_category, occupation_raw
  FROM (SELECT occupation_raw, trim(upper(occupation_raw)) AS occupation
        FROM (SELECT DISTINCT occupation AS occupation_raw FROM silver)))"""


def _fact_select(grain: str) -> str:
    if grain == "return":
        tp_on = ("f.taxpayer_id IS NOT DISTINCT FROM tp.taxpayer_id AND f.nric_cleansed IS NOT DISTINCT FROM tp.nric "
                 "AND f.full_name IS NOT DISTINCT FROM tp.full_name AND f.filing_status IS NOT DISTINCT FROM tp.filing_status "
                 "AND f.residential_status IS NOT DISTINCT FROM tp.residential_status "
                 "AND f.number_of_dependents IS NOT DISTINCT FROM tp.number_of_dependents")
        lc_on = ("f.postal_code_cleansed IS NOT DISTINCT FROM lc.postal_code AND f.postal_code IS NOT DISTINCT FROM lc.postal_code_raw "
                 "AND f.housing_type IS NOT DISTINCT FROM lc.housing_type")
        oc_on = "f.occupation IS NOT DISTINCT FROM oc.occupation_raw"
    else:
        tp_on = "f.taxpayer_id = tp.taxpayer_id"
        lc_on = "f.postal_code_cleansed = lc.postal_code"
        oc_on = "f.occupation = oc.occupation_raw"
    return f"""
  SELECT tp.taxpayer_key, tm.time_key, lc.location_key, oc.occupation_key, f.assessment_year,
    f.annual_income_sgd, f.chargeable_income_sgd, f.tax_payable_sgd, f.tax_paid_sgd, f.total_reliefs_sgd,
    f.cpf_contributions_sgd, f.foreign_income_sgd,
    f.tax_paid_sgd / CASE WHEN f.tax_payable_sgd = 0 THEN 1.0::DOUBLE ELSE f.tax_payable_sgd END AS tax_compliance_rate,
    f.tax_payable_sgd - f.tax_paid_sgd AS tax_liability,
    f.tax_payable_sgd / CASE WHEN f.annual_income_sgd = 0 THEN 1.0::DOUBLE ELSE f.annual_income_sgd END AS effective_tax_rate,
    f.data_quality_score, f.dq_classification, f.is_valid_record, f.is_quarantined, f.is_rejected,
    f.has_invalid_nric, f.has_invalid_postal_code, f.has_invalid_date, f.has_calculation_error,
    f.has_business_rule_violation, f.has_completeness_issue
  FROM silver f
  LEFT JOIN dim_taxpayer tp ON {tp_on}
  LEFT JOIN dim_time tm ON f.assessment_year = tm.assessment_year AND f.filing_date_cleansed = tm.filing_date
  LEFT JOIN dim_location lc ON {lc_on}
  LEFT JOIN dim_occupation oc ON {oc_on}"""


def gold_ctes() -> str:
    return star_ctes() + f",\nfact_tax_returns AS ({_fact_select('return')})"


def tax_queries() -> dict[str, str]:
    v = validated_ctes()
    out = {
        "tax_v1_nric": _with("SELECT taxpayer_id, has_invalid_nric FROM validated", v),
        "tax_v2_postal_code": _with("SELECT taxpayer_id, has_invalid_postal_code FROM validated", v),
        "tax_v3_filing_date": _with("SELECT taxpayer_id, has_invalid_date FROM validated", v),
        "tax_v4_tax_calculation": _with("SELECT taxpayer_id, has_calculation_error FROM validated", v),
        "tax_v5_cpf_rule": _with("SELECT taxpayer_id, has_business_rule_violation FROM validated", v),
        "tax_v6_completeness": _with("SELECT taxpayer_id, has_completeness_issue FROM validated", v),
        "tax_v7_all_validations": _with(
            "SELECT taxpayer_id, has_invalid_nric, has_invalid_postal_code, has_invalid_date, has_calculation_error, "
            "has_business_rule_violation, has_completeness_issue, _nric_score, _postal_score, _date_score, "
            "_calc_score, _cpf_score, _completeness_score FROM validated", v),
        "tax_cpf_correction": _with(
            "SELECT taxpayer_id, residential_status, cpf_contributions_sgd, has_business_rule_violation FROM corrected", v),
        "tax_clean": _with("SELECT taxpayer_id, postal_code_cleansed, filing_date_cleansed, nric_cleansed FROM cleaned", v),
        "tax_score": _with(
            "SELECT taxpayer_id, data_quality_score, dq_classification, is_valid_record, is_quarantined, is_rejected "
            "FROM scored", v),
        "tax_classification": _with(
            "SELECT c.dq_classification, count(s.dq_classification) AS record_count "
            "FROM (VALUES ('Accept'), ('Quarantine'), ('Reject')) AS c(dq_classification) "
            "LEFT JOIN scored s ON s.dq_classification = c.dq_classification GROUP BY c.dq_classification", v),
        "tax_route_silver": _with("SELECT * FROM silver", v),
        "tax_route_rejected": _with("SELECT * FROM rejected", v),
        "tax_route_unplaced": _with(
            "SELECT taxpayer_id, data_quality_score, dq_classification FROM scored WHERE assessment_year IS NULL", v),
        "tax_route_counts": _with(
            "SELECT 'silver' AS output, count(*) AS n_rows FROM silver UNION ALL SELECT 'rejected', count(*) FROM rejected "
            "UNION ALL SELECT 'unplaced', count(*) FROM scored WHERE assessment_year IS NULL", v),
        "src_postal_lookup": _with(
            "SELECT taxpayer_id, postal_code_cleansed, lk.postal_prefix, lk.region, lk.planning_area "
            "FROM (SELECT taxpayer_id, postal_code_cleansed, CASE WHEN postal_code_cleansed IS NOT NULL AND "
            "regexp_matches(postal_code_cleansed, '^\\d{2,}') THEN regexp_extract(postal_code_cleansed, '^(\\d{2})', 1) END AS pfx "
            f"FROM cleaned) c LEFT JOIN {_lookup_values()} ON c.pfx = lk.postal_prefix", v),
    }
    s = star_ctes()
    out.update({
        "dim_taxpayer": _with("SELECT * FROM dim_taxpayer", s),
        "dim_time": _with("SELECT * FROM dim_time", s),
        "dim_location": _with("SELECT * FROM dim_location", s),
        "dim_occupation": _with("SELECT * FROM dim_occupation", s),
        "fact_tax_returns": _with(_fact_select("return"), s),
        "fact_tax_returns_reference_grain": _with(_fact_select("reference"), s),
    })
    out.update(bo_queries())
    return out


def bo_queries() -> dict[str, str]:
    g = gold_ctes()
    r6 = lambda e: f"round({e}, 6)"  # noqa: E731  averages of ratios: rounded to 6 digits
    return {
        "bo_1_monthly_trend": _with(
            "SELECT t.filing_year, t.filing_month, sum(f.tax_paid_sgd) AS total_collected, "
            "sum(f.tax_payable_sgd) AS total_expected, count(*) AS return_count, "
            "avg(f.tax_paid_sgd) AS avg_collection_per_return "
            "FROM fact_tax_returns f JOIN dim_time t ON f.time_key = t.time_key "
            "GROUP BY t.filing_year, t.filing_month ORDER BY t.filing_year, t.filing_month", g),
        "bo_2a_by_filing_status": _with(
            "SELECT p.filing_status, count(*) AS taxpayer_count, avg(f.annual_income_sgd) AS avg_income, "
            f"avg(f.tax_payable_sgd) AS avg_tax, {r6('avg(f.effective_tax_rate)')} AS avg_tax_rate "
            "FROM fact_tax_returns f JOIN dim_taxpayer p ON f.taxpayer_key = p.taxpayer_key GROUP BY p.filing_status", g),
        "bo_2b_by_residency_dependents": _with(
            "SELECT p.residential_status, p.number_of_dependents, avg(f.annual_income_sgd) AS avg_income, "
            f"avg(f.total_reliefs_sgd) AS avg_reliefs, {r6('avg(f.effective_tax_rate)')} AS avg_tax_rate "
            "FROM fact_tax_returns f JOIN dim_taxpayer p ON f.taxpayer_key = p.taxpayer_key "
            "GROUP BY p.residential_status, p.number_of_dependents ORDER BY p.residential_status, p.number_of_dependents", g),
        "bo_3a_revenue_by_region": _with(
            "SELECT l.region, sum(f.tax_paid_sgd) AS total_revenue, count(*) AS taxpayer_count, "
            "avg(f.tax_paid_sgd) AS avg_revenue_per_taxpayer, "
            "sum(f.tax_paid_sgd) * 100.0 / (SELECT sum(tax_paid_sgd) FROM fact_tax_returns) AS revenue_percentage "
            "FROM fact_tax_returns f JOIN dim_location l ON f.location_key = l.location_key "
            "GROUP BY l.region ORDER BY total_revenue DESC", g),
        "bo_3b_revenue_by_housing": _with(
            "SELECT l.housing_type, sum(f.tax_paid_sgd) AS total_revenue, count(*) AS taxpayer_count, "
            "avg(f.annual_income_sgd) AS avg_income "
            "FROM fact_tax_returns f JOIN dim_location l ON f.location_key = l.location_key "
            "GROUP BY l.housing_type ORDER BY total_revenue DESC", g),
        "bo_3c_top_postal_codes": _with(
            "SELECT l.postal_code, l.region, l.housing_type, sum(f.tax_paid_sgd) AS total_revenue, count(*) AS taxpayer_count "
            "FROM fact_tax_returns f JOIN dim_location l ON f.location_key = l.location_key "
            "GROUP BY l.postal_code, l.region, l.housing_type "
            "ORDER BY total_revenue DESC, l.postal_code NULLS FIRST, l.region NULLS FIRST, l.housing_type NULLS FIRST LIMIT 20", g),
        "bo_4a_compliance_by_category": _with(
            f"SELECT o.occupation_category, count(*) AS total_returns, {r6('avg(f.tax_compliance_rate)')} AS avg_compliance_rate, "
            "CAST(sum(CASE WHEN f.tax_compliance_rate >= 0.95 THEN 1 ELSE 0 END) AS BIGINT) AS fully_compliant_count, "
            "CAST(sum(CASE WHEN f.tax_compliance_rate < 0.95 THEN 1 ELSE 0 END) AS BIGINT) AS non_compliant_count, "
            "sum(f.tax_liability) AS total_outstanding, avg(f.annual_income_sgd) AS avg_income "
            "FROM fact_tax_returns f JOIN dim_occupation o ON f.occupation_key = o.occupation_key "
            "GROUP BY o.occupation_category ORDER BY avg_compliance_rate DESC", g),
        "bo_4b_compliance_by_occupation": _with(
            f"SELECT o.occupation, o.occupation_category, count(*) AS return_count, {r6('avg(f.tax_compliance_rate)')} AS avg_compliance, "
            "avg(f.annual_income_sgd) AS avg_income, sum(f.tax_liability) AS total_liability "
            "FROM fact_tax_returns f JOIN dim_occupation o ON f.occupation_key = o.occupation_key "
            "GROUP BY o.occupation, o.occupation_category HAVING count(*) >= 5 ORDER BY avg_compliance DESC", g),
        "bo_x_compliance_region_status": _with(
            f"SELECT l.region, p.filing_status, {r6('avg(f.tax_compliance_rate)')} AS avg_compliance, count(*) AS taxpayer_count "
            "FROM fact_tax_returns f JOIN dim_location l ON f.location_key = l.location_key "
            "JOIN dim_taxpayer p ON f.taxpayer_key = p.taxpayer_key GROUP BY l.region, p.filing_status", g),
    }


# --------------------------------------------------------------------------
# Grant applications
# --------------------------------------------------------------------------

_PARSE_FORMATS = [
    ("^\\d{4}-\\d{1,2}-\\d{1,2}$", "%Y-%m-%d"),
    ("^\\d{1,2}/\\d{1,2}/\\d{4}$", "%d/%m/%Y"),
    ("^\\d{1,2}-\\d{1,2}-\\d{4}$", "%m-%d-%Y"),
    ("^\\d{4}-\\d{1,2}-\\d{1,2}T\\d{1,2}:\\d{1,2}:\\d{1,2}$", "%Y-%m-%dT%H:%M:%S"),
    ("^\\d{4}-\\d{1,2}-\\d{1,2}T\\d{1,2}:\\d{1,2}:\\d{1,2}\\.\\d{1,6}$", "%Y-%m-%dT%H:%M:%S.%f"),
]


def _strip(col: str) -> str:
    return f"regexp_replace({col}, '^\\s+|\\s+$', '', 'g')"


def _parse(col: str) -> str:
    s = _strip(col)
    tries = ", ".join(f"CASE WHEN regexp_matches({s}, '{rx}') THEN try_strptime({s}, '{fmt}') END"
                      for rx, fmt in _PARSE_FORMATS)
    ph = ", ".join(q(p) for p in DATE_PLACEHOLDERS)
    return (f"(CASE WHEN {s} <> '' AND upper({s}) NOT IN ({ph}) AND year(coalesce({tries})) >= 1 "
            f"THEN coalesce({tries}) END)")


def _strict_iso(col: str) -> str:
    s = _strip(col)
    return (f"coalesce(regexp_matches({s}, '^\\d{{4}}-\\d{{2}}-\\d{{2}}$') AND try_strptime({s}, '%Y-%m-%d') IS NOT NULL "
            f"AND substr({s}, 1, 4) <> '0000', FALSE)")


def _no_placeholder(col: str) -> str:
    return "NOT (" + " OR ".join(f"contains(upper({col}), {q(p)})" for p in PLACEHOLDER_SUBSTRINGS) + ")"


def rule_sql(params: DQParams = DQParams(), as_of: str = ORACLE_AS_OF) -> dict[str, str]:
    """Pass condition per rule over the ``ga_ctx`` view (three-valued)."""
    sla, max_days = params.sla_days, params.max_age_years * 365
    day = 86_400_000_000
    decided = "application_status IN ('Approved', 'Rejected')"
    schemes = ", ".join(q(s) for s in GRANT_SCHEMES)
    return {
        "C001": "(application_id IS NOT NULL AND trim(CAST(application_id AS VARCHAR)) <> '')",
        "C002": "(application_date IS NOT NULL AND trim(CAST(application_date AS VARCHAR)) <> '')",
        "C003": "(application_status IS NOT NULL AND trim(CAST(application_status AS VARCHAR)) <> '')",
        "C004": "(requested_amount IS NOT NULL)",
        "C005": "(CASE WHEN application_status = 'Approved' THEN approved_amount IS NOT NULL ELSE TRUE END)",
        "C006": f"(CASE WHEN {decided} THEN decision_date IS NOT NULL ELSE TRUE END)",
        "U001": "(id_rows = 1)",
        "U002": "(copy_no = 1)",
        "V001": f"(citizen_nric IS NOT NULL AND regexp_matches(citizen_nric, '{NRIC_PATTERN}'))",
        "V002": "(household_income >= 0 AND abs(household_income) < 10000000)",
        "V003": "(requested_amount >= 0)",
        "V004": "(CASE WHEN approved_amount IS NOT NULL THEN approved_amount >= 0 ELSE TRUE END)",
        "V005": "(household_size >= 1 AND household_size <= 20 AND household_size = TRY_CAST(household_size AS INTEGER))",
        "V006": "(CASE WHEN application_status <> 'Approved' THEN approved_amount IS NULL ELSE TRUE END)",
        "V007": (f"({_no_placeholder('application_date')} "
                 f"AND CASE WHEN decision_date IS NOT NULL THEN {_no_placeholder('decision_date')} ELSE TRUE END "
                 f"AND CASE WHEN citizen_nric IS NOT NULL THEN {_no_placeholder('citizen_nric')} ELSE TRUE END)"),
        "CF001": f"(CASE WHEN decision_date IS NOT NULL THEN {_strict_iso('decision_date')} ELSE TRUE END)",
        "CF002": f"({_strict_iso('application_date')} OR app_ts IS NOT NULL)",
        "CF003": "(application_status IN ('Pending', 'Approved', 'Rejected'))",
        "CF004": f"(upper(grant_scheme_name) IN ({schemes}))",
        "CS001": ("(CASE WHEN decision_date IS NOT NULL AND application_date IS NOT NULL "
                  "THEN coalesce(dec_ts >= app_ts, FALSE) ELSE TRUE END)"),
        "CS002": ("(CASE WHEN application_status = 'Approved' THEN approved_amount <= requested_amount "
                  "AND approved_amount > 0 ELSE TRUE END)"),
        "CS003": "(CASE WHEN application_status = 'Pending' THEN decision_date IS NULL ELSE TRUE END)",
        "CS004": f"(CASE WHEN {decided} THEN decision_date IS NOT NULL ELSE TRUE END)",
        "T001": (f"(CASE WHEN {decided} AND decision_date IS NOT NULL AND application_date IS NOT NULL "
                 f"THEN coalesce(epoch_us(dec_ts) - epoch_us(app_ts) >= 0 AND "
                 f"epoch_us(dec_ts) - epoch_us(app_ts) < {(sla + 1) * day}, FALSE) ELSE TRUE END)"),
        "T002": (f"(CASE WHEN application_date IS NOT NULL THEN coalesce(epoch_us(TIMESTAMP '{as_of}') - epoch_us(app_ts) "
                 f"< {(max_days + 1) * day}, FALSE) ELSE TRUE END)"),
    }


GRANT_COLS = ["application_id", "citizen_nric", "grant_scheme_name", "household_income", "household_size",
              "application_date", "application_status", "requested_amount", "approved_amount", "decision_date"]


def grant_ctes(source: str | None = None) -> str:
    cols = ", ".join(GRANT_COLS)
    src = source or grant_applications_sql()
    return f"""
grant_applications AS ({src}),
ga_ctx AS (
  SELECT *,
    count(*) OVER (PARTITION BY application_id) AS id_rows,
    row_number() OVER (PARTITION BY {cols}) AS copy_no,
    {_parse('application_date')} AS app_ts,
    {_parse('decision_date')} AS dec_ts
  FROM grant_applications)"""


def _rule_flags_select(params: DQParams) -> str:
    rs = rule_sql(params)
    return ", ".join(f"coalesce({rs[rid]}, FALSE) AS p_{rid}" for rid, _, _ in RULE_CATALOGUE)


def dq_queries(params: DQParams = DQParams(), execution_id: str = ORACLE_EXECUTION_ID,
               execution_ts: str = ORACLE_EXECUTION_TS) -> dict[str, str]:
    ctes = grant_ctes() + f",\nflags AS (SELECT {_rule_flags_select(params)} FROM ga_ctx)"
    out = {}
    rs = rule_sql(params)
    for rid, _, _ in RULE_CATALOGUE:
        out[f"dq_rule_{rid}"] = _with(
            f"SELECT application_id, coalesce({rs[rid]}, FALSE) AS passed, count(*) AS n_rows "
            "FROM ga_ctx GROUP BY ALL", grant_ctes())

    names = {rid: name.format(sla=params.sla_days, years=params.max_age_years) for rid, name, _ in RULE_CATALOGUE}
    rule_rows = " UNION ALL ".join(
        f"SELECT {i} AS o, {q(rid)} AS rule_id, {q(dim)} AS dimension_name, {q(names[rid])} AS rule_name, "
        f"count_if(p_{rid}) AS passing_rows, count(*) AS total_rows FROM flags"
        for i, (rid, _, dim) in enumerate(RULE_CATALOGUE))
    out["dq_rule_results"] = _with(
        f"SELECT {q(execution_id)} AS execution_id, rule_id, dimension_name, rule_name, "
        "CAST(total_rows AS BIGINT) AS total_rows, CAST(passing_rows AS BIGINT) AS passing_rows, "
        "CAST(total_rows - passing_rows AS BIGINT) AS failing_rows, "
        "CASE WHEN total_rows > 0 THEN CAST(round(CAST((total_rows - passing_rows) / total_rows * 100.0 AS DECIMAL(38,18)), 2) AS DOUBLE) ELSE 0.0 END AS failure_rate "
        f"FROM ({rule_rows}) ORDER BY o", ctes)

    dims = []
    for d in ["Completeness", "Uniqueness", "Validity", "Conformity", "Consistency", "Timeliness"]:
        members = [rid for rid, _, dd in RULE_CATALOGUE if dd == d]
        dims.append((d, members))
    dim_rows = " UNION ALL ".join(
        f"SELECT {i} AS o, {q(d)} AS dimension_name, {len(m)} AS rule_count, "
        f"count_if({' AND '.join('p_' + x for x in m)}) AS passing_rows, count(*) AS total_rows FROM flags"
        for i, (d, m) in enumerate(dims))
    dim_scores = (
        f"SELECT {q(execution_id)} AS execution_id, dimension_name, "
        "CASE WHEN total_rows > 0 THEN CAST(round(CAST(passing_rows / total_rows * 100.0 AS DECIMAL(38,18)), 2) AS DOUBLE) ELSE 0.0 END AS score, "
        "CAST(total_rows AS BIGINT) AS total_rows, CAST(passing_rows AS BIGINT) AS passing_rows, "
        "CAST(total_rows - passing_rows AS BIGINT) AS failing_rows, CAST(rule_count AS INTEGER) AS rule_count, o "
        f"FROM ({dim_rows})")
    out["dq_dimension_scores"] = _with(f"SELECT * EXCLUDE (o) FROM ({dim_scores}) ORDER BY o", ctes)
    out["dq_scores_minimal"] = _with(f"SELECT dimension_name, score FROM ({dim_scores}) ORDER BY o", ctes)
    out["dq_scores_full"] = _with(
        f"SELECT * EXCLUDE (o), {q(execution_ts.replace(' ', 'T'))} AS execution_timestamp, "
        f"{q(params.dataset_name)} AS dataset_name FROM ({dim_scores}) ORDER BY o", ctes)
    out["dq_execution"] = _with(
        f"SELECT {q(execution_id)} AS execution_id, TIMESTAMP '{execution_ts}' AS execution_timestamp, "
        f"{q(params.dataset_name)} AS dataset_name, CAST(NULL AS VARCHAR) AS dataset_version, "
        "CAST(count(*) AS BIGINT) AS total_rows, 'SUCCESS' AS status FROM grant_applications", ctes)
    return out


def resubmitted_queries(params: DQParams = DQParams(), execution_id: str = ORACLE_EXECUTION_ID) -> dict[str, str]:
    """U002 per id and all rule results over the view with Rejected rows resubmitted."""
    src = resubmitted_sql()
    rs = rule_sql(params)
    out = {"dq_resubmitted_rule_U002": _with(
        f"SELECT application_id, coalesce({rs['U002']}, FALSE) AS passed, count(*) AS n_rows FROM ga_ctx GROUP BY ALL",
        grant_ctes(src))}
    full = dq_queries(params, execution_id)["dq_rule_results"]
    out["dq_resubmitted_rule_results"] = full.replace(f"grant_applications AS ({grant_applications_sql()})",
                                                      f"grant_applications AS ({src})", 1)
    return out


def rule_table_query(params: DQParams = DQParams()) -> dict[str, str]:
    """Row-level rule table: every input row with its 25 rule results (NULL kept)."""
    rs = rule_sql(params)
    cols = ", ".join(GRANT_COLS)
    flags = ", ".join(f"{rs[rid]} AS rule_{rid}_pass" for rid, _, _ in RULE_CATALOGUE)
    return {"dq_rule_table": _with(f"SELECT {cols}, {flags} FROM ga_ctx", grant_ctes())}


ORACLE_EXECUTION_ID_2 = "00000000-0000-0000-0000-000000000002"
ORACLE_EXECUTION_TS_2 = "2001-12-02 00:00:00"


def history_queries(params: DQParams = DQParams()) -> dict[str, str]:
    """Trend over two monitor runs: the grant view, then the view with its
    Rejected applications resubmitted (a day later)."""
    def dim_scores(src, execution_id):
        q_ = dq_queries(params, execution_id)["dq_dimension_scores"]
        return q_.replace(f"grant_applications AS ({grant_applications_sql()})", f"grant_applications AS ({src})", 1)
    first = dim_scores(grant_applications_sql(), ORACLE_EXECUTION_ID)
    second = dim_scores(resubmitted_sql(), ORACLE_EXECUTION_ID_2)
    w = "PARTITION BY dimension_name ORDER BY execution_timestamp, execution_id"
    both = (f"SELECT *, TIMESTAMP '{ORACLE_EXECUTION_TS}' AS execution_timestamp FROM ({first}) UNION ALL "
            f"SELECT *, TIMESTAMP '{ORACLE_EXECUTION_TS_2}' AS execution_timestamp FROM ({second})")
    rules2 = resubmitted_queries(params, ORACLE_EXECUTION_ID_2)["dq_resubmitted_rule_results"]
    pivot = ", ".join(f"max(CASE WHEN dimension_name = {q(d)} THEN score END) AS {d}"
                      for d in ["Completeness", "Uniqueness", "Validity", "Conformity", "Consistency", "Timeliness"])
    out = {
        "dq_history_failing_rules": (f"SELECT rule_id, dimension_name, rule_name, failing_rows, failure_rate "
                                     f"FROM ({rules2}) WHERE execution_id = '{ORACLE_EXECUTION_ID_2}' AND failure_rate > 10.0"),
        "dq_history_report": f"SELECT execution_id, execution_timestamp, {pivot} FROM ({both}) GROUP BY ALL",
        "dq_history_alerts": (f"SELECT dimension_name, execution_id, score FROM (SELECT *, row_number() OVER "
                              f"(PARTITION BY dimension_name ORDER BY execution_timestamp DESC, execution_id DESC) AS rn "
                              f"FROM ({both})) WHERE rn = 1 AND score < 60.0"),
    }
    out["dq_history_trend"] = f"""
SELECT dimension_name, execution_id, execution_timestamp, score,
       lag(score) OVER ({w}) AS previous_score,
       score - lag(score) OVER ({w}) AS score_change
FROM (
  SELECT *, TIMESTAMP '{ORACLE_EXECUTION_TS}' AS execution_timestamp FROM ({first})
  UNION ALL
  SELECT *, TIMESTAMP '{ORACLE_EXECUTION_TS_2}' AS execution_timestamp FROM ({second})
)"""
    return out
