"""The 25 row-level data-quality rules for grant applications.

A rule is a named boolean Column (TRUE = pass; NULL counts as a failure when
results are aggregated).  Rules read the input columns plus three context
columns that the evaluator provides once per row:

* ``_app_ts`` / ``_dec_ts`` — application / decision date parsed with the
  flexible reader (computed once, shared by CS001, T001, T002);
* ``_id_rows`` — number of input rows with the same ``application_id``.

``U002`` (no exact duplicate rows) is a property of a group of identical
rows, not of one row; the evaluator handles it from the copy count.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import can_canonicalise, date_typed, days_between_within, is_strict_iso_date
from ..params import (GRANT_SCHEMES, GRANT_STATUSES, NRIC_PATTERN, PLACEHOLDER_SUBSTRINGS, RULE_CATALOGUE,
                      DQParams)


@dataclass(frozen=True)
class Rule:
    rule_id: str
    rule_name: str
    dimension: str
    build: Callable[[DataFrame, DQParams], Column] = field(repr=False, compare=False)
    # "row": pass/fail per row; "first_copy": exactly one of identical rows passes.
    kind: str = "row"

    @property
    def column(self) -> str:
        return f"rule_{self.rule_id}_pass"

    def evaluate(self, df: DataFrame, params: DQParams = DQParams()) -> Column:
        return self.build(df, params)


def _nonblank(name):
    c = F.col(name)
    return c.isNotNull() & (F.trim(c.cast("string")) != "")


def _decided():
    return F.col("application_status").isin("Approved", "Rejected")


def _c005(df, p):
    return F.when(F.col("application_status") == "Approved", F.col("approved_amount").isNotNull()).otherwise(True)


def _decision_present_when_decided(df, p):
    return F.when(_decided(), F.col("decision_date").isNotNull()).otherwise(True)


def _v005(df, p):
    s = F.col("household_size")
    return (s >= 1) & (s <= 20) & (s == s.try_cast("int"))


def _v007(df, p):
    # A NULL application date makes the whole test NULL (= fail); NULL
    # decision date or NRIC pass.  One text of all three is searched; no
    # placeholder holds the character between them.
    text = F.upper(F.concat_ws("\n", "application_date", "decision_date", "citizen_nric"))
    # ``greatest`` looks for all of them, so Spark makes the text once; OR, which
    # stops at the first, made it anew for each.
    found = F.greatest(*[text.contains(x) for x in PLACEHOLDER_SUBSTRINGS])
    return F.when(found, F.lit(False)).when(F.col("application_date").isNotNull(), F.lit(True))


def _cf001(df, p):
    if date_typed(df, "decision_date"):
        return F.lit(True)
    d = F.col("decision_date")
    # The parsed dates are shared with CS001/T001/T002 when the evaluator provides them.
    return F.when(d.isNotNull(), is_strict_iso_date(d, F.col("_dec_ts") if "_dec_ts" in df.columns else None)).otherwise(True)


def _cf002(df, p):
    a = F.col("application_date")
    if date_typed(df, "application_date"):
        return a.isNotNull()
    # A strict ISO date always parses, so the test is whether the value does.
    return F.col("_app_ts").isNotNull() if "_app_ts" in df.columns else can_canonicalise(a)


def _cs001(df, p):
    both = F.col("decision_date").isNotNull() & F.col("application_date").isNotNull()
    return F.when(both, F.coalesce(F.col("_dec_ts") >= F.col("_app_ts"), F.lit(False))).otherwise(True)


def _t001(df, p):
    applies = _decided() & F.col("decision_date").isNotNull() & F.col("application_date").isNotNull()
    lag_ok = days_between_within(F.col("_dec_ts"), F.col("_app_ts"), 0, p.sla_days)
    return F.when(applies, F.coalesce(lag_ok, F.lit(False))).otherwise(True)


def _t002(df, p):
    max_days = p.max_age_years * 365
    fresh = F.col("_app_ts") > F.col("_as_of") - F.make_dt_interval(F.lit(max_days + 1))
    return F.when(F.col("application_date").isNotNull(), F.coalesce(fresh, F.lit(False))).otherwise(True)


_BUILDERS = {
    "C001": lambda df, p: _nonblank("application_id"),
    "C002": lambda df, p: _nonblank("application_date"),
    "C003": lambda df, p: _nonblank("application_status"),
    "C004": lambda df, p: F.col("requested_amount").isNotNull(),
    "C005": _c005,
    "C006": _decision_present_when_decided,
    "U001": lambda df, p: F.col("_id_rows") == 1,
    "U002": lambda df, p: F.lit(True),
    "V001": lambda df, p: F.col("citizen_nric").isNotNull() & F.col("citizen_nric").rlike(NRIC_PATTERN),
    "V002": lambda df, p: (F.col("household_income") >= 0) & (F.abs(F.col("household_income")) < 10_000_000),
    "V003": lambda df, p: F.col("requested_amount") >= 0,
    "V004": lambda df, p: F.when(F.col("approved_amount").isNotNull(), F.col("approved_amount") >= 0).otherwise(True),
    "V005": _v005,
    "V006": lambda df, p: F.when(F.col("application_status") != "Approved",
                                 F.col("approved_amount").isNull()).otherwise(True),
    "V007": _v007,
    "CF001": _cf001,
    "CF002": _cf002,
    "CF003": lambda df, p: F.col("application_status").isin(*GRANT_STATUSES),
    "CF004": lambda df, p: F.upper(F.col("grant_scheme_name")).isin(*GRANT_SCHEMES),
    "CS001": _cs001,
    "CS002": lambda df, p: F.when(F.col("application_status") == "Approved",
                                  (F.col("approved_amount") <= F.col("requested_amount"))
                                  & (F.col("approved_amount") > 0)).otherwise(True),
    "CS003": lambda df, p: F.when(F.col("application_status") == "Pending",
                                  F.col("decision_date").isNull()).otherwise(True),
    "CS004": _decision_present_when_decided,
    "T001": _t001,
    "T002": _t002,
}


def default_rules(params: DQParams = DQParams()) -> list[Rule]:
    """All 25 rules in catalogue order (completeness, uniqueness, validity,
    conformity, consistency, timeliness)."""
    out = []
    for rule_id, name, dimension in RULE_CATALOGUE:
        name = name.format(sla=params.sla_days, years=params.max_age_years)
        kind = "first_copy" if rule_id == "U002" else "row"
        out.append(Rule(rule_id, name, dimension, _BUILDERS[rule_id], kind))
    return out


def rules_by_id(params: DQParams = DQParams()) -> dict[str, Rule]:
    return {r.rule_id: r for r in default_rules(params)}
