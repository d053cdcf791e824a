"""Rule evaluation and one-pass scoring.

Identical input rows get identical results for every rule except U002, so
the evaluator first collapses identical rows into one row with a copy count
(``_copies``).  That aggregation combines map-side, so a value copied into a
third of the input shrinks before the shuffle instead of landing in one task.
Per-id row counts for U001 come from a second pre-aggregated ``groupBy``.
The row-level table (``evaluate_all``) joins them to the rows (AQE splits a hot
id on the big side of that join) and collapses only rows of ids that may have
equal ones; the aggregate-only path (``score_aggregates_direct``) counts the
ids seen once without any join, and shuffles a hash and the outcomes of a row
in place of the row.

Every result is then a weighted count over the collapsed rows: a row rule
passes for all ``_copies`` copies or for none, U002 passes for exactly one
copy, and a dimension passes for ``least(...)`` of its rules' passing copies.
All 25 rule counts and 6 dimension counts come out of a single aggregation.
"""

from __future__ import annotations

import logging
from datetime import datetime, timezone
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import AtomicType, StringType

from ..functions.dates import as_timestamp
from ..params import DQ_DIMENSIONS, DQParams
from ..session import pin, unpin
from .rules import Rule, default_rules

log = logging.getLogger(__name__)

COPIES = "_copies"
RULES_PER_NUMBER = 24        # outcomes that are judged in one generated method
RULES_PER_STEP = 8           # outcomes that are added to rows in one generated method
FEW_COPIES = 8               # so many copies of a row are made where the row is
MAX_PARTITIONS = 2**31 - 1   # no table has as many, so none are merged
CONTEXT = ["_app_ts", "_dec_ts", "_id_rows", "_as_of"]


def _as_of_literal(params: DQParams) -> Column:
    if params.as_of is None:
        now = datetime.now(timezone.utc).replace(tzinfo=None)
        return F.lit(now.isoformat(sep=" ")).cast("timestamp_ntz")
    return F.lit(params.as_of).cast("timestamp_ntz")


def collapse_copies(df: DataFrame) -> DataFrame:
    """One row per distinct input row with its number of copies."""
    return df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias(COPIES))


def _with_id_rows(collapsed: DataFrame, id_col: str) -> DataFrame:
    if id_col not in collapsed.columns:
        return collapsed.withColumn("_id_rows", F.lit(None).cast("long"))
    per_id = collapsed.groupBy(F.col(id_col).alias("_qs_id")).agg(F.sum(COPIES).alias("_id_rows"))
    joined = collapsed.join(per_id, collapsed[id_col].eqNullSafe(per_id["_qs_id"]), "left")
    return joined.drop("_qs_id")


def _with_dates(df: DataFrame, params: DQParams) -> DataFrame:
    cols = {"_as_of": _as_of_literal(params)}
    for src, dst in (("application_date", "_app_ts"), ("decision_date", "_dec_ts")):
        cols[dst] = as_timestamp(df, src) if src in df.columns else F.lit(None).cast("timestamp_ntz")
    return df.withColumns(cols)


def safe_rule_column(df: DataFrame, rule: Rule, params: DQParams) -> Column:
    """The rule's column, or all-FALSE when it cannot be built against ``df``
    (e.g. a referenced column is missing).  Checked by analysing the rule
    alone, without running a job."""
    try:
        expr = rule.evaluate(df, params)
        df.select(expr.alias("_probe")).schema
        return expr
    except (AnalysisException, KeyError, ValueError) as e:  # noqa: PERF203
        log.error("rule %s cannot be evaluated: %s", rule.rule_id, e)
        return F.lit(False)


def evaluate_weighted(df: DataFrame, rules: list[Rule] | None = None, params: DQParams = DQParams(),
                      id_col: str = "application_id") -> DataFrame:
    """Collapsed input + ``_copies`` + one ``rule_<id>_pass`` column per rule.

    Row rules keep SQL three-valued results (NULL = not passed); the U002
    column is TRUE and stands for the one passing copy — see ``pass_copies``.
    """
    rules = rules if rules is not None else default_rules(params)
    base_cols = list(df.columns)
    work = collapse_copies(df)
    if any(r.rule_id == "U001" for r in rules):
        work = _with_id_rows(work, id_col)
    else:
        work = work.withColumn("_id_rows", F.lit(None).cast("long"))
    work = _with_dates(work, params)
    rule_cols = _rule_columns(work, rules, params)
    return work.withColumns(rule_cols).select(*base_cols, COPIES, *CONTEXT, *rule_cols.keys())


def _rule_columns(work: DataFrame, rules: list[Rule], params: DQParams) -> dict[str, Column]:
    """All rule columns, analysed together once; only when that fails is each
    rule analysed alone, so one broken rule becomes all-FALSE."""
    try:
        cols = {r.column: r.evaluate(work, params) for r in rules}
        work.select(*[c.alias(n) for n, c in cols.items()]).schema
        return cols
    except (AnalysisException, KeyError, ValueError):
        return {r.column: safe_rule_column(work, r, params) for r in rules}


def pass_copies(rule: Rule, passed: Column | None, copies: str = COPIES) -> Column:
    """Number of the row's copies that pass ``rule`` (``passed``: its outcome; None: no such column)."""
    if passed is None:
        return F.lit(0).cast("long")
    if rule.kind == "first_copy":
        # A row need not have come in every run that shares the table.
        return F.lit(1).cast("long") if copies == COPIES else F.least(F.col(copies), F.lit(1).cast("long"))
    return F.when(passed, F.col(copies)).otherwise(F.lit(0).cast("long"))


def score_aggregates(weighted: DataFrame, rules: list[Rule], outcomes: dict[str, Column] | None = None) -> DataFrame:
    """ONE aggregation: total rows, passing rows per rule and per dimension.

    ``outcomes`` are the rules' expressions where ``weighted`` has no columns
    of them.  Spark puts every sum's input into a method of its own, but the
    columns of a projection all into one, which for 25 rules is larger than the
    JVM compiles; so rules that are only summed are better not projected."""
    if outcomes is None:
        outcomes = {r.column: F.col(r.column) for r in rules if r.column in weighted.columns}
    return weighted.agg(*_score_sums(rules, outcomes, COPIES))


def _score_sums(rules: list[Rule], outcomes: dict[str, Column], copies: str, suffix: str = "") -> list[Column]:
    passing = {r.rule_id: pass_copies(r, outcomes.get(r.column), copies) for r in rules}
    aggs = [F.coalesce(F.sum(copies), F.lit(0)).cast("long").alias(f"total_rows{suffix}")]
    for r in rules:
        aggs.append(F.coalesce(F.sum(passing[r.rule_id]), F.lit(0)).alias(f"pass_{r.rule_id}{suffix}"))
    for dim in DQ_DIMENSIONS:
        members = [passing[r.rule_id] for r in rules if r.dimension == dim]
        if not members:
            continue
        per_row = F.least(*members) if len(members) > 1 else members[0]
        aggs.append(F.coalesce(F.sum(per_row), F.lit(0)).alias(f"dim_{dim}{suffix}"))
    return aggs


def _direct_applies(rules: list[Rule]) -> bool:
    """U001 depends on the whole id group; the join-free path handles it when
    its dimension holds no row rule besides U001/U002 (the default catalogue)."""
    u001 = [r for r in rules if r.rule_id == "U001"]
    if not u001:
        return True
    dim = u001[0].dimension
    return all(r.rule_id in ("U001", "U002") for r in rules if r.dimension == dim)


def direct_applies(df: DataFrame, rules: list[Rule], id_col: str = "application_id") -> bool:
    """Whether ``rules`` can be scored over ``df`` without a join."""
    return _direct_applies(rules) and id_col in df.columns


def score_aggregates_direct(df: DataFrame, rules: list[Rule] | None = None, params: DQParams = DQParams(),
                            id_col: str = "application_id") -> DataFrame:
    """The same one-row result as ``score_aggregates(evaluate_weighted(df))``
    without joining per-id counts back to the rows.

    A row passes U001 when its id occurs once; such an id has one row, which
    is also its first copy.  So U001 (and a dimension of U001 with U002)
    passes for exactly the ids counted once — a count over the per-id table.
    Rows are judged where they are read and told apart by id and hash; see
    :func:`_direct` for what makes that exact.
    """
    rules = rules if rules is not None else default_rules(params)
    if not direct_applies(df, rules, id_col):
        return score_aggregates(evaluate_weighted(df, rules, params, id_col), rules)
    return _direct(df, {"": None}, rules, params, id_col)


def score_aggregates_runs(df: DataFrame, times: list[Column], rules: list[Rule], params: DQParams = DQParams(),
                          id_col: str = "application_id") -> DataFrame:
    """The results of several runs that see rows of one table, in one pass.

    ``times`` says for each run how often it sees a row (0: not at all).  Reading,
    collapse and rules are the same for a row whichever run sees it, so they are
    done once and each run's sums weigh the row by that run's copies.  One row;
    :func:`run_aggregates` gives each run's."""
    if not direct_applies(df, rules, id_col):
        raise ValueError("U001 shares its dimension with row rules, or there is no id column: score every run by itself")
    return _direct(df, {f"_run{k}": F.coalesce(t.cast("long"), F.lit(0)) for k, t in enumerate(times)}, rules, params, id_col)


def run_aggregates(aggregates: DataFrame, run: int) -> DataFrame:
    """One run of :func:`score_aggregates_runs`, as ``score_aggregates`` names its columns."""
    suffix = f"_run{run}"
    return aggregates.select(*[F.col(c).alias(c.removesuffix(suffix)) for c in aggregates.columns if c.endswith(suffix)])


def _direct(df: DataFrame, times: dict[str, Column | None], rules: list[Rule], params: DQParams, id_col: str) -> DataFrame:
    """One-row result of each run; ``times`` has each run's suffix and how often it sees a row (None: once).

    The rows are counted by id and hash.  Where no id has a hash twice, no two
    rows are equal and the counts are exact as they are.  Otherwise the different
    rows are counted in full, too: are there as many of them as ids and hashes,
    then every hash stood for equal rows.  Else the full rows are scored."""
    if not _hashes_tell(df):
        return _direct_full(df, times, rules, params, id_col)
    found = pin(_direct_hashed(df, times, rules, params, id_col), "dq-hashed")
    seen = found.select("_hashes", "_repeated").first()
    if seen["_repeated"] and collapse_copies(df).count() != seen["_hashes"]:
        unpin(found)
        return _direct_full(df, times, rules, params, id_col)
    return found.drop("_hashes", "_repeated")


def _hashes_tell(df: DataFrame) -> bool:
    """Whether equal rows always have equal hashes (text under a collation may be equal and differ in bytes)."""
    return all(isinstance(f.dataType, AtomicType) and (not isinstance(f.dataType, StringType) or f.dataType == StringType()) for f in df.schema)


def _row_hash(columns: list[str]) -> Column:
    """64-bit hash of a row.  Spark's hash passes over NULLs, so it takes which columns are NULL as well."""
    return F.xxhash64(*columns, *[F.col(c).isNull() for c in columns])


def _direct_names(rules: list[Rule], times: dict[str, Column | None]) -> list[str]:
    names = ["total_rows"] + [f"pass_{r.rule_id}" for r in rules] + \
        [f"dim_{d}" for d in DQ_DIMENSIONS if any(r.dimension == d for r in rules)]
    return [f"{n}{s}" for s in times for n in names]


def _direct_hashed(df: DataFrame, times: dict[str, Column | None], rules: list[Rule], params: DQParams, id_col: str) -> DataFrame:
    """The result if rows with equal id, hash and outcomes are equal, with the
    number of those keys and how many of them came more than once.

    Outcomes go as bits of a few numbers.  Both counts read the one narrow exchange."""
    copies = {s: f"{COPIES}{s}" if t is not None else "_rows" for s, t in times.items()}
    context = {"_id_rows": F.lit(None).cast("long"), "_hash": _row_hash(df.columns)}
    context.update({copies[s]: t for s, t in times.items() if t is not None})
    work = _apart(_with_dates(_apart(df).withColumns(context), params))
    row_rules = [r for r in rules if r.rule_id != "U001"]
    outcomes = _rule_columns(work, row_rules, params)
    flagged = [r for r in row_rules if r.kind != "first_copy"]
    groups = {f"_passed{i}": flagged[i:i + RULES_PER_NUMBER] for i in range(0, len(flagged), RULES_PER_NUMBER)}
    for number, members in groups.items():
        bits = [F.when(outcomes[r.column], F.lit(1 << k)).otherwise(F.lit(0)) for k, r in enumerate(members)]
        work = _apart(work.withColumn(number, reduce(Column.__add__, bits)))
    hashed = work.groupBy(id_col, "_hash", *groups).agg(
        *[F.sum(copies[s]).alias(copies[s]) for s, t in times.items() if t is not None], F.count(F.lit(1)).alias("_rows"))

    passed = {r.column: F.col(n).bitwiseAND(1 << k) != 0 for n, members in groups.items() for k, r in enumerate(members)}
    passed.update({r.column: F.lit(True) for r in row_rules if r.kind == "first_copy"})
    # One copy of equal rows passes U002; a run need not have seen any.
    row_part = hashed.agg(*[a for s, c in copies.items() for a in _score_sums(row_rules, passed, c, s)],
                          F.count(F.lit(1)).alias("_hashes"), F.count_if(F.col("_rows") > 1).alias("_repeated"))
    # True of every row; it names the count, without which (or with the count in
    # another place) Spark would not share the exchange but judge the rows again.
    return _with_ids(row_part, hashed.filter(F.col("_rows") > 0), copies, rules, times, id_col, ["_hashes", "_repeated"])


def _apart(df: DataFrame) -> DataFrame:
    """The same rows in the same partitions, by a step that Spark does not compile
    into one method with those before and after: reading, dates and rules
    together are larger than the JVM compiles or compiles well."""
    return df.coalesce(MAX_PARTITIONS)


def _direct_full(df: DataFrame, times: dict[str, Column | None], rules: list[Rule], params: DQParams, id_col: str) -> DataFrame:
    """The result by collapsing the full rows: one full shuffle, combined
    map-side, which the rule counts and the id counts both read."""
    copies = {s: f"{COPIES}{s}" for s in times}
    collapsed = df.groupBy(*df.columns).agg(*[F.sum(F.lit(1).cast("long") if t is None else t).alias(copies[s]) for s, t in times.items()])
    collapsed = collapsed.withColumn("_id_rows", F.lit(None).cast("long"))
    work = _with_dates(collapsed, params)
    row_rules = [r for r in rules if r.rule_id != "U001"]
    outcomes = _rule_columns(work, row_rules, params)
    row_part = work.agg(*[a for s, c in copies.items() for a in _score_sums(row_rules, outcomes, c, s)])
    return _with_ids(row_part, collapsed, copies, rules, times, id_col)


def _with_ids(row_part: DataFrame, counted: DataFrame, copies: dict[str, str], rules: list[Rule],
              times: dict[str, Column | None], id_col: str, more: list[str] = ()) -> DataFrame:
    """``row_part`` and the ids that ``counted`` has once, in one row."""
    names = [*_direct_names(rules, times), *more]
    u_dim = next((r.dimension for r in rules if r.rule_id == "U001"), None)
    row_cols = {n: (F.col(n) if n in row_part.columns else F.lit(0).cast("long")) for n in names}
    if u_dim is not None:
        row_cols.update({f"dim_{u_dim}{s}": F.lit(0).cast("long") for s in copies})
    row_part = row_part.select(*[row_cols[n].cast("long").alias(n) for n in names])

    per_id = counted.groupBy(id_col).agg(*[F.sum(c).alias(f"_n{s}") for s, c in copies.items()])
    id_cols = {n: F.lit(0).cast("long") for n in names}
    if u_dim is not None:
        for s in copies:
            singles = F.count_if(F.col(f"_n{s}") == 1).cast("long")
            id_cols[f"pass_U001{s}"] = singles
            id_cols[f"dim_{u_dim}{s}"] = singles
    id_part = per_id.agg(*[id_cols[n].alias(n) for n in names])
    both = row_part.unionByName(id_part)
    return both.agg(*[F.sum(n).cast("long").alias(n) for n in names])


def _sql_str(s: str) -> str:
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _rate(numer: Column, total: Column) -> Column:
    return F.when(total > 0, F.round(numer / total * F.lit(100.0), 2)).otherwise(F.lit(0.0))


def rule_results(aggregates: DataFrame, rules: list[Rule], execution_id: str) -> DataFrame:
    """dq_rule_results: one row per rule, in rule order."""
    parts = ", ".join(f"{i}, {_sql_str(r.rule_id)}, {_sql_str(r.dimension)}, {_sql_str(r.rule_name)}, pass_{r.rule_id}"
                      for i, r in enumerate(rules))
    long = aggregates.selectExpr(
        "total_rows", f"stack({len(rules)}, {parts}) AS (rule_order, rule_id, dimension_name, rule_name, passing_rows)")
    failing = F.col("total_rows") - F.col("passing_rows")
    return long.select(
        F.lit(execution_id).alias("execution_id"), "rule_id", "dimension_name", "rule_name",
        F.col("total_rows").cast("long").alias("total_rows"),
        F.col("passing_rows").cast("long").alias("passing_rows"),
        failing.cast("long").alias("failing_rows"),
        _rate(failing, F.col("total_rows")).alias("failure_rate"),
        F.col("rule_order"),
    ).orderBy("rule_order").drop("rule_order")


def dimension_scores(aggregates: DataFrame, rules: list[Rule], execution_id: str) -> DataFrame:
    """dq_dimension_scores: one row per dimension that has rules, fixed order."""
    dims = [(d, sum(1 for r in rules if r.dimension == d)) for d in DQ_DIMENSIONS]
    skipped = [d for d, n in dims if n == 0]
    if skipped:
        log.warning("no rules for dimensions %s; skipped", skipped)
    dims = [(d, n) for d, n in dims if n > 0]
    parts = ", ".join(f"{i}, {_sql_str(d)}, {n}, `dim_{d}`" for i, (d, n) in enumerate(dims))
    long = aggregates.selectExpr(
        "total_rows", f"stack({len(dims)}, {parts}) AS (dim_order, dimension_name, rule_count, passing_rows)")
    failing = F.col("total_rows") - F.col("passing_rows")
    return long.select(
        F.lit(execution_id).alias("execution_id"), "dimension_name",
        _rate(F.col("passing_rows"), F.col("total_rows")).alias("score"),
        F.col("total_rows").cast("long").alias("total_rows"),
        F.col("passing_rows").cast("long").alias("passing_rows"),
        failing.cast("long").alias("failing_rows"),
        F.col("rule_count").cast("int").alias("rule_count"),
        F.col("dim_order"),
    ).orderBy("dim_order").drop("dim_order")


def rule_counts(df: DataFrame, rule: Rule, params: DQParams = DQParams(), id_col: str = "application_id") -> DataFrame:
    """(id, passed, n_rows): input rows per id and outcome of one rule.

    A row rule is one projection and one pre-aggregated count; U001 needs the
    rows per id only, and U002 the copies of each row.  No plan has a join."""
    one = F.lit(1).cast("long")
    if rule.kind == "first_copy":
        copies = collapse_copies(df).select(id_col, F.inline(F.array(
            F.struct(F.lit(True).alias("passed"), one.alias("n_rows")),
            F.struct(F.lit(False).alias("passed"), (F.col(COPIES) - 1).alias("n_rows")))))
        return copies.filter("n_rows > 0").groupBy(id_col, "passed").agg(F.sum("n_rows").alias("n_rows"))
    if rule.rule_id == "U001":
        work = df.groupBy(id_col).agg(F.count(F.lit(1)).alias("_id_rows"))
        return work.select(id_col, F.coalesce(safe_rule_column(work, rule, params), F.lit(False)).alias("passed"),
                           F.col("_id_rows").alias("n_rows"))
    work = _with_dates(df, params)
    passed = F.coalesce(safe_rule_column(work, rule, params), F.lit(False))
    return work.select(id_col, passed.alias("passed")).groupBy(id_col, "passed").agg(F.count(F.lit(1)).alias("n_rows"))


def expand_copies(weighted: DataFrame, rules: list[Rule] | None = None, chunk: int = 4096) -> DataFrame:
    """Row-level rule table: input columns + one rule column per rule, one
    output row per input row (the collapsed rows fanned out again).  The first
    copy of each group of identical rows passes U002, the others fail it.

    Groups of a few copies are fanned out where they are.  Larger ones are cut
    into chunks of at most ``chunk`` copies, and these (a row each) are spread
    over the cluster before they are fanned out, so no single task generates a
    hot group."""
    rules = rules if rules is not None else []
    keep = [c for c in weighted.columns if c not in CONTEXT]
    n = F.col(COPIES)
    zero = F.lit(0).cast("long")

    few = weighted.filter(n <= FEW_COPIES).select(*keep, zero.alias("_qs_chunk"), F.explode(F.sequence(zero, n - 1)).alias("_qs_i"))
    chunks = weighted.filter(n > FEW_COPIES).select(*keep, F.explode(F.sequence(zero, F.floor((n - 1) / chunk).cast("long"))).alias("_qs_chunk"))
    # With a number, as AQE would put chunks together again by their few bytes.
    spread = int(weighted.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    chunks = chunks.repartition(spread, F.xxhash64(*[F.col(c) for c in keep], F.col("_qs_chunk")))
    start = F.col("_qs_chunk") * chunk
    size = F.least(F.lit(chunk).cast("long"), n - start)
    many = chunks.select(*keep, "_qs_chunk", F.explode(F.sequence(zero, size - 1)).alias("_qs_i"))
    rows = few.unionByName(many)
    first = (F.col("_qs_chunk") == 0) & (F.col("_qs_i") == 0)
    for r in rules:
        if r.kind == "first_copy" and r.column in rows.columns:
            rows = rows.withColumn(r.column, first)
    return rows.drop(COPIES, "_qs_chunk", "_qs_i")


def evaluate_all(df: DataFrame, rules: list[Rule] | None = None, params: DQParams = DQParams(),
                 id_col: str = "application_id") -> DataFrame:
    """Input rows with one ``rule_<id>_pass`` column per rule (row level).

    A row meets the count of its id in one shuffle, and is judged there unless it
    may have copies.  Only rows of ids that may have equal rows are collapsed and
    fanned out again.  So are all rows where hashes do not tell rows apart."""
    rules = rules if rules is not None else default_rules(params)
    copied = any(r.kind == "first_copy" for r in rules)
    if not copied and not any(r.rule_id == "U001" for r in rules):
        return _judged(df.withColumn("_id_rows", F.lit(None).cast("long")), df.columns, rules, params)
    if id_col not in df.columns or not _hashes_tell(df):
        return expand_copies(evaluate_weighted(df, rules, params, id_col), rules)
    repeated = _repeated_ids(df, id_col)
    # The hash keeps the join from passing as a distribution by the id: then AQE
    # would not split a hot id's partition for fear of a shuffle behind it.
    same = (F.xxhash64(df[id_col]) == F.xxhash64(repeated["_qs_id"])) & df[id_col].eqNullSafe(repeated["_qs_id"])
    rows = df.join(repeated, same, "left").withColumn("_id_rows", F.coalesce("_id_rows", F.lit(1).cast("long")))
    if not copied:
        return _judged(rows, df.columns, rules, params)
    single = _judged(rows.filter(~F.coalesce("_may_equal", F.lit(False))), df.columns, rules, params)
    collapsed = collapse_copies(rows.filter("_may_equal").select(*df.columns, "_id_rows"))
    return single.unionByName(expand_copies(_judged(collapsed, [*df.columns, COPIES], rules, params), rules))


def _repeated_ids(df: DataFrame, id_col: str) -> DataFrame:
    """(_qs_id, _id_rows, _may_equal) of every id that comes more than once.

    A row sets one of 64 bits by its hash.  Are there as many bits as rows, then
    all hashes differ, so no two rows are equal; else some may be."""
    hashed = _apart(df).select(F.col(id_col).alias("_qs_id"), _row_hash(df.columns).alias("_hash"))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("_hash").bitwiseAND(63).cast("int"))
    per_id = hashed.groupBy("_qs_id").agg(F.count(F.lit(1)).alias("_id_rows"), F.bit_or(bit).alias("_bits"))
    return per_id.filter("_id_rows > 1").select("_qs_id", "_id_rows", (F.bit_count("_bits") < F.col("_id_rows")).alias("_may_equal"))


def _judged(rows: DataFrame, keep: list[str], rules: list[Rule], params: DQParams) -> DataFrame:
    """Columns ``keep`` of different ``rows`` with their outcomes: a few rules at a
    time, as one method of all rules is larger than the JVM compiles."""
    work = _apart(_with_dates(_apart(rows), params))
    outcomes = _rule_columns(work, rules, params)
    outcomes.update({r.column: F.lit(True) for r in rules if r.kind == "first_copy"})
    names = list(outcomes)
    for i in range(0, len(names), RULES_PER_STEP):
        work = _apart(work.withColumns({n: outcomes[n] for n in names[i:i + RULES_PER_STEP]}))
    return work.select(*keep, *names)


def rule_pass_rates(aggregates: DataFrame, rules: list[Rule]) -> dict[str, dict]:
    """Per-rule summary as a dict keyed by rule id (unrounded pass rate in
    percent).  Reads the one-row aggregate only: 25 numbers, not data."""
    row = aggregates.first()
    total = int(row["total_rows"]) if row else 0
    out = {}
    for r in rules:
        passing = int(row[f"pass_{r.rule_id}"]) if row else 0
        out[r.rule_id] = {"rule_id": r.rule_id, "rule_name": r.rule_name, "dimension": r.dimension,
                          "total_rows": total, "passing_rows": passing, "failing_rows": total - passing,
                          "pass_rate": (passing / total * 100) if total > 0 else 0.0}
    return out
