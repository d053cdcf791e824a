"""Property test: on random grant data (duplicates, NULL ids, hot groups),
the collapsed weighted counts, the join-free counts and a row-level
brute-force evaluation (windows over the hot keys) all agree."""

from functools import reduce

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from qualstar.operators import dq
from qualstar.operators.rules import default_rules
from qualstar.params import DQParams
from tests.test_rules import SCHEMA

P = DQParams(as_of="2024-06-01 00:00:00")

ROW = st.tuples(
    st.sampled_from(["A", "B", "C", None, "D"]),
    st.sampled_from(["S1234567A", "INVALID_NRIC", None]),
    st.sampled_from(["Education Bursary", "x", None]),
    st.sampled_from([1000.0, -1.0, None]),
    st.sampled_from([3, 25, None]),
    st.sampled_from(["2024-01-01", "01/02/2024", "NOT_A_DATE", None, "2018-05-05T10:00:00"]),
    st.sampled_from(["Approved", "Rejected", "Pending", "approved", None]),
    st.sampled_from([500.0, None]),
    st.sampled_from([400.0, 600.0, None]),
    st.sampled_from([None, "2024-01-20", "INVALID_DATE", "2023-12-01"]),
)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=st.lists(ROW, min_size=1, max_size=40), hot=st.integers(min_value=0, max_value=20))
def test_weighted_direct_and_brute_force_agree(spark, rows, hot):
    rows = rows + [rows[0]] * hot  # a hot group of identical copies
    df = spark.createDataFrame(rows, SCHEMA)
    rules = default_rules(P)
    weighted = dq.score_aggregates(dq.evaluate_weighted(df, rules, P), rules).first().asDict()
    direct = dq.score_aggregates_direct(df, rules, P).first().asDict()
    assert weighted == direct

    table = dq.evaluate_all(df, rules, P)
    brute = table.withColumns({
        "rule_U001_pass": F.count(F.lit(1)).over(Window.partitionBy("application_id")) == 1,
        "rule_U002_pass": F.row_number().over(Window.partitionBy(*df.columns).orderBy("application_id")) == 1,
    })
    dims = {}
    for r in rules:
        dims.setdefault(r.dimension, []).append(F.coalesce(F.col(r.column), F.lit(False)))
    b = brute.agg(F.count(F.lit(1)).alias("total_rows"),
                  *[F.count_if(F.col(r.column) == True).alias(f"pass_{r.rule_id}") for r in rules],  # noqa: E712
                  *[F.count_if(reduce(lambda x, y: x & y, cs)).alias(f"dim_{d}") for d, cs in dims.items()]
                  ).first().asDict()
    assert {k: int(v) for k, v in weighted.items()} == {k: int(v) for k, v in b.items()}
