import json

import pytest
import os
import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from qualstar.operators.keys import assign_dense_keys
from qualstar.operators.star import (broadcast_if_small, build_dim_location, build_dim_occupation,
                                     build_dim_taxpayer, build_dim_time, build_star_schema)
from qualstar.params import POSTAL_DISTRICTS, TaxParams
from qualstar.plans.tax import silver_transform
from qualstar.sources.files import read_postal_lookup, schema_of
from qualstar.params import TAX_COLUMNS


@pytest.mark.parametrize("parts", [None, 5])
def test_dense_keys_match_global_row_number(spark, parts):
    random.seed(7)
    rows = {(random.choice(["a", "b", None, "c"]), random.randint(0, 500), random.choice([None, 1.5, 2.5]))
            for _ in range(3000)}
    df = spark.createDataFrame(sorted(rows, key=str), "k1 string, k2 int, k3 double").repartition(7)
    got = assign_dense_keys(df, ["k1", "k2", "k3"], "key", num_partitions=parts)
    w = Window.orderBy(F.asc_nulls_first("k1"), F.asc_nulls_first("k2"), F.asc_nulls_first("k3"))
    want = df.withColumn("want", F.row_number().over(w) - 1)
    joined = got.join(want, [got.k1.eqNullSafe(want.k1), got.k2.eqNullSafe(want.k2), got.k3.eqNullSafe(want.k3)])
    assert joined.count() == len(rows)
    assert joined.filter(F.col("key") != F.col("want")).count() == 0
    assert sorted(r[0] for r in got.select("key").collect()) == list(range(len(rows)))


def _returns(spark):
    rows = [
        ("TP1", "S1234567A", "Tan", "Single", 2023, "2024-03-15", 85000.0, 72050.0, 8205.0, 8500.0, 12950.0, 0,
         "Sales Manager", "Resident", "119077", "HDB 4-room", 17000.0, 0.0),
        ("TP2", "", "Lim", "Married", 2023, "15/04/2024", 60000.0, 50000.0, 4000.0, 3000.0, 10000.0, 2,
         "Software Engineer", "Resident", "11-9077", "Private Condo", 12000.0, 0.0),
        ("TP3", "T7654321B", "Ng", "Single", 2023, "2024-13-45", 50000.0, 40000.0, 0.0, 0.0, 10000.0, 1,
         "nurse", "Non-Resident", "520123", "HDB 3-room", 0.0, 0.0),
        ("TP4", "F1111111C", "Ong", "Married", 2023, "2024-05-02", 90000.0, 80000.0, 9000.0, 9000.0, 10000.0, 3,
         None, "Resident", "999999", "Landed Property", 17000.0, 0.0),
    ]
    return spark.createDataFrame(rows, schema_of(TAX_COLUMNS))


def test_dimensions(spark):
    silver = silver_transform(_returns(spark))
    occ = {r.occupation_raw: r for r in build_dim_occupation(silver).collect()}
    assert occ["Sales Manager"].occupation_category == "Management"  # Management is listed before Sales
    assert occ["Software Engineer"].occupation_category == "Engineering"
    assert occ["nurse"].occupation_category == "Healthcare" and occ["nurse"].occupation == "NURSE"
    assert occ[None].occupation_category == "Other"
    assert sorted(r.occupation_key for r in occ.values()) == [0, 1, 2, 3]

    tm = build_dim_time(silver).orderBy("time_key").collect()
    assert [(str(r.filing_date), r.tax_season_flag, r.filing_quarter) for r in tm] == [
        ("2024-03-15", "Early", 1), ("2024-04-15", "On-time", 2), ("2024-05-02", "Late", 2)]
    assert all(r.is_valid_date for r in tm)

    loc = {r.postal_code_raw: r for r in build_dim_location(silver).collect()}
    assert loc["11-9077"].postal_code == "119077" and loc["11-9077"].region == "West"
    assert loc["520123"].region == "East" and loc["520123"].planning_area == "Tampines, Pasir Ris"
    assert loc["999999"].region is None and loc["999999"].is_valid_postal_code is False

    tp = build_dim_taxpayer(silver).orderBy("taxpayer_key").collect()
    assert [r.taxpayer_id for r in tp] == ["TP1", "TP2", "TP3", "TP4"]
    assert tp[1].nric is None


def test_fact_return_grain_and_measures(spark):
    silver = silver_transform(_returns(spark))
    star = build_star_schema(silver)
    fact = {r.annual_income_sgd: r for r in star["fact_tax_returns"].collect()}
    assert len(fact) == 4
    assert fact[85000.0].tax_compliance_rate == 8500.0 / 8205.0
    assert fact[50000.0].tax_compliance_rate == 0.0  # payable 0 -> divided by 1
    assert fact[50000.0].time_key is None  # impossible date has no time key
    assert fact[60000.0].tax_liability == 1000.0
    assert all(r.taxpayer_key is not None and r.location_key is not None and r.occupation_key is not None
               for r in fact.values())


def test_reference_grain_fans_out(spark):
    df = _returns(spark)
    # same postal code with two housing types -> two location rows for one code
    extra = df.filter("taxpayer_id = 'TP1'").withColumn("taxpayer_id", F.lit("TP5")) \
        .withColumn("housing_type", F.lit("HDB 5-room"))
    silver = silver_transform(df.unionByName(extra))
    ret = build_star_schema(silver)["fact_tax_returns"].count()
    ref = build_star_schema(silver, TaxParams(fact_grain="reference"))["fact_tax_returns"].count()
    # 119077 (cleansed) has three location rows: TP1's, TP5's and TP2's raw
    # '11-9077'; each of those three returns matches all three -> 9 + 2 others.
    assert ret == 5 and ref == 11


def test_postal_lookup_from_json(spark, tmp_dir):
    path = os.path.join(tmp_dir, "postal.json")
    with open(path, "w", encoding="utf-8") as f:
        json.dump([{"district": d, "area": a, "postal_codes": p, "region": r} for d, a, p, r in POSTAL_DISTRICTS], f)
    from_json = {tuple(r) for r in read_postal_lookup(spark, path).collect()}
    built_in = {tuple(r) for r in read_postal_lookup(spark).collect()}
    assert from_json == built_in and len(built_in) == 81


def test_broadcast_only_when_small(spark):
    small = spark.range(10)
    big = spark.range(100000)
    assert "ResolvedHint" in small.join(broadcast_if_small(small, 10_000), "id")._jdf.queryExecution().analyzed().toString() \
        or "broadcast" in str(small.join(broadcast_if_small(small, 10_000), "id")._jdf.queryExecution().optimizedPlan()).lower()
    joined = big.join(broadcast_if_small(big, 10_000), "id")
    assert "SortMergeJoin" in joined._jdf.queryExecution().executedPlan().toString()


def test_share_of_total_with_nothing_paid(spark):
    from qualstar.plans import analytics
    df = _returns(spark).withColumn("tax_paid_sgd", F.lit(0.0))
    star = build_star_schema(silver_transform(df))
    rows = analytics.bo_3a_revenue_by_region(star).collect()
    assert rows and all(r.revenue_percentage is None for r in rows)
    sql_rows = analytics.run_sql(spark, "bo_3a_revenue_by_region", star, prefix="t0_").collect()
    assert all(r.revenue_percentage is None for r in sql_rows)


def test_only_the_dimensions_asked_for_are_built(spark):
    from qualstar.operators import score, star
    from qualstar.plans.tax import silver_transform
    from qualstar.sources.adapters import tax_returns
    from qualstar.session import pin
    silver = pin(score.route(silver_transform(tax_returns(spark, "/root/testdata/sf0.001")))[0], "silver")
    few = star.build_star_schema(silver, with_fact_key=False, only=["dim_time", "dim_occupation"])
    assert set(few) == {"dim_time", "dim_occupation", "fact_tax_returns"}
    fact = few["fact_tax_returns"]
    assert {"time_key", "occupation_key"} <= set(fact.columns) and not {"taxpayer_key", "location_key"} & set(fact.columns)
    whole = star.build_star_schema(silver, with_fact_key=False)["fact_tax_returns"]
    assert whole.columns[:5] == ["taxpayer_key", "time_key", "location_key", "occupation_key", "assessment_year"]
    assert sorted(map(str, fact.collect())) == sorted(map(str, whole.select(fact.columns).collect()))
    bare = star.build_star_schema(silver, with_fact_key=False, only=[])
    assert set(bare) == {"fact_tax_returns"} and bare["fact_tax_returns"].count() == silver.count()
