from tests.conftest import plan_text
import math
from decimal import Decimal
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from panelspark.operators.quantiles import approx_quantiles, exact_quantiles, quantiles_wide

PROBS = [0.0, 0.05, 0.25, 0.5, 0.75, 0.9, 0.95, 1.0]


def brute(values, p):
    xs = sorted(values)
    return xs[max(1, math.ceil(Decimal(str(p)) * len(xs))) - 1]


def check(spark, rows, by, probs=PROBS, slices=None):
    df = spark.createDataFrame(rows, "g string, x double")
    got = {(r["g"] if by else None, r["prob"]): r["quantile"]
           for r in exact_quantiles(df, "x", probs, ["g"] if by else [], slices=slices).collect()}
    groups = {}
    for g, x in rows:
        if x is None:
            continue
        groups.setdefault(g if by else None, []).append(x)
    for g, xs in groups.items():
        for p in probs:
            assert got[(g, p)] == brute(xs, p), (g, p)
    assert len(got) == len(groups) * len(probs)


def test_exact_matches_brute_force_with_hot_group(spark):
    rnd = random.Random(7)
    rows = [("hot", float(rnd.randint(0, 5000))) for _ in range(20000)]   # a third of the rows and more
    rows += [(f"g{i % 13}", float(rnd.randint(0, 100))) for i in range(15000)]
    rows += [(None, 1.0), (None, 2.0), ("solo", 3.0), ("nulls", None)]
    check(spark, rows, by=True)


def test_hot_single_value_is_combined(spark):
    # One (group, value) pair holding most rows collapses in the pre-aggregation.
    rows = [("a", 7.0)] * 30000 + [("a", float(i)) for i in range(100)] + [("b", 1.0)]
    check(spark, rows, by=True, slices=16)


def test_global_quantiles(spark):
    rnd = random.Random(3)
    rows = [("x", rnd.random()) for _ in range(5000)]
    check(spark, rows, by=False)


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["a", "b", "c"]), st.integers(-50, 50)), min_size=1, max_size=60),
       st.integers(1, 6))
def test_exact_property(spark, data, slices):
    rows = [(g, float(x)) for g, x in data]
    check(spark, rows, by=True, slices=slices)


def test_wide_and_approx(spark):
    rows = [("a", float(i)) for i in range(1, 1001)]
    df = spark.createDataFrame(rows, "g string, x double")
    wide = quantiles_wide(df, "x", [0.5, 0.9], ["p50", "p90"], by=["g"]).first()
    assert (wide["p50"], wide["p90"]) == (500.0, 900.0)
    approx = {r["prob"]: r["quantile"] for r in approx_quantiles(df, "x", [0.5, 0.9], ["g"]).collect()}
    assert approx[0.5] == pytest.approx(500.0, abs=1) and approx[0.9] == pytest.approx(900.0, abs=1)


def test_target_table_is_broadcast_with_bound(spark):
    df = spark.range(1000).selectExpr("CAST(id % 3 AS STRING) AS g", "CAST(id AS DOUBLE) AS x")
    plan = plan_text(exact_quantiles(df, "x", [0.5], ["g"], group_bound=3))
    assert "BroadcastHashJoin" in plan or "BroadcastExchange" in plan


@settings(max_examples=10, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["a", "b", None]), st.sampled_from([1, 2]),
                          st.one_of(st.none(), st.integers(-20, 20))), min_size=1, max_size=50))
def test_exact_property_two_keys_default_slices(spark, data):
    rows = [(g, h, None if x is None else float(x)) for g, h, x in data]
    df = spark.createDataFrame(rows, "g string, h int, x double")
    probs = [0.1, 0.5, 0.9]
    got = {(r["g"], r["h"], r["prob"]): r["quantile"]
           for r in exact_quantiles(df, "x", probs, ["g", "h"]).collect()}
    groups = {}
    for g, h, x in rows:
        if x is not None:
            groups.setdefault((g, h), []).append(x)
    assert len(got) == len(groups) * len(probs)
    for (g, h), xs in groups.items():
        for p in probs:
            assert got[(g, h, p)] == brute(xs, p)


@pytest.mark.parametrize("rounds", [0, 1, 3])
def test_slices_are_sliced_again(spark, monkeypatch, rounds):
    from panelspark.operators import quantiles
    monkeypatch.setattr(quantiles, "REFINE", rounds)
    rnd = random.Random(rounds)
    rows = [(rnd.choice(["a", "b", None]), rnd.choice([None, float(rnd.randrange(300)), rnd.random()])) for _ in range(3000)]
    check(spark, rows, by=True, slices=2)
    check(spark, rows, by=False, slices=2)


def test_global_quantiles_join_nothing(spark):
    df = spark.range(1000).selectExpr("CAST(id AS DOUBLE) AS x")
    plan = plan_text(exact_quantiles(df, "x", [0.5, 0.9]))
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_moments_of_counts(spark):
    from panelspark.operators.quantiles import moments, value_counts
    rnd = random.Random(2)
    rows = [(g, None if rnd.random() < 0.1 else 1e9 + rnd.randrange(50) / 8) for g in ["a", "b", None] for _ in range(400)]
    rows += [("one", 5.0), ("none", None)]
    df = spark.createDataFrame(rows, "g string, x double")
    for by in (["g"], []):
        want = {tuple(r[k] for k in by): r for r in df.groupBy(*by).agg(
            F.count(F.lit(1)).alias("rows"), F.count("x").alias("n"), F.avg("x").alias("mean"), F.stddev_samp("x").alias("stddev"),
            F.min("x").alias("min"), F.max("x").alias("max")).collect()}
        got = {tuple(r[k] for k in by): r for r in moments(value_counts(df, "x", by, slices=5), by).collect()}
        assert set(got) == set(want)
        for k, r in got.items():
            assert (r["rows"], r["n"], r["min"], r["max"]) == tuple(want[k][c] for c in ("rows", "n", "min", "max"))
            for c in ("mean", "stddev"):
                assert r[c] == want[k][c] or math.isclose(r[c], want[k][c], rel_tol=1e-6), (k, c)


def test_a_summary_scans_its_source_once(spark, tmp_dir):
    from panelspark.operators import stats
    spark.createDataFrame([(float(k % 40), float(k), "ab"[k % 2]) for k in range(500)], "x double, y double, g string") \
        .write.parquet(f"{tmp_dir}/t")
    df = spark.read.parquet(f"{tmp_dir}/t")
    for made in (stats.numeric_summary(df, ["x", "y"]), stats.group_median(df, "x", ["g"], group_bound=2)):
        made.collect()
        final = made._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
        assert final.count("FileScan") <= 1 or "ReusedExchange" in final or "ReusedQueryStage" in final
