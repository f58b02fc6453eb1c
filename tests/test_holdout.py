"""Frozen models on a later period: one chain of predictions, and samples of it."""
import math

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from panelspark.operators import diagnose, regress, stats
from panelspark.functions.columns import hash_text
from panelspark.plans import catalog
from tests.conftest import SF_SMALL, plan_text


@pytest.fixture(scope="module")
def scored(spark):
    """Two fitted models, training rows (with NULL and odd values) and a later period."""
    rows = [(k, float(k % 7), "ab"[k % 2], 10.0 * (k % 7) + (5 if k % 2 else 0) + (k % 3)) for k in range(200)]
    later = [(1000 + k, float(k % 9), "abc"[k % 3], 20.0 + k) for k in range(40)] + [(2000, 1.0, "a", None), (2001, None, "b", 3.0)]
    schema = "id long, x double, g string, y double"
    train, hold = spark.createDataFrame(rows, schema), spark.createDataFrame(later, schema)
    linear = regress.FeatureSpec(("x",), ("g",), "y")
    cells = regress.FeatureSpec((), ("g",), "y")
    models = [("linear", regress.fit_pipeline(regress.linear_pipeline(linear, 0.0, tol=1e-12), train, linear)),
              ("forest", regress.fit_pipeline(regress.forest_pipeline(cells, 3, 4, subset="all", bootstrap=False), train, cells))]
    return train, hold.where("x IS NOT NULL"), models


def test_three_models_on_the_same_rows(scored):
    train, hold, models = scored
    mean = train.agg(F.avg("y")).scalar()
    out = {r["model"]: r for r in regress.holdout_evaluation(models, hold, "y", mean).collect()}
    assert set(out) == {"baseline_mean", "linear", "forest"}
    assert {(r["n_holdout"], r["n_scored"], r["rows_ok"]) for r in out.values()} == {(41, 40, False)}
    ys = [r["y"] for r in hold.where("y IS NOT NULL").collect()]
    mu = train.agg(F.avg("y")).first()[0]
    assert math.isclose(out["baseline_mean"]["rmse"], math.sqrt(sum((y - mu) ** 2 for y in ys) / len(ys)))
    cell = {r["g"]: r["m"] for r in train.groupBy("g").agg(F.avg("y").alias("m")).collect()}
    known = [(r["y"], cell[r["g"]]) for r in hold.where("y IS NOT NULL AND g != 'c'").collect()]
    part = regress.holdout_evaluation(models[1:], hold.where("g != 'c'"), "y").first()
    assert math.isclose(part["mae"], sum(abs(y - p) for y, p in known) / len(known))
    assert regress.holdout_evaluation(models, hold.where("FALSE"), "y").collect() == []


def test_scoring_is_one_scan_without_joins(spark):
    plan = plan_text(E.queries()["holdout_evaluation"](spark, SF_SMALL))
    assert "Join" not in plan.split("Subqueries")[0]
    assert "GreaterThanOrEqual(l_shipdate" in plan


def test_no_error_is_zero_on_the_holdout(spark):
    for name in ("holdout_evaluation", "holdout_errors_by_group", "errors_by_quantile_band"):
        rows = E.queries()[name](spark, SF_SMALL).collect()
        assert len(rows) >= 3 and all(r["rmse"] > 1 for r in rows), name


def test_paired_scores_sample_before_scoring(scored):
    _, hold, models = scored
    got = diagnose.paired_scores(hold, models, ["id"], "y", n=15).collect()
    want = stats.seeded_sample(hold, 15, ["id"], columns=["id", "y"]).collect()
    assert sorted((r["id"], r["actual"]) for r in got) == sorted((r["id"], r["y"]) for r in want)
    both = {r["id"]: (r["linear"], r["forest"]) for r in regress.score_both(hold, models).collect()}
    assert all(both[r["id"]] == (r["linear"], r["forest"]) for r in got)


def test_sets_are_compared_with_a_reference(spark):
    table = lambda rows: spark.createDataFrame(rows, "model string, n long, mae double, rmse double, r2 double")
    board = regress.across_sets({"validation": table([("base", 5, 1.0, 10.0, 0.0), ("tree", 5, 1.0, 8.0, 0.4)]),
                                 "holdout": table([("base", 3, 1.0, 20.0, 0.0), ("tree", 3, 1.0, 10.0, 0.4), ("new", 3, 0.0, 0.0, 1.0)])},
                                "validation", "base")
    got = {(r["set"], r["model"]): (r["rmse_vs_reference"], r["rmse_vs_baseline"]) for r in board.collect()}
    assert got == {("validation", "base"): (0.0, 0.0), ("validation", "tree"): (0.0, -0.2), ("holdout", "base"): (1.0, 0.0),
                   ("holdout", "tree"): (0.25, -0.5), ("holdout", "new"): (None, -1.0)}


def test_split_keeps_undated_and_later_rows(spark, tmp_dir):
    rows = [(1, "1999-12-31 23:59:59"), (2, None), (3, "2001-01-01 00:00:00"), (4, "2005-05-05 00:00:00")]
    spark.createDataFrame(rows, "l_orderkey long, d string").select("l_orderkey", F.col("d").cast("timestamp_ntz").alias("l_shipdate")) \
        .write.parquet(f"{tmp_dir}/lineitem.parquet")
    dev, hold = catalog._dev_holdout(spark, tmp_dir)
    assert sorted(r["l_orderkey"] for r in dev.collect()) == [1, 2]
    assert sorted(r["l_orderkey"] for r in hold.collect()) == [3, 4]


@pytest.mark.parametrize("digits", [1, 5])
@pytest.mark.parametrize("n", [0, 1, 100, 2999, 5000])
def test_seeded_sample_equals_the_plain_order(spark, monkeypatch, digits, n):
    monkeypatch.setattr(stats, "SAMPLE_DIGITS", digits)
    df = spark.range(3000).select((F.col("id") % 2700).alias("id"), F.col("id").alias("v"))
    plain = df.withColumn("h", F.md5(hash_text(["id"], "42"))).orderBy("h", "id", "v").limit(n).select("id", "v").collect()
    assert stats.seeded_sample(df, n, ["id"]).collect() == plain


def test_seeded_sample_orders_few_rows(spark):
    """Rows that reach the final order: the sample and those of one leading part."""
    df = spark.range(200_000)
    out = stats.seeded_sample(df, 50, ["id"])
    before = out.select("id").count()
    heads = df.select(F.substring(F.md5(hash_text(["id"], "42")), 1, stats.SAMPLE_DIGITS).alias("h"))
    last = heads.orderBy("h").limit(50).agg(F.max("h")).first()[0]
    assert before == 50 and heads.where(F.col("h") <= last).count() < 60
    assert "scalar-subquery" in plan_text(out) or "Subquery" in plan_text(out)


def test_null_keys_are_sampled_once(spark):
    df = spark.createDataFrame([(None, k) for k in range(5)] + [(1, 9)], "id long, v long")
    assert stats.seeded_sample(df, 10, ["id"]).count() == 6 and stats.seeded_sample(df.where("FALSE"), 10, ["id"]).count() == 0
