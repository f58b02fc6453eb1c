import pytest
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.sql import functions as F

from panelspark.operators import diagnose, regress, segment
from panelspark.plans import standin as S
from tests.conftest import SF_SMALL


@pytest.fixture(scope="module")
def lines(spark):
    return S.table(spark, SF_SMALL, "lineitem")


def test_separable_clusters_recovered(spark, lines):
    li = lines.withColumns(S.separable_features())
    _, scored = segment.fit_segments(li, ["sep_a", "sep_b"], k=2)
    wrong = scored.where(F.col("cluster") != F.when(F.col("l_linestatus") == "F", 1).otherwise(0)).count()
    assert wrong == 0


def test_kmeans_sweep_and_profile(spark, lines):
    feats = segment.scaler_pipeline(["l_quantity", "l_tax"]).fit(lines).transform(lines)
    table, models = segment.kmeans_sweep(feats, "features", ks=(2, 3))
    rows = table.collect()
    assert sorted(models) == [2, 3] and sum(r["chosen"] for r in rows) == 1
    assert all(-1 <= r["silhouette"] <= 1 and r["wssse"] > 0 for r in rows)
    scored = segment.assign_clusters(models[2], feats)
    prof = segment.cluster_profile(scored, "cluster", ["l_quantity"], "l_extendedprice",
                                   {"l_returnflag": "flag_mode"}, cluster_bound=2).collect()
    assert sum(r["n"] for r in prof) == lines.count()
    desc = segment.describe_clusters(segment.cluster_profile(
        scored, "cluster", ["l_quantity"], "l_extendedprice", {"l_returnflag": "flag_mode"}),
        scored, ["l_quantity"], "flag_mode").collect()
    assert all(r["description"].startswith(("higher", "lower")) for r in desc)


def test_hash_split_disjoint_complete_stable(spark, lines):
    key = ["l_orderkey", "l_linenumber", "l_partkey"]
    a = regress.hash_split(lines, key)
    b = regress.hash_split(lines.repartition(5), key)
    ca = {tuple(r[:3]): r[3] for r in a.select(*key, "split").collect()}
    cb = {tuple(r[:3]): r[3] for r in b.select(*key, "split").collect()}
    assert ca == cb
    tr, va = regress.split_frames(lines, key)
    assert tr.count() + va.count() == lines.count()
    assert 0.7 < tr.count() / lines.count() < 0.9


def test_metrics_match_regression_evaluator(spark, lines):
    pred = lines.withColumn("prediction", F.col("l_quantity") * 1500.0)
    ours = regress.regression_metrics(pred, "l_extendedprice").first()
    for m in ("mae", "rmse", "r2"):
        ref = RegressionEvaluator(labelCol="l_extendedprice", metricName=m).evaluate(pred)
        assert ours[m] == pytest.approx(ref, rel=1e-9)
    assert ours["rmse"] >= ours["mae"]


def test_ridge_recovers_linear_fixture_and_holdout(spark, lines):
    li = lines.withColumn("y", S.linear_target())
    tr, va = regress.split_frames(li, ["l_orderkey", "l_linenumber", "l_partkey"])
    spec = regress.FeatureSpec(("l_quantity", "l_discount", "l_tax"), ("l_returnflag",), "y")
    res = regress.ridge_sweep(tr, va, spec, reg_params=(0.0, 10.0))
    rows = {r["reg_param"]: r for r in res.table.collect()}
    assert rows[0.0]["r2"] > 0.999 and rows[0.0]["chosen"]
    out = regress.holdout_evaluation([("linear", res.best_model)], va, "y",
                                     train_mean=tr.agg(F.avg("y")).scalar()).collect()
    by = {r["model"]: r for r in out}
    assert all(r["rows_ok"] for r in out) and by["linear"]["rmse"] < 1e-3
    assert by["baseline_mean"]["rmse"] > by["linear"]["rmse"]


def test_forest_exact_on_step_fixture(spark, lines):
    li = lines.withColumn("z", S.step_target())
    spec = regress.FeatureSpec(("l_quantity",), ("l_returnflag", "l_linestatus"), "z")
    model = regress.forest_pipeline(spec, 10, 5, subset="all").fit(li)
    err = model.transform(li).agg(F.max(F.abs(F.col("z") - F.col("prediction")))).first()[0]
    assert err < 1e-9


def test_leaderboard_and_diagnostics(spark, lines):
    pred = lines.withColumns({"prediction": F.col("l_quantity") * 1500.0,
                              "pred_b": F.col("l_quantity") * 1000.0 + 20000.0})
    a = regress.regression_metrics(pred, "l_extendedprice")
    b = regress.regression_metrics(pred.withColumn("prediction", F.col("pred_b")), "l_extendedprice")
    board = {r["model"]: r for r in regress.leaderboard([("a", a), ("b", b)], baseline_name="a").collect()}
    assert min(r["rmse_vs_best"] for r in board.values()) == 0.0
    assert board["a"]["rmse_vs_baseline"] == 0.0
    groups = diagnose.errors_by_group(pred, "l_extendedprice", ["l_returnflag", "l_linestatus"]).collect()
    n = lines.count()
    assert sum(r["n"] for r in groups if r["grouping"] == "l_returnflag") == n
    bands = diagnose.errors_by_band(pred, "l_extendedprice").collect()
    assert sum(r["n"] for r in bands) == n and {r["band"] for r in bands} <= set(diagnose.BAND_LABELS)
    sample = diagnose.paired_sample(pred, ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"],
                                    ["prediction", "pred_b"], n=50)
    assert sample.count() == 50


def test_split_variants(spark, lines):
    li = lines.withColumn("period", F.year("l_shipdate").cast("string"))
    tr, va = regress.period_split(li, "period", ["2001"])
    assert va.where(F.col("period") != "2001").count() == 0 and tr.count() + va.count() == li.count()
    # Group split: hashing the order key alone keeps all lines of an order together.
    tr, va = regress.split_frames(li, ["l_orderkey"])
    assert tr.join(va, "l_orderkey", "left_semi").count() == 0
    tr, va = regress.split_frames(li, [], method="random", seed=42)
    assert tr.count() + va.count() == li.count()


def test_refit_on_dev_then_holdout(spark, lines):
    li = lines.withColumns({"y": S.linear_target(), "year": F.year("l_shipdate")})
    dev, hold = li.where(F.col("year") < 2001), li.where(F.col("year") == 2001)
    spec = regress.FeatureSpec(("l_quantity", "l_discount", "l_tax"), ("l_returnflag",), "y")
    models = regress.refit_on_dev([("linear", regress.linear_pipeline(spec, 0.0))], dev, spec,
                                  keys=["l_orderkey", "l_linenumber", "l_partkey"])
    out = regress.holdout_evaluation(models, hold, "y").first()
    assert out["rows_ok"] and out["rmse"] < 1e-3


def test_task_memory_budget(spark):
    assert regress._memory_mb("4g") == 4096 and regress._memory_mb("512m") == 512
    assert regress._memory_mb("1024") == 1024
    budget = regress.task_memory_mb(spark)
    assert 16 <= budget <= 256


def test_fits_do_not_depend_on_input_layout(spark, lines):
    # Q16: with fit_input the sweep sees the same rows in the same partitions
    # and order whatever the input partitioning was.
    key = ["l_orderkey", "l_linenumber", "l_partkey"]
    scaler = segment.scaler_pipeline(["l_quantity", "l_tax"]).fit(lines)
    a, _ = segment.kmeans_sweep(scaler.transform(lines), "features", ks=(2, 3), keys=key)
    b, _ = segment.kmeans_sweep(scaler.transform(lines.repartition(5)), "features", ks=(2, 3), keys=key)
    ra, rb = sorted(a.collect()), sorted(b.collect())
    # Same clusters (silhouette identical); WSSSE is summed over partitions
    # in task-completion order, so only its last bits may differ.
    assert [(r["k"], r["silhouette"], r["chosen"]) for r in ra] == \
        [(r["k"], r["silhouette"], r["chosen"]) for r in rb]
    assert all(x["wssse"] == pytest.approx(y["wssse"], rel=1e-12) for x, y in zip(ra, rb))
