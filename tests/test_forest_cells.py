"""Forests of many bagged rows, grown over binned cells instead of rows."""

import datetime

import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from panelspark.operators import forest, regress
from panelspark.plans import catalog

SPEC = regress.FeatureSpec(numeric=("a", "b"), categorical=("c",), label="y")


@pytest.fixture(scope="module")
def rows(spark):
    return spark.range(3000).select(
        "id", (F.pmod(F.xxhash64("id"), F.lit(1000)) / 7).alias("a"), (F.col("id") % 9).cast("double").alias("b"),
        F.element_at(F.array(*map(F.lit, "xyz")), (F.col("id") % 3 + 1).cast("int")).alias("c")) \
        .withColumn("y", F.col("a") * 3 + F.col("b") * F.col("b") + F.pmod(F.xxhash64("id", "a"), F.lit(100)) / 10)


@pytest.fixture()
def swept(monkeypatch):
    def sweep(train, many, configs=((5, 4), (12, 7)), spec=SPEC, **given):
        monkeypatch.setattr(forest, "MANY_BAGGED", many)
        return regress.forest_sweep(train, train, spec, configs=configs, max_bins=16, keys=["id"], **given)
    return sweep


def _trees(model):
    return model.stages[-1].toDebugString.splitlines()[1:]


def test_many_bagged_rows_are_grown_over_cells(rows, swept, monkeypatch):
    calls = []
    monkeypatch.setattr(forest, "fit_cells", lambda cells, est, fit=forest.fit_cells: calls.append(est) or fit(cells, est))
    few, many = swept(rows, 36000), swept(rows, 35999)
    assert len(calls) == 2
    for key, model in many.models.items():
        forest_model = model.stages[-1]
        assert (forest_model.getNumTrees, max(t.depth for t in forest_model.trees)) == key
        assert forest_model.numFeatures == few.models[key].stages[-1].numFeatures
    a, b = ({r["max_depth"]: r for r in s.table.collect()} for s in (few, many))
    assert all(b[d]["r2"] == pytest.approx(a[d]["r2"], abs=0.1) for d in a)
    scored = many.best_scored
    assert scored.count() == 3000 and scored.columns == ["y", "prediction"]


def test_without_draws_the_trees_are_those_of_mllib(rows):
    est = regress.forest_estimator(SPEC, 2, 6, 16, "all", bootstrap=False)
    feats = VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(rows)
    with forest.cells_of(feats, "features", "y", ["id"], 3000, 4, 16, 42) as cells:
        ours = forest.fit_cells(cells, est)
    theirs = est.fit(feats)
    assert ours.treeWeights == theirs.treeWeights and ours.totalNumNodes == theirs.totalNumNodes
    both = ours.transform(feats).withColumnRenamed("prediction", "p").drop("features").join(theirs.transform(feats), "id")
    assert both.where(F.abs(F.col("p") - F.col("prediction")) > 1e-9).count() == 0


def test_trees_follow_the_rows_not_their_layout(rows, swept):
    a, b = (swept(df, 0).best_model for df in (rows, rows.repartition(7, F.rand(3))))
    assert _trees(a) == _trees(b)


def test_bags_hold_every_row(rows, spark):
    # All rows in one cell, many times a share: weights are Poisson, so a tree's are 3000 on average.
    feats = VectorAssembler(inputCols=["b"], outputCol="features").transform(rows.withColumn("b", F.lit(1.0)))
    est = regress.forest_estimator(SPEC, 50, 2)
    for label in ("y", "b"):
        with forest.cells_of(feats, "features", label, ["id"], 3000, 8, 16, 42) as cells:
            model = forest.fit_cells(cells, est)
            assert cells.counted.agg(F.sum("m")).first()[0] == 3000
            if label == "y":
                largest = cells.counted.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
                assert largest < 3000
        path = forest.shared_dir(spark, "models", "test", unique=True)
        model.write().save(path)
        weights = [r[0] for r in spark.read.parquet(f"{path}/data").where("nodeData.id = 0").select("nodeData.rawCount").collect()]
        assert len(weights) == 50 and len(set(weights)) > 10 and abs(sum(weights) / 50 - 3000) < 5 * (3000 / 50) ** 0.5


def test_too_many_cells_are_left_to_mllib(rows, swept, monkeypatch):
    monkeypatch.setattr(forest, "MOST_CELLS", 10)
    monkeypatch.setattr(forest, "fit_cells", None)
    assert len(swept(rows, 0).models) == 2


def test_labels_must_be_there(rows, swept):
    with pytest.raises(Exception, match="Null or NaN"):
        swept(rows.withColumn("y", F.when(F.col("id") != 7, F.col("y"))), 0)


def test_rf_sweep_grows_all_its_trees_over_cells(spark, tmp_path, monkeypatch):
    made = [(k, k % 40, k % 10, k % 4 + 1, float(k % 23 + 1), 900.0 + 7 * (k % 101), k % 7 / 100, k % 5 / 100,
             "ANR"[k % 3], "FO"[k // 3 % 2], datetime.datetime(1995 + k % 6, 3, 1)) for k in range(1200)]
    spark.createDataFrame(made, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, "
                          "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
                          "l_linestatus string, l_shipdate timestamp_ntz").write.parquet(f"{tmp_path}/lineitem.parquet")
    fitted = []

    def fit(cells, est, fit_cells=forest.fit_cells):
        # The labels are one a cell, and rows of one cell and label are one counted row: no cell is a hot partition.
        counted = cells.counted.agg(F.count(F.lit(1)), F.countDistinct("cell"), F.sum("m")).first()
        assert counted[0] == counted[1] < counted[2]
        fitted.append(fit_cells(cells, est))
        return fitted[-1]
    monkeypatch.setattr(forest, "MANY_BAGGED", 0)
    monkeypatch.setattr(forest, "fit_cells", fit)
    rows = {r["num_trees"]: r for r in catalog.q_rf_sweep(spark, str(tmp_path)).collect()}
    assert sorted(rows) == [60, 120] and [m.getNumTrees for m in fitted] == [60, 120]
    assert all(r["r2"] > 0.9 for r in rows.values()) and sum(r["chosen"] for r in rows.values()) == 1
