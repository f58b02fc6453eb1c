"""KMeans sweeps of many rows: all k in shared passes over points."""

import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from panelspark.operators import rounds, segment


@pytest.fixture(scope="module")
def rows(spark):
    spread = [(F.pmod(F.xxhash64("id", F.lit(i)), F.lit(1000)) / 1000).alias(f"r{i}") for i in range(2)]
    return spark.range(2400).select("id", *spread).select(
        "id", (F.col("r0") + F.element_at(F.array(F.lit(0.0), F.lit(10.0), F.lit(60.0)), (F.col("id") % 3 + 1).cast("int"))).alias("x"),
        F.col("r1").alias("y"), F.col("r0").alias("z"))


@pytest.fixture()
def shared(monkeypatch):
    monkeypatch.setattr(rounds, "MANY_ROWS", 100)
    monkeypatch.setattr(segment, "fit_input", None)  # many rows are not dealt and sorted


def _features(df, *columns):
    return VectorAssembler(inputCols=list(columns), outputCol="features").transform(df)


def _table(result):
    return {r["k"]: r for r in result[0].collect()}


def test_shared_passes_find_what_mllib_finds(rows, request):
    feats = _features(rows, "x", "y")
    theirs, models = segment.kmeans_sweep(feats, "features", ks=(2, 3), keys=["id"])
    request.getfixturevalue("shared")
    ours, found = segment.kmeans_sweep(feats, "features", ks=(2, 3), keys=["id"])
    a, b = ({r["k"]: r for r in t.collect()} for t in (theirs, ours))
    for k in (2, 3):
        assert b[k]["wssse"] == pytest.approx(a[k]["wssse"], rel=1e-9)
        assert b[k]["silhouette"] == pytest.approx(a[k]["silhouette"], rel=1e-9)
        assert b[k]["chosen"] == a[k]["chosen"]
        centres = [sorted(map(tuple, m[k].clusterCenters())) for m in (models, found)]
        assert centres[1] == [pytest.approx(c, rel=1e-9) for c in centres[0]]


def test_passes_are_shared(rows, shared, monkeypatch):
    passes = []
    monkeypatch.setattr(rounds, "_passed", lambda *given, passed=rounds._passed: passes.append(1) or passed(*given))
    _, models = segment.scaled_sweep(rows, ["y", "z"], ks=(2, 3, 4, 5), keys=["id"])
    assert sorted(models) == [2, 3, 4, 5] and all(m.getSolver() == "block" for m in models.values())
    assert len(passes) <= rounds.START_STEPS + 1 + 20 + 2


def test_scores_are_those_of_the_models(rows, shared):
    feats = _features(rows, "y", "z")
    table, models = segment.kmeans_sweep(feats, "features", ks=(2, 4))
    for k, row in {r["k"]: r for r in table.collect()}.items():
        assert models[k].getK() == len(models[k].clusterCenters()) == k
        scored = models[k].transform(feats)
        assert row["silhouette"] == pytest.approx(segment.silhouette(scored, "features", "cluster"), rel=1e-9)
        cost = scored.rdd.map(lambda r, c=models[k].clusterCenters(): ((r["features"].toArray() - c[r["cluster"]]) ** 2).sum()).sum()
        assert cost <= row["wssse"] * (1 + 1e-9) and row["wssse"] < cost * 1.05


def test_sweep_follows_the_rows_not_their_layout(rows, shared):
    a, b = (_table(segment.scaled_sweep(df, ["y", "z"], ks=(2, 3), keys=["id"])) for df in (rows, rows.repartition(7, F.rand(3))))
    for k in a:
        assert b[k]["wssse"] == pytest.approx(a[k]["wssse"], rel=1e-9)
        assert b[k]["silhouette"] == pytest.approx(a[k]["silhouette"], rel=1e-9)


def test_rows_that_repeat_all_count(rows, shared):
    once, thrice = (_table(segment.kmeans_sweep(_features(df, "x", "y"), "features", ks=(2, 3)))
                    for df in (rows, rows.union(rows).union(rows)))
    for k in once:
        assert thrice[k]["wssse"] == pytest.approx(3 * once[k]["wssse"], rel=1e-9)


def test_values_must_be_numbers(rows, shared):
    odd = rows.withColumn("x", F.when(F.col("id") == 5, F.lit(float("inf"))).otherwise(F.col("x")))
    with pytest.raises(Exception, match="NaN or Infinity"):
        segment.kmeans_sweep(_features(odd, "x", "y"), "features", ks=(2,))
