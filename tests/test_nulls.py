"""Answers with NULLs and at awkward probabilities, against DuckDB."""
import duckdb
import pytest

from panelspark.operators.quantiles import exact_quantiles
from panelspark.operators.regress import period_split, regression_metrics
from panelspark.operators.stats import correlation_long


def test_correlation_uses_complete_pairs(spark):
    rows = [(1.0, 2.0, 5.0), (2.0, 4.0, 5.0), (3.0, 6.0, 5.0), (900.0, None, 5.0), (None, -700.0, None)]
    got = {(r["var_x"], r["var_y"]): r["r"] for r in correlation_long(spark.createDataFrame(rows, "a double, b double, c double"), ["a", "b", "c"]).collect()}
    assert got["a", "b"] == pytest.approx(1.0) and got["b", "a"] == pytest.approx(1.0)
    assert got["a", "a"] == pytest.approx(1.0) and got["a", "c"] is None


def test_metrics_skip_rows_without_a_label(spark):
    rows = [(1.0, 1.0), (2.0, 3.0), (4.0, 3.0), (None, 9.0), (5.0, None)]
    m = regression_metrics(spark.createDataFrame(rows, "label double, prediction double"), "label").first()
    assert m["n"] == 3 and m["mae"] == pytest.approx(2 / 3)
    assert m["r2"] == pytest.approx(1 - 2 / (14 / 3))


def test_quantile_rank_is_exact(spark):
    probs = [0.07, 0.14, 0.28, 0.55, 0.56, 0.0, 1.0, 0.5]
    got = {r["prob"]: r["quantile"] for r in exact_quantiles(spark.range(1, 101).toDF("x"), "x", probs).collect()}
    for p in probs:
        assert got[p] == duckdb.sql(f"SELECT quantile_disc(x, {p}) FROM range(1, 101) t(x)").fetchall()[0][0]


def test_a_null_period_trains(spark):
    train, valid = period_split(spark.createDataFrame([("a",), ("b",), (None,)], "p string"), "p", ["b"])
    assert (train.count(), valid.count()) == (2, 1)
