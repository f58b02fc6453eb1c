"""Empty and degenerate inputs."""

from panelspark.operators import audit, funnel, quantiles, stats
from panelspark.operators.funnel import Rule
from pyspark.sql import functions as F


def _empty(spark):
    return spark.createDataFrame([], "g string, x double, s string")


def test_empty_inputs(spark):
    df = _empty(spark)
    assert quantiles.exact_quantiles(df, "x", [0.5], ["g"]).count() == 0
    assert quantiles.exact_quantiles(df, "x", [0.5]).count() == 0
    steps = funnel.funnel(df, [Rule("x > 0", F.col("x") > 0)]).orderBy("step_no").collect()
    assert [(r["remaining"], r["excluded"]) for r in steps] == [(0, 0), (0, 0)]
    assert stats.histogram(df, "x").count() == 0
    assert audit.duplicate_versions(df, ["g"]).count() == 0
    assert stats.group_mode(df, ["g"], "s").count() == 0
    summary = stats.numeric_summary(df, ["x"]).first()
    assert summary["n"] == 0 and summary["median"] is None


def test_constant_column_histogram_and_quantiles(spark):
    df = spark.createDataFrame([("a", 5.0)] * 7, "g string, x double")
    h = stats.histogram(df, "x", bins=10).collect()
    assert [(r["bin"], r["n"]) for r in h] == [(0, 7)]
    q = {r["prob"]: r["quantile"] for r in quantiles.exact_quantiles(df, "x", [0.0, 0.5, 1.0]).collect()}
    assert q == {0.0: 5.0, 0.5: 5.0, 1.0: 5.0}


def test_all_null_group_has_no_quantile_row(spark):
    df = spark.createDataFrame([("a", None), ("a", None), ("b", 1.0)], "g string, x double")
    out = {r["g"]: r["quantile"] for r in quantiles.exact_quantiles(df, "x", [0.5], ["g"]).collect()}
    assert out == {"b": 1.0}
    med = {r["g"]: (r["n"], r["median"]) for r in stats.group_median(df, "x", ["g"]).collect()}
    assert med == {"a": (2, None), "b": (1, 1.0)}
