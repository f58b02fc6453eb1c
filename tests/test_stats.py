from tests.conftest import plan_text
import math
from decimal import Decimal
import random

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.stat import Correlation

from panelspark.operators import stats


@pytest.fixture(scope="module")
def frame(spark):
    rnd = random.Random(11)
    rows = []
    for i in range(3000):
        a = rnd.gauss(10, 3)
        rows.append((i, ["x", "y", "z"][i % 3], a, 2 * a + rnd.gauss(0, 1), rnd.random() * 100 + 1))
    return spark.createDataFrame(rows, "id long, g string, a double, b double, c double")


def test_numeric_summary_matches_numpy(frame):
    pdf = frame.toPandas()
    out = {r["variable"]: r for r in stats.numeric_summary(frame, ["a", "c"]).collect()}
    for col in ["a", "c"]:
        xs = np.sort(pdf[col].to_numpy())
        r = out[col]
        assert r["n"] == len(xs)
        assert r["mean"] == pytest.approx(xs.mean(), rel=1e-12)
        assert r["stddev"] == pytest.approx(xs.std(ddof=1), rel=1e-9)
        assert (r["min"], r["max"]) == (xs[0], xs[-1])
        for name, p in [("p25", 0.25), ("median", 0.5), ("p75", 0.75), ("p95", 0.95)]:
            assert r[name] == xs[max(1, math.ceil(Decimal(str(p)) * len(xs))) - 1]


def test_group_median_order(frame):
    out = stats.group_median(frame, "c", ["g"], group_bound=3).collect()
    meds = [r["median"] for r in out]
    assert meds == sorted(meds, reverse=True) and sum(r["n"] for r in out) == 3000


def test_correlation_matches_mllib(frame):
    cols = ["a", "b", "c"]
    ours = {(r["var_x"], r["var_y"]): r["r"] for r in stats.correlation_long(frame, cols).collect()}
    vec = VectorAssembler(inputCols=cols, outputCol="v").transform(frame).select("v")
    mat = Correlation.corr(vec, "v").first()[0].toArray()
    for i, a in enumerate(cols):
        for j, b in enumerate(cols):
            assert ours[(a, b)] == pytest.approx(mat[i, j], abs=1e-12)
    top = stats.top_association(stats.correlation_long(frame, cols), "a").first()
    assert top["variable"] == "b"


def test_correlation_constant_column_is_null(spark):
    # Q18: no ANSI divide-by-zero error, NULL instead.
    df = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0), (3.0, 5.0)], "x double, k double")
    out = {(r["var_x"], r["var_y"]): r["r"] for r in stats.correlation_long(df, ["x", "k"]).collect()}
    assert out[("x", "k")] is None and out[("x", "x")] == pytest.approx(1.0)


def test_histogram_counts_all_rows(frame):
    h = stats.histogram(frame, "c", bins=60).collect()
    assert sum(r["n"] for r in h) == 3000
    assert all(0 <= r["bin"] < 60 for r in h)
    lh = stats.histogram(frame, "c", bins=10, log10=True).collect()
    assert sum(r["n"] for r in lh) == 3000


def test_histogram_plan_has_no_cartesian(frame):
    plan = plan_text(stats.histogram(frame, "c"))
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan


def test_category_frequency(frame):
    out = {(r["variable"], r["value"]): r["n"] for r in stats.category_frequency(frame, ["g"]).collect()}
    assert out == {("g", "x"): 1000, ("g", "y"): 1000, ("g", "z"): 1000}


def test_group_mode_tie_breaks_on_value(spark):
    df = spark.createDataFrame([(1, "b"), (1, "a"), (1, "b"), (1, "a"), (2, "c"), (2, None), (2, None)],
                               "k int, v string")
    out = {r["k"]: r["v_mode"] for r in stats.group_mode(df, ["k"], "v").collect()}
    assert out == {1: "a", 2: "c"}


def test_seeded_sample_independent_of_partitioning(frame):
    a = sorted(r["id"] for r in stats.seeded_sample(frame, 100, ["id"]).collect())
    b = sorted(r["id"] for r in stats.seeded_sample(frame.repartition(7, "g"), 100, ["id"]).collect())
    assert a == b and len(a) == 100
    assert stats.seeded_sample(frame.limit(10), 100, ["id"]).count() == 10
    plan = plan_text(stats.seeded_sample(frame, 100, ["id"]))
    assert "TakeOrderedAndProject" in plan


def test_group_modes_match_single_modes(spark):
    rows = [(1, "b", "x"), (1, "a", "y"), (1, "b", "y"), (2, "c", None), (2, "a", "z"), (2, "c", "z")]
    df = spark.createDataFrame(rows, "k int, u string, w string")
    both = {r["k"]: (r["u_m"], r["w_m"]) for r in stats.group_modes(df, ["k"], {"u": "u_m", "w": "w_m"}).collect()}
    single_u = {r["k"]: r["u_m"] for r in stats.group_mode(df, ["k"], "u", "u_m").collect()}
    single_w = {r["k"]: r["w_m"] for r in stats.group_mode(df, ["k"], "w", "w_m").collect()}
    assert both == {k: (single_u[k], single_w[k]) for k in both} == {1: ("b", "y"), 2: ("c", "z")}
