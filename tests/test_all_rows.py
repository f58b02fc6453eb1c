"""Queries by period and histograms account for every row: years outside the
manifest, rows without a date, values that are not finite."""

import json
import os
import subprocess
import sys

import duckdb
import pytest
from pyspark.sql import functions as F

from panelspark.operators import segment, stats
from panelspark.plans import catalog
from tests.conftest import SF_SMALL
from tests.test_registry import _digest


@pytest.fixture(scope="module")
def odd_dir(spark, tmp_path_factory):
    """The small tables with some dates moved or taken away, and odd prices."""
    out = str(tmp_path_factory.mktemp("odd"))
    k = F.col("l_orderkey")
    ship = (F.when(k % 7 == 0, F.lit(None)).when(k % 7 == 1, F.lit("1980-03-04 00:00:00").cast("timestamp_ntz"))
            .when(k % 7 == 2, F.lit("2010-05-06 00:00:00").cast("timestamp_ntz")).otherwise(F.col("l_shipdate")))
    spark.read.parquet(f"{SF_SMALL}/lineitem.parquet").withColumn("l_shipdate", ship).write.parquet(f"{out}/lineitem.parquet")
    k = F.col("o_orderkey")
    price = (F.when(k % 9 == 0, F.lit(None)).when(k % 9 == 1, F.lit(float("inf"))).when(k % 9 == 2, F.lit(float("nan")))
             .when(k % 9 == 3, F.lit(-5.0)).when(k % 9 == 4, F.lit(0.0)).otherwise(F.col("o_totalprice")))
    spark.read.parquet(f"{SF_SMALL}/orders.parquet").withColumn("o_totalprice", price).write.parquet(f"{out}/orders.parquet")
    return out


@pytest.mark.parametrize("name", ["union_periods", "stream_ingest_periods", "csv_scan_periods", "source_code_crosstab",
                                  "period_median", "histogram", "log_histogram", "cluster_profile"])
def test_no_row_goes_uncounted(spark, odd_dir, name):
    con = duckdb.connect()
    for t in ("lineitem", "orders"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{odd_dir}/{t}.parquet/*.parquet')")
    df = catalog.queries()[name](spark, odd_dir)
    want = con.execute(catalog.oracle_sql()[name])
    columns = [d[0] for d in want.description]
    assert sorted(columns) == sorted(df.columns)
    assert _digest(df.columns, [tuple(r) for r in df.collect()]) == _digest(columns, want.fetchall())


def test_histogram_counts_what_has_no_bin(spark):
    df = spark.createDataFrame([(x,) for x in (1.0, 2.0, 3.0, float("inf"), float("nan"), None, -1.0, 0.0)], "x double")
    plain = {r["bin"]: r["n"] for r in stats.histogram(df, "x", 4).collect()}
    assert plain == {0: 1, 1: 1, 2: 1, 3: 2, None: 3}
    logs = {r["bin"]: r["n"] for r in stats.histogram(df, "x", 2, log10=True).collect()}
    assert logs[None] == 5 and sum(logs.values()) == 8
    assert stats.histogram(df.limit(0), "x").collect() == []


def test_profile_reads_its_rows_once(spark):
    rows = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet").withColumn("cluster", F.col("l_quantity") > 25)
    prof = segment.cluster_profile(rows, "cluster", ["l_tax"], "l_extendedprice", {"l_returnflag": "mode"}, cluster_bound=2)
    prof.collect()
    plan = prof._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    scans = [x for x in plan.splitlines() if "FileScan parquet" in x]
    assert "ReusedExchange" in plan and len(scans) == 1, plan


def test_layout_of_fits_follows_the_rows_alone(spark):
    rows = spark.range(5000).select((F.col("id") % 3).alias("key"), (F.col("id") * 7 % 1000 / 10.0).alias("x"), F.lit(None).cast("double").alias("y"))

    def laid_out(df):
        parts = segment.fit_input(df, ["key"], ["x", "y"]).withColumn("part", F.spark_partition_id())
        return [tuple(r) for r in parts.collect()]
    a, b = laid_out(rows), laid_out(rows.repartition(7).orderBy(F.desc("x")))
    assert a == b and len({r[-1] for r in a}) == segment.fit_partitions(5000) == 3
    assert [segment.fit_partitions(n) for n in (0, 1, 10**6, 10**11)] == [1, 1, 32, 9883]


def test_profile_of_odd_clusters(spark):
    """NULL cluster, ties of a mode, codes and values that are NULL, names that clash."""
    df = spark.createDataFrame([(1, 2.0, "b", 1.0), (1, 4.0, "a", 3.0), (1, None, None, None), (None, None, None, 5.0), (None, None, "z", None)],
                               "_set int, _v double, n_code string, n double")
    got = segment.cluster_profile(df, "_set", ["n", "_v"], "_v", {"n_code": "mode"}).collect()
    assert sorted((tuple(r) for r in got), key=str) == [(1, 3, 2.0, 3.0, 2.0, "a"), (None, 2, 5.0, None, None, "z")]
    empty = segment.cluster_profile(df.limit(0), "_set", ["n"], "_v", {"n_code": "mode"})
    assert empty.collect() == []


def test_nearest_equals_the_fitted_model(spark):
    li = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet")
    columns = ["l_quantity", "l_discount", "l_tax"]
    model, scored = segment.fit_segments(li, columns, k=4)
    numbers = segment.canonical_cluster_map(model.stages[-1])
    both = model.transform(scored).select("cluster", "_cluster").collect()
    assert all(r["cluster"] == numbers[r["_cluster"]] for r in both) and len({r["cluster"] for r in both}) == 4


def test_kmeans_costs_do_not_depend_on_cores():
    script = """
import json, sys
from panelspark.session import get_session
from panelspark.operators import segment
from panelspark.plans import standin as S
spark = get_session(f"local[{sys.argv[1]}]", shuffle_partitions=3)
table, _ = segment.scaled_sweep(S.table(spark, sys.argv[2], "lineitem"), ["l_quantity", "l_discount", "l_tax"], ks=(3, 4),
                                keys=["l_orderkey", "l_linenumber", "l_partkey"])
print("costs " + json.dumps([[r["silhouette"], r["wssse"]] for r in table.orderBy("k").collect()]))
"""
    runs = []
    for cores in ("2", "4"):
        done = subprocess.run([sys.executable, "-c", script, cores, SF_SMALL], capture_output=True, text=True, timeout=300,
                              cwd=os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
        assert done.returncode == 0, done.stderr[-2000:]
        runs.append(json.loads(next(x for x in done.stdout.splitlines() if x.startswith("costs "))[6:]))
    assert [x for r in runs[0] for x in r] == pytest.approx([x for r in runs[1] for x in r], rel=1e-11)
