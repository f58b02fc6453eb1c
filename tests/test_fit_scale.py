"""Fits that must keep up with larger tables: blocks instead of single rows, one
layout for several models."""

import datetime

import pytest

from panelspark.operators import regress, segment
from panelspark.plans import catalog


@pytest.fixture(scope="module")
def sf_dir(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("fit-scale"))
    rows = [(k, k % 40, k % 10, k % 4 + 1, float(k % 23 + 1), 900.0 + 7 * (k % 101), k % 7 / 100, k % 5 / 100,
             "ANR"[k % 3], "FO"[k % 2], datetime.datetime(1995 + k % 8, 3, 1)) for k in range(600)]
    spark.createDataFrame(rows, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, "
                          "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
                          "l_linestatus string, l_shipdate timestamp_ntz").write.parquet(f"{folder}/lineitem.parquet")
    return folder


def test_sweep_fits_over_blocks_of_rows(spark, sf_dir):
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    table, models = segment.scaled_sweep(lines, ["l_quantity", "l_tax"], ks=(2, 3), keys=["l_orderkey"])
    assert {m.getSolver() for m in models.values()} == {"block"}
    assert sum(r["chosen"] for r in table.collect()) == 1


def test_frozen_models_share_one_layout(spark, sf_dir, monkeypatch):
    calls = []

    def counted(*args, **kwargs):
        calls.append(args)
        return segment.fit_input(*args, **kwargs)
    monkeypatch.setattr(regress, "fit_input", counted)
    train, _, _, mean, models = catalog._frozen(spark, sf_dir)
    assert len(calls) == 1 and [name for name, _ in models] == ["linear", "forest"]
    expected = train.toPandas()["l_extendedprice"].mean()
    assert spark.range(1).select(mean).first()[0] == pytest.approx(expected, rel=1e-12)


def test_forests_keep_node_ids_where_they_fit(spark, sf_dir):
    spec = regress.FeatureSpec(numeric=("l_quantity", "l_discount"), label="l_extendedprice")
    train = segment.fit_input(spark.read.parquet(f"{sf_dir}/lineitem.parquet"), ["l_orderkey"])
    swept = regress.forest_sweep(train, train, spec, configs=((3, 5),)).best_model
    assert swept.stages[-1].getCacheNodeIds()
    walked = regress.fit_pipeline(regress.forest_pipeline(spec, 3, 5), train, spec)
    assert not walked.stages[-1].getCacheNodeIds()
    trees = [[line for line in m.stages[-1].toDebugString.splitlines()[1:]] for m in (swept, walked)]
    assert trees[0] == trees[1]
    assert regress.node_ids_fit(spark, 10 ** 5, 100) and not regress.node_ids_fit(spark, 10 ** 9, 100)
