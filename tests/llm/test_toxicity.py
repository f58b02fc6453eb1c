import zlib

import numpy as np
from pyspark.sql import functions as F

from panelspark.llm import catalog, toxicity
from tests.llm.common import ODD, SF, frame


def test_ftrl_learns_a_word_and_stays_sparse():
    rng = np.random.default_rng(0)
    rows = [(np.unique(np.append(rng.integers(10, 900, 30), [5] if k % 3 == 0 else [6])), int(k % 3 == 0)) for k in range(600)]
    place, weight = toxicity.ftrl(rows, 10)
    w = dict(zip(place.tolist(), weight.tolist()))
    assert w[5] > 1 and len(place) < 300  # of 890 features


def test_held_out_quarter(spark):
    ids = list(range(200)) + [None]
    got = spark.createDataFrame([(i,) for i in ids], "doc_id long").select("doc_id", toxicity.held_out(F.col("doc_id")).alias("h")).collect()
    for r in got:
        assert r["h"] == (r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2)


def test_query(spark):
    sf = "/root/testdata/sf0.01"
    df = catalog.op3_toxicity(spark, sf)
    assert df.dtypes[:4] == [("doc_id", "bigint"), ("held_out", "boolean"), ("score", "double"), ("predicted", "int")]
    rows = df.join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").where("held_out").collect()
    toxic = [r["score"] for r in rows if r["toxic"] == 1]
    clean = [r["score"] for r in rows if r["toxic"] == 0]
    better = sum((t > c) + 0.5 * (t == c) for t in toxic for c in clean) / (len(toxic) * len(clean))
    assert better > 0.7
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in rows)


def test_held_out_labels_are_not_learned(spark):
    """Other labels of the held-out quarter change no score."""
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    learn = ~toxicity.held_out(F.col("doc_id"))
    turned = labels.withColumn("toxic", F.when(toxicity.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = toxicity.train(docs, labels, learn), toxicity.train(docs, turned, learn)
    assert np.array_equal(a[0], b[0]) and np.array_equal(a[1], b[1])


def test_odd_documents_and_empty_tables(spark):
    labels = spark.createDataFrame([(0, 1, 0), (1, 1, 0), (1, 1, 1), (None, 1, 1), (2, None, None), (13, 0, 1), (14, 0, 0)],
                                   "doc_id long, quality int, toxic int")
    docs = frame(spark, ODD, extra="score label pick")
    model = toxicity.train(docs, labels)
    rows = toxicity.score(docs, model).collect()
    assert len(rows) == len(ODD) and all(0 <= r["score"] <= 1 for r in rows)
    assert len({r["score"] for r in rows if not (r["row"]["text"] or "").strip()}) == 1
    none = toxicity.train(docs, labels.limit(0))
    assert {r["score"] for r in toxicity.score(docs, none).collect()} == {0.5}
    assert toxicity.score(frame(spark, []), none).collect() == []


def test_sample_is_bounded_and_whole_below_the_bound(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    n = labels.count()
    assert toxicity.sample(docs, labels, "toxic", None, n).count() == n
    assert 0 < toxicity.sample(docs, labels, "toxic", None, n // 2).count() < n
