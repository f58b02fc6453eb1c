"""Memory of the ingest: micro-batches bounded in bytes, no shuffle by file."""

from panelspark.session import shared_dir
from panelspark.sources.manifest import Listing, manifest_frame
from panelspark.streaming.ingest import ingest_available, period_stream


def test_batches_are_bounded_and_files_are_not_gathered_in_one_task(spark, tmp_path, capsys):
    landing = str(tmp_path / "landing")
    for k in (1, 2, 3):
        spark.range(10 * k, 10 * k + 5).selectExpr("id AS ID").coalesce(1).write.parquet(f"{landing}/source_file=f{k}")
    man = manifest_frame(spark, [Listing(f"f{k}", {"period": f"P{k}"}, 5) for k in (1, 2)])
    schema = spark.createDataFrame([], "ID long, source_file string").schema
    stream = period_stream(spark, landing, {"id": "ID"}, man, schema=schema, source_col="source_file", max_bytes_per_trigger=1)
    out = shared_dir(spark, "bounded-out", unique=True)
    query = ingest_available(stream, out, shared_dir(spark, "bounded-ckpt", unique=True))
    assert [p["numInputRows"] for p in query.recentProgress if p["numInputRows"]] == [5, 5, 5]
    query.explain()
    plan = capsys.readouterr().out
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    rows = sorted((r["id"], r["source_file"], r["period"]) for r in spark.read.parquet(out).collect())
    assert rows == [(10 * k + i, f"f{k}", f"P{k}" if k < 3 else None) for k in (1, 2, 3) for i in range(5)]
