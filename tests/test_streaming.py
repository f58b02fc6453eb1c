import os

from pyspark.sql import functions as F

from panelspark.session import shared_dir
from panelspark.sources.manifest import Listing, manifest_frame
from panelspark.streaming.ingest import ingest_available, period_stream

COLUMN_MAP = {"id": "ID", "pay": "PAY", "code": "CODE"}


def _land(spark, landing, name, rows, order):
    df = spark.createDataFrame(rows, "ID string, PAY string, CODE string, EXTRA string").select(*order)
    tmp = os.path.join(landing, "_tmp_" + name)
    df.coalesce(1).write.mode("overwrite").parquet(tmp)
    part = [f for f in os.listdir(tmp) if f.endswith(".parquet")][0]
    os.rename(os.path.join(tmp, part), os.path.join(landing, name))


def test_stream_ingests_each_file_once_by_name(spark, tmp_path):
    landing = str(tmp_path / "landing")
    os.makedirs(landing)
    out = shared_dir(spark, "stream-out", unique=True)
    ckpt = shared_dir(spark, "stream-ckpt", unique=True)
    files = [Listing("p1.parquet", {"period": "2025T1", "quarter": 1}, 2), Listing("p2.parquet", {"period": "2025T2", "quarter": 2}, 1)]
    man = manifest_frame(spark, files)
    _land(spark, landing, "p1.parquet", [("1", " 100 ", "a", "x"), ("2", "n/a", " ", "x")],
          ["ID", "PAY", "CODE", "EXTRA"])
    ingest_available(period_stream(spark, landing, COLUMN_MAP, man, measures=["pay"], codes=["code"]), out, ckpt)
    first = spark.read.parquet(out)
    assert sorted((r["id"], r["pay"], r["code"], r["period"]) for r in first.collect()) == [
        ("1", 100.0, "a", "2025T1"), ("2", None, None, "2025T1")]
    # A later file with its columns in another order: only it is ingested.
    _land(spark, landing, "p2.parquet", [("3", "7", "b", "y")], ["CODE", "EXTRA", "PAY", "ID"])
    ingest_available(period_stream(spark, landing, COLUMN_MAP, man, measures=["pay"], codes=["code"]), out, ckpt)
    both = spark.read.parquet(out)
    assert both.count() == 3
    assert both.where(F.col("period") == "2025T2").select("id", "pay", "code").first() == ("3", 7.0, "b")
