from tests.conftest import plan_text
import os

import pytest
from pyspark.sql import functions as F

from panelspark.operators.harmonise import harmonise, tenure
from panelspark.session import shared_dir
from panelspark.sources import manifest as M
from panelspark.sources import scan, store


def _write(path, text):
    with open(path, "w", encoding="utf-8") as fh:
        fh.write(text)


def test_scan_by_header_not_position(spark, tmp_dir):
    # Q1: header "b,a"; a by-position read with schema (a, b) would swap values.
    p = os.path.join(tmp_dir, "swapped.csv")
    _write(p, "b,a\n2,1\n4,3\n")
    out = scan.scan_by_name(spark, p, {"a": "a", "b": "b"}, fmt="csv").orderBy("a").collect()
    assert [(r["a"], r["b"]) for r in out] == [("1", "2"), ("3", "4")]


def test_quoted_csv_with_doubled_quotes(spark, tmp_dir):
    # Q2: a value holding '"' and ',' must not shift columns.
    p = os.path.join(tmp_dir, "quoted.csv")
    _write(p, 'id,text,n\n1,"say ""hi"", then go",5\n')
    row = scan.scan_by_name(spark, p, {"id": "id", "text": "text", "n": "n"}, fmt="csv").first()
    assert (row["id"], row["text"], row["n"]) == ("1", 'say "hi", then go', "5")


def test_required_columns(spark, tmp_dir):
    p = os.path.join(tmp_dir, "few.csv")
    _write(p, "a\n1\n")
    with pytest.raises(KeyError, match=r"\['b'\]"):
        scan.scan_by_name(spark, p, {"a": "a", "b": "b"}, fmt="csv")


def test_scan_periods_union_and_audit(spark, tmp_dir):
    _write(os.path.join(tmp_dir, "t1.csv"), "ID,X,EXTRA\n1, 5 ,z\n2,,z\n")
    _write(os.path.join(tmp_dir, "t2.csv"), "X,ID\n7,3\n")
    files = [M.Listing("t1.csv", {"period": "2025T1", "quarter": 1}, 2), M.Listing("t2.csv", {"period": "2025T2", "quarter": 2}, 2)]
    data = scan.scan_periods(spark, tmp_dir, files, {"id": "ID", "x": "X"})
    typed = harmonise(data, measures=["x"], codes=["id"])
    got = sorted((r["period"], r["id"], r["x"]) for r in typed.collect())
    assert got == [("2025T1", "1", 5.0), ("2025T1", "2", None), ("2025T2", "3", 7.0)]
    man = M.manifest_frame(spark, files)
    audit = {r["period"]: r["ok"] for r in M.row_audit(typed, man).collect()}
    assert audit == {"2025T1": True, "2025T2": False}
    with pytest.raises(ValueError):
        M.assert_row_counts(M.row_audit(typed, man))
    listing = M.file_listing(spark, os.path.join(tmp_dir, "*.csv"))
    files.append(M.Listing("t3.csv", {"period": "2026T1", "quarter": 1}, 1))
    missing = [r["file_name"] for r in M.missing_files(M.manifest_frame(spark, files), listing).collect()]
    assert missing == ["t3.csv"]
    with pytest.raises(FileNotFoundError, match="t3.csv"):
        M.require_no_missing(M.missing_files(M.manifest_frame(spark, files), listing))


def test_tenure_propagates_null(spark):
    df = spark.createDataFrame([(2.0, 6.0), (None, 1.0), (1.0, None)], "y double, m double")
    out = [r[0] for r in df.select(tenure("y", "m")).collect()]
    assert out == [2.5, None, None]


def test_read_or_build_and_partition_pruning(spark):
    path = shared_dir(spark, "test-store", unique=True)
    calls = []

    def build():
        calls.append(1)
        return spark.range(10).withColumn("role", F.when(F.col("id") < 7, "dev").otherwise("holdout"))
    a = store.read_or_build(spark, path, build, partition_by=["role"])
    b = store.read_or_build(spark, path, build, partition_by=["role"])
    assert len(calls) == 1 and a.count() == b.count() == 10
    hold = spark.read.parquet(path).where(F.col("role") == "holdout")
    plan = plan_text(hold)
    assert "PartitionFilters" in plan and hold.count() == 3


def test_write_counted_and_shared_dir(spark):
    path = shared_dir(spark, "counted", unique=True)
    assert path.startswith(spark.sparkContext.getCheckpointDir().rstrip("/")) or \
        path.startswith(spark.conf.get("spark.checkpoint.dir", ""))
    assert store.write_parquet_counted(spark.range(25), path, expected_rows=25) == 25
    with pytest.raises(ValueError):
        store.write_parquet_counted(spark.range(3), shared_dir(spark, "counted", unique=True), expected_rows=4)


def test_audit_accounts_for_every_row(spark):
    files = [M.Listing("a", {"period": "1", "quarter": 0}, 2), M.Listing("b", {"period": "2", "quarter": 0}, 5), M.Listing("c", {"period": "3", "quarter": 0}, 1),
             M.Listing("d", {"period": "4", "quarter": 0}, None)]
    loaded = spark.createDataFrame([(p,) for p in ["1", "1", "2", "9", "9", None, None, None, "4"]], "period string")
    audit = M.row_audit(loaded, M.manifest_frame(spark, files))
    got = {r["period"]: (r["file_name"], r["expected_rows"], r["rows"], r["status"], r["ok"]) for r in audit.collect()}
    assert got == {"1": ("a", 2, 2, "matched", True), "2": ("b", 5, 1, "differs", False), "3": ("c", 1, 0, "missing", False),
                   "4": ("d", None, 1, "unchecked", False), "9": (None, None, 2, "unlisted", False),
                   None: (None, None, 3, "unlisted", False)}
    assert sum(r["rows"] for r in audit.collect()) == loaded.count()
    with pytest.raises(ValueError, match="None"):
        M.assert_row_counts(audit)


def test_audit_of_empty_sides(spark):
    files = [M.Listing("a", {"period": "1", "quarter": 0}, 0)]
    none = spark.createDataFrame([], "period string")
    assert [tuple(r) for r in M.row_audit(none, M.manifest_frame(spark, files)).collect()] == [("1", "a", 0, 0, "matched", True)]
    assert M.row_audit(none, M.manifest_frame(spark, [])).collect() == []


def test_repeated_header_takes_the_first(spark, tmp_dir):
    _write(os.path.join(tmp_dir, "r.csv"), 'ID,X,id,"X",\n1,5,8,6,z\n2,"a ""q""",9,7,\n')
    path = os.path.join(tmp_dir, "r.csv")
    assert scan.source_header(spark, path) == ["ID", "X", "id", "X", ""]
    got = scan.scan_by_name(spark, path, {"key": "ID", "value": "X"}, fmt="csv").collect()
    assert [tuple(r) for r in got] == [("1", "5"), ("2", 'a "q"')]
    assert scan.read_table(spark, path, "csv").columns == ["ID", "X", "id#2", "X#3", "#4"]


def test_column_counts_are_each_files_own(spark, tmp_dir):
    _write(os.path.join(tmp_dir, "t1.csv"), "ID,X,EXTRA\n1,5,z\n")
    _write(os.path.join(tmp_dir, "t2.csv"), "X,ID,X,Y,Z\n7,3,1,1,1\n")
    files = [M.Listing("t1.csv", {"period": "1", "quarter": 1}), M.Listing("t2.csv", {"period": "2", "quarter": 1})]
    counts = scan.column_counts(spark, tmp_dir, files)
    assert sorted(tuple(r) for r in counts.collect()) == [("1", 3, 3), ("2", 5, 4)]
    data = scan.scan_periods(spark, tmp_dir, files, {"id": "ID", "x": "X"})
    assert sorted((r["period"], r["id"], r["x"]) for r in data.collect()) == [("1", "1", "5"), ("2", "3", "7")]
    assert {r["columns"] for r in M.row_audit(data, M.manifest_frame(spark, files), counts).collect()} == {3, 5}


def test_manifest_takes_any_attributes(spark):
    files = [M.Listing("a", {"period": "1", "region": "north"}, 3), M.Listing("b", {"period": "2", "year": 2001, "region": None})]
    man = M.manifest_frame(spark, files)
    assert man.dtypes == [("file_name", "string"), ("expected_rows", "bigint"), ("period", "string"), ("region", "string"), ("year", "int")]
    assert [tuple(r) for r in man.orderBy("file_name").collect()] == [("a", 3, "1", "north", None), ("b", None, "2", None, 2001)]
    assert M.partition_attributes(man) == ["period", "region", "year"]
    assert M.manifest_frame(spark, []).columns == ["file_name", "expected_rows", "period"]
