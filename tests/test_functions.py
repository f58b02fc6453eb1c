import duckdb
from pyspark.sql import functions as F

from panelspark.functions import (clean_code_text, fingerprint, hash_percent, is_finite, is_integer_between,
                                  is_missing, labelled_code, to_double, value_band)


def test_to_double_and_finite(spark):
    rows = [("1",), (" 12 ",), ("n/a",), ("",), (None,), ("nan",), ("inf",), ("-Infinity",), ("3.5",)]
    df = spark.createDataFrame(rows, "s string").select("s", to_double("s").alias("v"))
    out = {r["s"]: r["v"] for r in df.collect()}
    assert out["1"] == 1.0 and out[" 12 "] == 12.0 and out["3.5"] == 3.5
    assert out["n/a"] is None and out[""] is None and out[None] is None
    fin = {r["s"]: r["f"] for r in df.select("s", is_finite("v").alias("f")).collect()}
    assert fin["1"] and fin["3.5"]
    assert not fin["nan"] and not fin["inf"] and not fin["-Infinity"] and not fin["n/a"]


def test_clean_code_text(spark):
    rows = [(" 3 ",), ("3.0",), ("3.00",), ("",), ("  ",), (None,), ("abc",), ("3.5",), ("-2.0",)]
    df = spark.createDataFrame(rows, "s string").select("s", clean_code_text("s").alias("c"))
    out = {r["s"]: r["c"] for r in df.collect()}
    assert out[" 3 "] == "3" and out["3.0"] == "3" and out["3.00"] == "3" and out["-2.0"] == "-2"
    assert out[""] is None and out["  "] is None and out[None] is None
    assert out["abc"] == "abc" and out["3.5"] == "3.5"


def test_missing_rule_counts_nan_text_as_present(spark):
    # Q4: the text 'nan' is not missing for the audit, yet it is not finite.
    df = spark.createDataFrame([("nan",), ("",), (None,), ("1",)], "s string")
    got = df.select(F.count_if(is_missing("s"))).first()[0]
    assert got == 2


def test_labelled_code_unknowns(spark):
    df = spark.createDataFrame([("1",), ("9",), (None,)], "c string")
    code, label = labelled_code("c", {"1": "One"})
    out = sorted((r[0], r[1]) for r in df.select(code, label).collect())
    assert out == [("1", "One"), ("DESCONOCIDO", "Desconocido"), ("DESCONOCIDO", "Desconocido")]


def test_fingerprint_length_prefix_avoids_collision(spark):
    # With a plain separator join these two rows would collide.
    df = spark.createDataFrame([("a§b", "c"), ("a", "b§c")], "x string, y string")
    fps = [r[0] for r in df.select(fingerprint(["x", "y"])).collect()]
    assert fps[0] != fps[1]
    plain = [r[0] for r in df.select(fingerprint(["x", "y"], length_prefix=False)).collect()]
    assert plain[0] == plain[1]


def test_fingerprint_null_marker(spark):
    df = spark.createDataFrame([(None, "x"), ("<NULL>", "x")], "a string, b string")
    fps = [r[0] for r in df.select(fingerprint(["a", "b"])).collect()]
    assert fps[0] != fps[1]


def test_hash_percent_matches_duckdb(spark):
    rows = [(i, f"k{i}") for i in range(200)]
    df = spark.createDataFrame(rows, "a long, b string")
    got = {r[0]: r[1] for r in df.select("a", hash_percent(["a", "b"], "42")).collect()}
    con = duckdb.connect()
    con.execute("CREATE TABLE t(a BIGINT, b VARCHAR)")
    con.executemany("INSERT INTO t VALUES (?, ?)", rows)
    exp = dict(con.execute("SELECT a, ('0x' || substr(md5(concat_ws('|', CAST(a AS VARCHAR), b, '42')), 1, 7))"
                           "::BIGINT % 100 FROM t").fetchall())
    assert got == exp


def test_value_band(spark):
    df = spark.createDataFrame([(1.0,), (5.0,), (9.0,), (20.0,)], "x double")
    out = [r[0] for r in df.select(value_band("x", [5.0, 10.0], ["lo", "mid", "hi"])).collect()]
    assert out == ["lo", "lo", "mid", "hi"]


def test_is_integer_between_matches_long_form(spark):
    vals = [0.0, 1.0, 11.0, 12.0, -1.0, 3.5, float("nan"), float("inf"), float("-inf"), None, 5.0]
    df = spark.createDataFrame([(v,) for v in vals], "m double")
    short = [r[0] for r in df.select(is_integer_between("m", 0, 11)).collect()]
    long_ = [r[0] for r in df.selectExpr("coalesce(m IN (0D,1D,2D,3D,4D,5D,6D,7D,8D,9D,10D,11D), false)").collect()]
    assert short == long_ == [True, True, True, False, False, False, False, False, False, False, True]


def test_all_white_space_is_trimmed(spark):
    rows = [(t,) for t in ["\t3.0\n", "\u00a07\u2003", "\u3000 \r\n", "a\u00a0b", " x\ty ", "", None]]
    df = spark.createDataFrame(rows, "t string")
    assert [r[0] for r in df.select(clean_code_text("t")).collect()] == ["3", "7", None, "a\u00a0b", "x\ty", None, None]
