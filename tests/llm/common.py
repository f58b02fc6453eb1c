"""Fixtures shared by the operators' tests: odd documents, and the DuckDB comparison."""
import duckdb

from tests.test_registry import TABLES, _digest

SF = "/root/testdata/sf0.001"
DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def frame(spark, texts, first=0, extra=""):
    """documents rows from texts; ``extra`` adds columns whose names clash with outputs."""
    rows = [(first + k, t, None, None, None) for k, t in enumerate(texts)]
    df = spark.createDataFrame(rows, DOC_SCHEMA)
    for name in extra.split():
        df = df.selectExpr("*", f"'x' AS `{name}`")
    return df


ODD = [None, "", " ", "\n\n", "a", "a a a a a a a a", "é" * 40, "word " * 3000, "x" * 20000, "Ünïcödé テスト 数字 ١٢٣ \x00 end",
       "tab\tand\rcr\x0bvt", "a@b.c", "....", "same text twice over here now", "same text twice over here now"]


def same_as_sql(spark, query, sql, sf=SF):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    df = query(spark, sf)
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    want = cur.fetchall()
    got = [tuple(r) for r in df.collect()]
    assert sorted(df.columns) == sorted(names)
    assert len(got) == len(want)
    assert _digest(df.columns, got) == _digest(names, want)
