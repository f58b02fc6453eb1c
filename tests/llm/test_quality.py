import random
import re

from panelspark.llm import catalog, quality
from tests.llm.common import ODD, SF, frame

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    w = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    seen, dup = set(), 0
    for x in lines:
        dup += x in seen
        seen.add(x)
    windows = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
    inside = {k for i, x in enumerate(windows) if windows.count(x) > 1 for k in range(i, i + 3)} if len(w) < 400 else None
    if inside is None:
        many = {}
        for i, x in enumerate(windows):
            many.setdefault(x, []).append(i)
        inside = {k for at in many.values() if len(at) > 1 for i in at for k in range(i, i + 3)}
    failed = len(w) < 50 or 100 * len(inside) > 50 * len(w)
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), dup, len(inside), failed


def base(r):
    return r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"]


def test_query_against_brute_force(spark):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = catalog.op7_quality_rules(spark, SF).collect()
    assert len(rows) == len(docs)
    for r in rows:
        assert base(r) == brute(docs[r["doc_id"]])
        assert r["kept"] == (not r["base_failed"] and r["probability"] >= quality.MIN_PROBABILITY)


def test_verdicts_follow_the_labels(spark):
    sf = "/root/testdata/sf0.01"
    rows = catalog.op7_quality_rules(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").collect()
    right = sum((r["probability"] >= 0.5) == (r["quality"] == 1) for r in rows)
    assert right / len(rows) > 0.95
    # calibrated: the mean probability is near the share of good rows
    assert abs(sum(r["probability"] for r in rows) / len(rows) - sum(r["quality"] for r in rows) / len(rows)) < 0.05


def test_odd_texts(spark):
    rng = random.Random(2)
    texts = [*ODD, "a b\n\na b\r\na b\n a b\na b", "a\x0bb\x0cc " * 20, "é|<é>\n" * 30,
             *("".join(rng.choices("ab \n#", k=300)) for _ in range(30))]
    model = quality.Model(*[__import__("numpy").zeros(0, "i8")] * 2)
    rows = quality.scan(frame(spark, texts, extra="kept n_words"), model).collect()
    for r in rows:
        assert base(r) == brute(texts[r["row"]["doc_id"]])
        assert r["probability"] == 0.5 and r["kept"] != r["base_failed"]
    assert quality.scan(frame(spark, []), model).collect() == []


def test_labels_missing_or_of_one_class(spark):
    docs = frame(spark, ODD)
    for rows in ([], [(0, 1), (1, 1), (None, 0), (2, None)]):
        model = quality.train(docs, spark.createDataFrame(rows, "doc_id long, quality int"))
        assert {r["probability"] for r in quality.scan(docs, model).collect()} == {0.5}
