import random
import re

from panelspark.llm import decontam
from tests.llm.common import ODD, frame

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(text, items, window):
    w, hit, found = words(text), set(), set()
    for name, item in items:
        v = words(item)
        n = min(window, len(v))
        for k in range(len(v) - n + 1 if n else 0):
            for i in range(len(w) - n + 1):
                if w[i:i + n] == v[k:k + n]:
                    hit |= set(range(i, i + n))
                    found.add(str(name))
    return len(w), len(hit), sorted(found), bool(hit) and 20 * len(hit) >= len(w)


def compare(spark, texts, items, window, **options):
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = decontam.scan(frame(spark, texts, extra="n_words items spans"), bench, window, **options).collect()
    assert len(got) == len(texts)
    for r in got:
        text = texts[r["row"]["doc_id"]]
        named = [(k, t) for k, t in items if k is not None]
        n, h, found, bad = brute(text, items, window)
        assert (r["n_words"], r["n_hit"], r["contaminated"]) == (n, h, bad)
        assert r["items"] == brute(text, named, window)[2]
        left = decontam.without_spans(text, r["bytes"])
        assert not r["n_hit"] or len(words(left)) == n - h


def test_random_against_brute_force(spark):
    rng = random.Random(7)
    say = lambda n: " ".join(rng.choices(["a", "b", "C", "é", "d1"], k=n))
    items = [(k, say(rng.randint(0, 9))) for k in range(14)] + [(3, say(4)), (None, "a b c")]
    texts = [say(rng.randint(0, 60)) for _ in range(60)] + ["A.b,c;a b C"] * 3
    for options in ({}, {"block_words": 10}):
        compare(spark, texts, items, 4, **options)


def test_odd_texts_and_empty_benchmark(spark):
    items = [(1, "same text twice over here"), (2, None), (3, ""), (4, "テスト"), (5, "word " * 20), (5, "a a a")]
    compare(spark, ODD, items, decontam.WINDOW)
    empty = spark.createDataFrame([], "item_id long, text string")
    assert all(r["n_hit"] == 0 and not r["contaminated"] for r in decontam.scan(frame(spark, ODD), empty).collect())
    assert decontam.scan(frame(spark, []), empty).collect() == []
