import random

import numpy as np
import pyarrow as pa
import pytest

from panelspark.llm import oddsketch
from tests.llm.common import ODD, frame
from tests.llm.test_jaccard import corpus, sets


def brute(texts, ids=None):
    s = [sets(t, 2) for t in texts]
    n = len(texts)
    ids = list(range(n)) if ids is None else ids
    near = [[j for j in range(n) if s[i] and s[j] and 100 * len(s[i] & s[j]) >= 80 * len(s[i] | s[j])] for i in range(n)]
    root = list(range(n))
    for _ in range(n):
        root = [min([root[i], *(root[j] for j in near[i])]) for i in range(n)]
    low = {r: min((ids[k] for k in range(n) if root[k] == r and ids[k] is not None), default=None) for r in set(root)}
    return sorted([(ids[k], len(s[k]), low[root[k]], ids[k] == low[root[k]]) for k in range(n)], key=str)


def result(docs):
    return sorted((tuple(r) for r in oddsketch.dedup(docs).collect()), key=str)


@pytest.mark.parametrize("salt, size", [(512, 4 << 20), (2, 500)])
def test_against_brute_force(spark, monkeypatch, salt, size):
    monkeypatch.setattr(oddsketch, "SALT_PAIRS", salt)
    monkeypatch.setattr(oddsketch, "BUNDLE_BYTES", size)
    texts = corpus() + ODD
    assert result(frame(spark, texts, extra="key band u root size bundle")) == brute(texts)


def test_chains_and_large_groups(spark):
    """A group of copies with one word each of their own, and a chain in which
    only neighbours are near."""
    rng = random.Random(4)
    words = [f"w{k}" for k in range(60)]
    base = rng.choices(words, k=60)
    texts = [" ".join(base[:k % 60] + [f"own{k}"] + base[k % 60 + 1:]) for k in range(150)]
    chain = [f"c{k}" for k in range(130)]
    texts += [" ".join(chain[4 * k:4 * k + 60]) for k in range(16)]
    long = [f"l{rng.randrange(10 ** 6)}" for _ in range(2200)]
    texts += [" ".join(long[40 * k:40 * k + 1100 + 9 * k]) for k in range(12)]
    want = brute(texts)
    assert len({r[2] for r in want}) < 6
    assert result(frame(spark, texts)) == want


def test_repeated_and_null_ids(spark):
    ids = [1, 1, 2, None, None, 3, 3, None, 4]
    texts = ["a b c d e f", "a b c d e f", "A B c d e f g", "other words here", "other words here", None, "", "  ", "one"]
    docs = spark.createDataFrame(list(zip(ids, texts)), "doc_id long, text string")
    got, want = result(docs), brute(texts, ids)
    assert got == want


def test_empty_table(spark):
    assert result(frame(spark, [])) == []
    assert result(frame(spark, ["", None])) == [(0, 0, 0, True), (1, 0, 1, True)]


def test_counts_stay_under_the_limit():
    """Sketches of sets of many sizes that differ by known numbers of shingles."""
    rng = np.random.default_rng(3)
    for size, gone, fresh in ((30, 3, 4), (500, 60, 40), (3000, 300, 300), (9000, 1800, 0)):
        pool = rng.integers(0, 1 << 63, size + fresh, dtype=np.uint64)
        sets_ = [np.sort(pool[:size]), np.sort(pool[gone:])]
        row = np.repeat([0, 1], [len(s) for s in sets_])
        level, sketch = oddsketch.sketches(row, np.concatenate(sets_), np.bincount(row))
        assert level.tolist() == [max(0, int(np.ceil(np.log2(len(s) / 512)))) for s in sets_]
        if level[0] == level[1]:
            count = sum(bin(int(x) & (1 << 64) - 1).count("1") for x in sketch[0] ^ sketch[1])
            assert count <= (gone + fresh if level[0] == 0 else oddsketch.most(gone + fresh, int(level[0])))
            assert count >= 0.6 * (gone + fresh) / 2 ** int(level[0])


def test_sets_are_told_apart_by_bytes():
    """Two words of 2,048 bytes whose polynomial hashes modulo 2 ** 64 are equal."""
    morse = [bin(k).count("1") % 2 for k in range(2048)]
    first, second = "".join("ab"[b] for b in morse), "".join("ba"[b] for b in morse)
    a, b, c = oddsketch.exact_sets(pa.array([f"x {first} y", f"x {second} y", f"X {first}  y"]), 2)
    assert not np.intersect1d(a, b).size and np.array_equal(a, c)


def test_last_round_meets_few_pairs(spark, monkeypatch):
    """A family of texts of similarity 0.72, none linked: the sketches of samples
    leave their pairs, the wide ones do not; and no pair is met once for each band."""
    rng = random.Random(7)
    base = [f"w{k}" for k in range(1200)]
    texts = []
    for k in range(24):
        words = list(base)
        for at in rng.sample(range(1200), 49):
            words[at] = f"own{k}_{at}"
        texts.append(" ".join(words))
    met, crossing = [], oddsketch.crossing

    def noted(placed, percent):
        placed = placed.cache()
        coarse = placed.alias("x").join(placed.alias("y"), "band").where("x.key < y.key")
        met.append(coarse.select("x.key", "y.key", "x.about", "y.about").toDF("u", "v", "au", "av")
                   .where(oddsketch._close("au", "av", percent)).count())
        met.append(crossing(placed, percent).count())
        return crossing(placed, percent)

    monkeypatch.setattr(oddsketch, "crossing", noted)
    texts += [texts[0] + " and a tail"]
    assert result(frame(spark, texts)) == brute(texts)
    assert met[0] > 1000 and met[1] < 20
