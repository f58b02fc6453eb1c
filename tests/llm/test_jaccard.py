import random

import pytest

from panelspark.llm import jaccard
from panelspark.llm import textkit as K
from panelspark.llm.components import components
from tests.llm.common import ODD, frame


def sets(text, width=5):
    w = "".join(c.lower() if c.isascii() else c for c in text or "").replace("\x0b", " ").replace("\x0c", " ")
    w = [x for x in w.replace("\t", " ").replace("\n", " ").replace("\r", " ").split(" ") if x]
    return {tuple(w[i:i + width]) for i in range(max(1, len(w) - width + 1))} if w else set()


def brute(texts):
    s = [sets(t) for t in texts]
    n = len(texts)
    near = [[j for j in range(n) if i != j and s[i] and s[j] and 10 * len(s[i] & s[j]) >= 8 * len(s[i] | s[j])] for i in range(n)]
    root = list(range(n))
    for _ in range(n):
        root = [min([root[i], *(root[j] for j in near[i])]) for i in range(n)]
    return {i: (root[i], len(near[i])) for i in range(n)}


def corpus(seed=3):
    rng = random.Random(seed)
    words = [f"w{k}" for k in range(300)]
    texts = []
    for size in (1, 3, 5, 12, 40, 90, 90, 200):
        first = rng.choices(words, k=size)
        for _ in range(9):
            copy = list(first)
            for _ in range(rng.choice([0, 0, 1, 1, 2, 5])):
                copy[rng.randrange(size)] = rng.choice(words)
            texts.append(" ".join(copy))
    return texts + [texts[-1].upper()] * 3


@pytest.mark.parametrize("members", [256, 4])
def test_against_brute_force(spark, monkeypatch, members):
    monkeypatch.setattr(jaccard, "BLOCK_MEMBERS", members)
    texts = corpus() + ODD
    got = {r["doc_id"]: (r["class_id"], r["n_links"]) for r in jaccard.join(frame(spark, texts, extra="key node n")).collect()}
    assert got == brute(texts)


def test_keep_one_of_each_group(spark):
    texts = corpus(8) + ODD
    docs = frame(spark, texts, extra="key root")
    kept = jaccard.keep_one(docs)
    assert kept.columns == docs.columns
    want = sorted({g for g, _ in brute(texts).values()})
    assert sorted(r["doc_id"] for r in kept.collect()) == want


def test_repeated_and_null_ids(spark):
    long = " ".join(f"x{k}" for k in range(60))
    rows = [(1, long), (1, long), (1, long + " end"), (None, "other words of some length here"), (None, "other words of some length here"),
            (2, None), (2, ""), (3, "one two")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((str(r["doc_id"]), str(r["class_id"]), r["n_links"]) for r in jaccard.join(docs).collect())
    assert got == sorted([("1", "1", 2)] * 3 + [("None", "None", 1)] * 2 + [("2", "2", 0)] * 2 + [("3", "3", 0)])
    kept = [tuple(r) for r in jaccard.keep_one(docs).collect()]
    assert len(kept) == 5 and sum(k[0] == 1 for k in kept) == 1 and sum(k[0] is None for k in kept) == 1


def test_empty_table(spark):
    assert jaccard.join(frame(spark, [])).collect() == []
    assert jaccard.keep_one(frame(spark, [])).collect() == []


def test_prefix_shortens_until_the_recall():
    assert jaccard.prefix_length(0.8) == 4
    assert jaccard.prefix_length(0.95) == jaccard.DEPTH
    for s in (0.5, 0.7, 0.8, 0.9):
        k = jaccard.prefix_length(s)
        assert k == 1 or 1 - (1 - s ** k) ** jaccard.TREES >= jaccard.RECALL


def test_nodes_are_prefixes_of_a_trie(spark):
    """Classes under one node at a depth are under one node at every lesser depth."""
    signed = jaccard.sign(K.as_rows(frame(spark, corpus(5))))
    at = [signed.select(jaccard.nodes(d).alias("n")).collect() for d in range(1, jaccard.DEPTH + 1)]
    rows = range(len(at[0]))
    shared = [{(t, i, j) for t in range(jaccard.TREES) for i in rows for j in rows if i < j and r[i].n[t] == r[j].n[t]} for r in at]
    assert all(deeper <= lesser for lesser, deeper in zip(shared, shared[1:]))
    assert len(shared[-1]) < len(shared[0])


def depths(monkeypatch):
    seen, plain = [], jaccard._matched
    monkeypatch.setattr(jaccard, "_matched", lambda classes, depth: (seen.append(depth), plain(classes, depth))[1])
    return seen


def test_shortens_only_as_far_as_the_links_need(spark, monkeypatch):
    seen = depths(monkeypatch)
    base = [f"w{k}" for k in range(400)]
    close = [" ".join(base), " ".join(base[:-1] + ["x"]), " ".join(base[:-1] + ["y"])]
    assert {r["n_links"] for r in jaccard.join(frame(spark, close)).collect()} == {2}
    assert seen == [jaccard.DEPTH]  # similarities of 0.99 need no shorter prefix
    seen.clear()
    far = close + [" ".join(base[:-40] + [f"z{k}" for k in range(40)])]  # 356 of 436 shared
    got = {r["doc_id"]: (r["class_id"], r["n_links"]) for r in jaccard.join(frame(spark, far)).collect()}
    assert got == brute(far)
    assert seen[0] == jaccard.DEPTH and seen[-1] == jaccard.prefix_length(0.816) and seen == sorted(seen, reverse=True)


@pytest.mark.parametrize("members", [256, 7])
def test_family_in_many_blocks(spark, monkeypatch, members):
    """A chain of texts, each near its neighbours only: blocks meet where they share a node."""
    monkeypatch.setattr(jaccard, "BLOCK_MEMBERS", members)
    words = [f"w{k}" for k in range(500)]
    texts = [" ".join(words[3 * k:3 * k + 120]) for k in range(60)]
    got = {r["doc_id"]: (r["class_id"], r["n_links"]) for r in jaccard.join(frame(spark, texts)).collect()}
    assert got == brute(texts)


def test_components_of_a_long_path(spark):
    edges = [(k, k + 1) for k in range(0, 60)] + [(100, 101), (102, 101), (5, 5)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {**{k: 0 for k in range(61)}, 100: 100, 101: 100, 102: 100}
