"""Operators 2 and 8 against brute force."""
import hashlib
import random
import re

import numpy as np
import pytest

from panelspark.llm import bwt, regions, substrings
from tests.llm.common import ODD, frame

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def passages(seed, alphabet, joiner):
    """Texts that share passages of many lengths, repeat themselves, and copy each other."""
    rng = random.Random(seed)
    say = lambda n: joiner.join(rng.choices(alphabet, k=n))
    shared = [say(n) for n in (5, 20, 60, 60, 150)]
    texts = []
    for _ in range(50):
        parts = []
        for _ in range(rng.randint(0, 6)):
            parts.append(rng.choice(shared) if rng.random() < 0.5 else say(rng.randint(1, 60)))
        texts.append(joiner.join(parts))
    return texts + texts[:6] + [say(1) * 200, joiner.join([say(2)] * 100)]


def brute_words(texts, width):
    docs = [[w.encode() for w in WORD.findall(t or "")] for t in texts]
    at = {}
    for d, w in enumerate(docs):
        for i in range(len(w) - width + 1):
            at.setdefault(tuple(w[i:i + width]), []).append((d, i))
    gone = [set() for _ in docs]
    for places in at.values():
        if len(places) > 1:
            for d, i in places:
                gone[d] |= set(range(i, i + width))
    return [(len(w), len(g), hashlib.sha256(b" ".join(x for k, x in enumerate(w) if k not in g)).hexdigest()) for w, g in zip(docs, gone)]


def brute_bytes(ids, texts, width):
    docs = [(t or "").encode() for t in texts]
    low = {}
    for i, raw in zip(ids, docs):
        for k in range(len(raw) - width + 1):
            s = raw[k:k + width]
            if i is not None:
                low[s] = min(low.get(s, i), i)
    out = []
    for i, raw in zip(ids, docs):
        gone = np.zeros(len(raw) + 1, bool)
        for k in range(len(raw) - width + 1):
            if i is not None and low[raw[k:k + width]] < i:
                gone[k:k + width] = True
        spans = int((gone[1:] & ~gone[:-1]).sum() + gone[0])
        left = bytes(b for b, g in zip(raw, gone) if not g)
        out.append((len(raw), int(gone.sum()), spans, hashlib.sha256(left).hexdigest()))
    return out


@pytest.mark.parametrize(("seed", "width"), [(1, 7), (2, 35)])
def test_words(spark, seed, width):
    texts = passages(seed, ["a", "bb", "é", "ccc,"], " ") + passages(seed, ["x y", "z\t\n", "\x0bq"], "  ") + ODD
    got = substrings.dedup(frame(spark, texts, extra="digest n_words runs"), width).collect()
    want = brute_words(texts, width)
    assert len(got) == len(texts)
    for r in got:
        assert (r["n_words"], r["n_removed"], r["kept_sha256"]) == want[r["doc_id"]]
        assert len(WORD.findall(r["kept"])) == r["n_words"] - r["n_removed"]
        assert sum(r["spans"][1::2]) - sum(r["spans"][::2]) == r["n_removed"]


@pytest.mark.parametrize(("seed", "width", "bucket"), [(3, 12, 1 << 20), (4, 50, 2000)])
def test_bytes(spark, monkeypatch, seed, width, bucket):
    monkeypatch.setattr(bwt, "BUCKET_BYTES", bucket)
    monkeypatch.setattr(bwt, "SHARD_BYTES", 500)  # many shards are merged
    texts = passages(seed, list("ab\0é"), "") + passages(seed, ["so ", "wie", " dé"], "") + ODD
    got = bwt.dedup(frame(spark, texts, extra="digest did runs"), width).collect()
    want = brute_bytes(range(len(texts)), texts, width)
    assert len(got) == len(texts)
    for r in got:
        assert (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) == want[r["doc_id"]]
        assert hashlib.sha256(r["kept"]).hexdigest() == r["kept_sha256"]
        assert sum(r["spans"][1::2]) - sum(r["spans"][::2]) == r["n_removed"]


def test_bytes_with_repeated_and_null_ids(spark):
    long = "".join(chr(97 + k * 7 % 26) + str(k) for k in range(40))
    rows = [(1, long), (1, long), (1, "q" + long), (None, long), (None, long + "z"), (2, "w" + long), (3, None), (0, "short")]
    got = bwt.dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    want = brute_bytes([i for i, _ in rows], [t for _, t in rows], 50)
    key = lambda x: (str(x[0]), *x[1:])
    assert sorted([(r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in got], key=key) == \
        sorted([(i, *w) for (i, _), w in zip(rows, want)], key=key)


def test_words_with_repeated_and_null_ids(spark):
    long = " ".join(f"w{k}" for k in range(40))
    rows = [(1, long), (1, long), (None, "x " + long), (2, None), (2, ""), (4, " ".join(f"v{k}" for k in range(50)))]
    got = substrings.dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    want = brute_words([t for _, t in rows], 35)
    key = lambda x: (str(x[0]), *x[1:])
    assert sorted([(r["doc_id"], r["n_words"], r["n_removed"], r["kept_sha256"]) for r in got], key=key) == \
        sorted([(i, *w) for (i, _), w in zip(rows, want)], key=key)


def test_a_full_filter_changes_nothing(spark, monkeypatch):
    """The bit table only narrows: with all bits set the result is the same."""
    texts = passages(9, ["a", "bb", "é"], " ")
    want = brute_words(texts, 20)
    monkeypatch.setattr(regions, "shared_anchors", lambda texts, plan: np.full(1 << (regions.FILTER_BITS - 6), 2 ** 64 - 1, np.uint64))
    for r in substrings.dedup(frame(spark, texts), 20).collect():
        assert (r["n_words"], r["n_removed"], r["kept_sha256"]) == want[r["doc_id"]]


def test_merged_transforms_sort_all_rotations():
    rng = random.Random(2)
    texts = [bytes(rng.choices(b"ab", k=rng.randint(1, 30))) for _ in range(40)]
    shards, width = [texts[:13], texts[13:30], texts[30:]], 9
    transforms, keys = [], []
    for part in shards:
        raw = np.frombuffer(b"\0".join(part) + b"\0", np.uint8).astype(np.uint16) + 1
        size = np.array([len(t) for t in part])
        end = np.cumsum(size + 1) - 1
        raw[end] = 0
        after = np.arange(1, len(raw) + 1)
        after[end] = end - size
        order, transformed = bwt.transform(raw, after, width)
        transforms.append(transformed)
        for p in order:
            key = []
            for _ in range(width):
                key.append(int(raw[p]))
                p = after[p]
            keys.append(tuple(key))
    rows, interval = bwt.merge(transforms, width)
    got = [keys[r] for r in rows]
    assert got == sorted(keys)
    assert [a == b for a, b in zip(got, got[1:])] == [a == b for a, b in zip(interval, interval[1:])]


def test_empty_tables(spark):
    assert bwt.dedup(frame(spark, [])).collect() == []
    assert substrings.dedup(frame(spark, [])).collect() == []
