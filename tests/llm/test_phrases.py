import random
import re
from collections import Counter

import numpy as np
import pytest

from panelspark.llm import phrases
from tests.llm.common import DOC_SCHEMA, ODD

LEAST = 4


def brute(rows, least=LEAST, top=phrases.TOP):
    f, total = Counter(), Counter()
    for _, text, lang, _, _ in rows:
        lang = "und" if lang is None else lang
        text = "".join(c.lower() if c.isascii() else c for c in text or "")
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", text):
            w = re.findall("[^ \t]+", piece)
            total[lang] += len(w)
            for n in range(1, 5):
                for i in range(len(w) - n + 1):
                    f[lang, tuple(w[i:i + n])] += 1
    cand = {k: a for k, a in f.items() if a >= least and len(k[1]) > 1}
    around = Counter()
    for (lang, g), a in cand.items():
        for m in range(2, len(g)):
            for i in range(len(g) - m + 1):
                around[lang, g[i:i + m]] = max(around[lang, g[i:i + m]], a)
    out = []
    for lang in {k[0] for k in cand}:
        scored = []
        for (at, g), a in cand.items():
            if at == lang and not (around[lang, g] and 100 * around[lang, g] >= 80 * a):
                cuts = [(2_000_000 * a // (f[lang, g[:k]] + f[lang, g[k:]]), k) for k in range(1, len(g))]
                score, k = min(cuts)
                scored.append((-score, -a, " ".join(g).encode(), f[lang, g[:k]], f[lang, g[k:]]))
        out += [(lang, rank, p.decode(), -a, le, r, total[lang], -s) for rank, (s, a, p, le, r) in enumerate(sorted(scored)[:top], 1)]
    return sorted(out)


def corpus(seed=5, size=160):
    rng = random.Random(seed)
    words = [f"w{k}" for k in range(25)] + ["Über", "naïve", "x" * 90]
    fixed = [rng.choices(words, k=k) for k in (2, 3, 3, 4, 5, 6)]
    rows = []
    for k in range(size):
        parts = []
        for _ in range(rng.randrange(1, 12)):
            parts += rng.choice([rng.choice(fixed), [rng.choice(words).upper()], [rng.choice(words) + rng.choice(",.;:!?")]])
        text = rng.choice([" ", "  ", "\t", " "]).join(parts)
        rows.append((k, text + rng.choice(["", "\n", "\x0b", "\r\n"]) + " ".join(parts[:3]), rng.choice(["en", "en", "de", None, "und"]), None, None))
    return rows + [(900 + k, t, "en", None, None) for k, t in enumerate(ODD)]


def result(spark, rows, **options):
    docs = spark.createDataFrame(rows, DOC_SCHEMA)
    for name in ("key", "times", "shard", "phrase", "size", "words"):
        docs = docs.selectExpr("*", f"'x' AS `{name}`")
    return sorted(tuple(r) for r in phrases.collocations(docs, **({"least": LEAST} | options)).collect())


@pytest.mark.parametrize("shards", [1, 2, 4])
def test_against_brute_force(spark, shards):
    rows = corpus()
    want = brute(rows)
    assert len(want) > 40 and {len(r[2].split(" ")) for r in want} == {2, 3, 4}
    assert result(spark, rows, shards=shards) == want


def test_full_tables_change_no_result(spark, monkeypatch):
    monkeypatch.setattr(phrases, "MAX_BITS", 7)
    rows = corpus(6, 80)
    assert result(spark, rows) == brute(rows)


def test_top_and_ties(spark):
    rows = [(k, f"a{k % 7} b{k % 7}. c{k % 7} d{k % 7}", "en", None, None) for k in range(70)]
    want = brute(rows, top=5)
    assert len({r[-1] for r in want}) == 1 and [r[2] for r in want] == ["a0 b0", "a1 b1", "a2 b2", "a3 b3", "a4 b4"]
    assert result(spark, rows, top=5) == want


@pytest.mark.parametrize("rows", [[], [(0, None, None, None, None)], [(k, f"all words{k} differ{k}", "en", None, None) for k in range(9)]])
def test_no_phrases(spark, rows):
    assert result(spark, rows) == []


def test_scores_beyond_64_bits(spark):
    """a, l and r of about 2 ** 43: the product with the scale passes 2 ** 63."""
    a = (1 << 43) + 1
    frame = spark.createDataFrame([(a, a + 5, a + 8)], "a long, l long, r long")
    exact = f"CAST({phrases.SCALE} AS DECIMAL(7,0)) * CAST(a AS DECIMAL(19,0)) div (CAST(l AS DECIMAL(19,0)) + CAST(r AS DECIMAL(19,0)))"
    assert frame.selectExpr(exact).first()[0] == phrases.SCALE * a // (2 * a + 13)


def test_words_of_a_slice():
    import pyarrow as pa

    words = phrases.Words(pa.array(["A b, c d", None, "", "d  e\tf"]), pa.array(["x", None, "y", None]))
    assert [words.spelled[k].as_py() for k in words.word] == [b"a", b"b", b"c", b"d", b"d", b"e", b"f"]
    assert [words.langs[k].as_py() for k in words.lang] == ["x"] * 4 + ["und"] * 3
    assert words.runs[2].tolist() == [True, False, True, False, True, True]
    assert words.runs[3].tolist() == [False, False, False, False, True]
    assert np.array_equal([len(h) for h in words.hashes().values()], [7, 6, 5, 4])
