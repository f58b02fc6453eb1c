"""LM scoring keeps every word and bigram, whatever is broadcast."""
import math
import random
from collections import Counter

import pytest

from panelspark.llm import lm
from tests.llm.common import ODD, frame
from tests.llm.test_lm import words


def brute(learned, target, scored):
    """Losses of ``scored`` under the models of all texts and of ``target``, with every word and bigram."""
    size = len({w for t in learned for w in words(t)})

    def loss(use):
        single, context, pair = Counter(), Counter(), Counter()
        for k in use:
            d = words(learned[k])
            single.update(d)
            context.update(d)
            context[0] += bool(d)
            pair.update(zip([0, *d], d))
        total = sum(single.values()) + size + 1
        out = []
        for t in scored:
            each = []
            for a, b in zip([0, *words(t)], words(t)):
                p = (single[b] + 1) / total
                each.append(-math.log(lm.LAMBDA * pair[a, b] / context[a] + (1 - lm.LAMBDA) * p if context[a] else p))
            out.append(sum(each) / max(len(each), 1))
        return out

    return loss(target), loss(range(len(learned)))


def same(rows, wanted, all_docs):
    assert len(rows) == len(wanted)
    for r in rows:
        k = r["row"]["doc_id"]
        assert r["target_loss"] == pytest.approx(wanted[k]) and r["background_loss"] == pytest.approx(all_docs[k])


def test_more_words_than_are_broadcast(spark):
    texts = [" ".join(f"w{k}" for k in range(at, at + 7000)) for at in range(0, 70000, 7000)] + ["w1 w2 w3 w1 w2"]
    docs = frame(spark, texts)
    model = lm.train(docs, spark.createDataFrame([(0,), (10,)], "doc_id long"))
    assert len(model.vocabulary.words) == 70000
    same(lm.score(docs, model).collect(), *brute(texts, [0, 10], texts))


def test_heads_change_no_score_and_unseen_bigrams_back_off(spark):
    rng = random.Random(8)
    pool = [f"w{k}" for k in range(40)]
    texts = [" ".join(rng.choices(pool, [1 / (1 + k) for k in range(40)], k=rng.randint(0, 50))) for _ in range(40)] + ODD
    target = list(range(0, len(texts), 3))
    labels = spark.createDataFrame([(k,) for k in target], "doc_id long")
    docs = frame(spark, texts)
    model = lm.train(docs, labels, head_words=5, head_bigrams=7)
    assert len(model.head.pair) <= 7
    twice = docs.union(docs)  # repeated rows, and not the frame that was learned
    rows = lm.score(twice, model).collect()
    assert len(rows) == 2 * len(texts)
    for half in (sorted(rows, key=lambda r: r["row"]["doc_id"])[at::2] for at in (0, 1)):
        same(half, *brute(texts, target, texts))
    other = ["w39 w0 w38 new words w1", "w3 w3 w3", "", "never seen before"]
    same(lm.score(frame(spark, other), model).collect(), *brute(texts, target, other))


@pytest.mark.parametrize("head_words", [1, 9, 100])
def test_learned_documents_dealt_by_bigram(spark, monkeypatch, head_words):
    """Scores of the documents that were learned, which take no join of all bigrams:
    of head words, of rare words and of both, in many parts, of repeated rows and
    odd ids, with a table of targets so small that it hits other documents."""
    rng = random.Random(9)
    pool = [f"w{k}" for k in range(40)]
    texts = [" ".join(rng.choices(pool, [1 / (1 + k) for k in range(40)], k=rng.randint(0, 60))) for _ in range(60)] + ODD
    target = list(range(0, len(texts), 3))
    monkeypatch.setattr(lm, "PART_WORDS", 100)
    monkeypatch.setattr(lm, "FILTER_BITS", 6)
    monkeypatch.setattr(lm, "HOT", 12)
    monkeypatch.setattr(lm, "_looked_up", lambda *a: pytest.fail("joined all bigrams"))
    docs = frame(spark, texts)
    model = lm.train(docs, spark.createDataFrame([(k,) for k in [*target, *target, None, 10 ** 12]], "doc_id long"), head_words=head_words, head_bigrams=7)
    assert 0 < len(model.head.pair) <= 7 and len(model.wanted.value[1])
    same(lm.score(docs, model).collect(), *brute(texts, target, texts))
    ids = [0, 0, 1, 1, 2, None, 2]
    few = ["a b c a b", "a b c a b", "a b", "c c c c a", None, "a b c", "b c a b"]
    docs = spark.createDataFrame(list(zip(ids, few)), "doc_id long, text string")
    model = lm.train(docs, spark.createDataFrame([(0,), (2,)], "doc_id long"), head_words=head_words)
    wanted, every = brute(few, [0, 1, 4, 6], few)
    rows = lm.score(docs, model).collect()
    key = lambda x: (str(x[0]), str(x[1]))
    got = sorted(((r["row"]["doc_id"], r["row"]["text"], r["target_loss"], r["background_loss"]) for r in rows), key=key)
    want = sorted(zip(ids, few, wanted, every), key=key)
    assert [g[:2] for g in got] == [w[:2] for w in want]
    for g, w in zip(got, want):
        assert g[2:] == pytest.approx(w[2:])
