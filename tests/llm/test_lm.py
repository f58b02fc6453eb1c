import math
import random
import re
from collections import Counter

import pytest

from panelspark.llm import catalog, lm
from tests.llm.common import ODD, frame

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def frequent(counts, limit):
    kind = {k: math.floor(math.log2(n) * 8) for k, n in counts.items()}
    total, least = 0, None
    for c, n in sorted(Counter(kind.values()).items(), reverse=True):
        total += n
        if total > limit:
            break
        least = c
    return {k for k in counts if least is not None and kind[k] >= least}


def brute(texts, target, max_words, max_bigrams):
    docs = [words(t) for t in texts]
    vocabulary = frequent(Counter(w for d in docs for w in d), max_words)
    docs = [[w if w in vocabulary else None for w in d] for d in docs]
    pairs = [list(zip([0, *d], d)) for d in docs]
    kept = frequent(Counter(p for x in pairs for p in x), max_bigrams)

    def loss(use):
        single, context, pair = Counter(), Counter(), Counter()
        for k in use:
            single.update(docs[k])
            context.update(a for a in docs[k])
            context[0] += bool(docs[k])
            pair.update(p for p in pairs[k] if p in kept)
        total = sum(single.values()) + len(vocabulary) + 1
        out = []
        for x in pairs:
            each = []
            for a, b in x:
                p = (single[b] + 1) / total
                if context[a]:
                    p = lm.LAMBDA * pair[a, b] / context[a] + (1 - lm.LAMBDA) * p
                each.append(-math.log(p))
            out.append(sum(each) / max(len(each), 1))
        return out

    return [len(d) for d in docs], loss(target), loss(range(len(docs)))


@pytest.mark.parametrize(("max_words", "max_bigrams"), [(1000, 10000), (12, 20), (1, 1)])
def test_against_brute_force(spark, max_words, max_bigrams):
    rng = random.Random(6)
    pool = [f"w{k}" for k in range(40)]
    texts = [" ".join(rng.choices(pool, [1 / (1 + k) for k in range(40)], k=rng.randint(0, 50))) for _ in range(50)] + ODD
    target = list(range(0, len(texts), 3))
    docs = frame(spark, texts, extra="n_tokens score target")
    model = lm.train(docs, spark.createDataFrame([(k,) for k in [*target, *target, None]], "doc_id long"), max_words, max_bigrams)
    assert len(model.vocabulary.words) <= max_words and len(model.bigrams) <= max_bigrams
    n, wanted, all_docs = brute(texts, target, max_words, max_bigrams)
    rows = lm.score(docs, model).collect()
    assert len(rows) == len(texts)
    for r in rows:
        k = r["row"]["doc_id"]
        assert r["n_tokens"] == n[k]
        assert r["target_loss"] == pytest.approx(wanted[k]) and r["background_loss"] == pytest.approx(all_docs[k])
        assert r["score"] == pytest.approx(wanted[k] - all_docs[k], abs=1e-9)


def test_scores_tell_target_like_texts(spark):
    sf = "/root/testdata/sf0.01"
    rows = catalog.op4_lm_scoring(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").collect()
    good, bad = ([r["score"] for r in rows if r["quality"] == q and r["n_tokens"]] for q in (1, 0))
    assert sum(good) / len(good) < sum(bad) / len(bad)


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long")
    model = lm.train(frame(spark, []), none)
    assert lm.score(frame(spark, []), model).collect() == []
    for r in lm.score(frame(spark, ODD), lm.train(frame(spark, ODD), none)).collect():
        assert math.isfinite(r["score"])
