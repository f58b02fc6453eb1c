import hashlib
import random
import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from panelspark.llm import catalog, pii
from tests.llm.common import ODD, SF, frame

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def brute(text):
    digits = lambda m: re.sub("[^0-9]", "", m[0])

    def luhn(s):
        total = 0
        for k, c in enumerate(reversed(s)):
            d = int(c) * (1 + k % 2)
            total += d - 9 * (d > 9)
        return total % 10 == 0

    out = [(0, *m.span()) for m in EMAIL.finditer(text)]
    out += [(1, *m.span()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m[0].split("."))]
    out += [(2, *m.span()) for m in CARD.finditer(text) if 13 <= len(digits(m)) <= 19 and luhn(digits(m))]
    return out + [(3, *m.span()) for m in PHONE.finditer(text) if 9 <= len(digits(m)) <= 15]


@settings(max_examples=600, deadline=None)
@given(st.text(alphabet="ab@@..+-% 0123455()é\n", max_size=60))
def test_base_equals_the_patterns(text):
    assert pii.base_spans(text) == brute(text)


def test_base_on_usual_cases():
    text = ("x a.b@c.d.e. 1.2.3.4.5 300.1.1.1 x 4111 1111 1111 1111 y 4111111111111112 z +1 (017) 555-7713. é+49 30 901820 "
            "1.2.3.4.5.6.7.8 a@b@c.d 001.02.3.255 +1 2")
    assert pii.base_spans(text) == brute(text)
    assert {k for k, _, _ in pii.base_spans(text)} == {0, 1, 2, 3}
    long = "1" * 200_000 + "@" * 1000 + "a" * 200_000 + " 9.9.9.9"
    assert [k for k, _, _ in pii.base_spans(long)] == [1]


def naive_viterbi(words, model):
    out = np.zeros(len(words.start), int)
    for r in range(int(words.row.max()) + 1 if len(words.row) else 0):
        at = np.flatnonzero(words.row == r)
        if not len(at):
            continue
        e = model.emit[words.features[at]].sum(axis=1)
        best, back = model.moves[pii.LABELS].astype(float) + e[0], []
        for t in range(1, len(at)):
            step = best[:, None] + model.moves[:pii.LABELS]
            back.append(step.argmax(axis=0))
            best = step.max(axis=0) + e[t]
        label = int(best.argmax())
        for t in range(len(at) - 1, -1, -1):
            out[at[t]] = label
            if t:
                label = int(back[t - 1][label])
    return out


def test_viterbi_equals_naive():
    rng = np.random.default_rng(4)
    say = random.Random(4)
    column = pa.array([" ".join(say.choices(["a", "b.", "1", "22", "x@y", "+1", "c"], k=say.randint(0, 40))) for _ in range(80)] + [None, ""])
    words = pii.words_of(column)
    for lean in (0.0, 1.5, 4.0):
        emit = rng.normal(size=(pii.FEATURES << pii.BITS, pii.LABELS)).astype(np.float32)
        emit[:, 0] += lean
        model = pii.Model(emit, (rng.normal(size=(pii.LABELS + 1, pii.LABELS)) / 2 + pii._forbidden()).astype(np.float32))
        assert np.array_equal(pii.decode(words, model), naive_viterbi(words, model))


def test_viterbi_cut_is_exact_where_going_on_pays():
    """A word that alone would be outside begins a span, as the next word's "goes on" pays for both."""
    rng = np.random.default_rng(5)
    say = random.Random(5)
    column = pa.array([" ".join(say.choices(["a", "b.", "1", "22", "x@y", "+1", "c"], k=say.randint(0, 40))) for _ in range(120)])
    words = pii.words_of(column)
    cut = 0
    for lean, strong in ((3.0, 8.0), (6.0, 12.0), (10.0, 20.0)):
        emit = rng.normal(size=(pii.FEATURES << pii.BITS, pii.LABELS)).astype(np.float32)
        emit[:, 0] += lean
        emit[:, 2::2] += np.where(rng.random((pii.FEATURES << pii.BITS, 4)) < 0.15, strong, 0.0).astype(np.float32)
        model = pii.Model(emit, (rng.normal(size=(pii.LABELS + 1, pii.LABELS)) / 4 + pii._forbidden()).astype(np.float32))
        want = naive_viterbi(words, model)
        assert np.array_equal(pii.decode(words, model), want)
        alone = emit[words.features].sum(axis=1)
        cut += int(((want % 2 == 1) & (alone[:, 0] - alone[:, 1:].max(axis=1) > 2 * (model.moves.max() - model.moves[model.moves > -20].min()))).sum())
    assert cut  # such words do stand in the data


def test_query(spark):
    docs = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = catalog.op5_personal_data(spark, SF).collect()
    assert len(rows) == len(docs)
    for r in rows:
        base = brute(docs[r["doc_id"]])
        text = pii.as_text(base)
        assert [r[f"n_{k}"] for k in pii.KINDS] == [sum(x == k for x, _, _ in base) for k in range(4)]
        assert r["base_sha256"] == hashlib.sha256(text.encode()).hexdigest()
        assert set(text.split(",")) <= set(r["spans"].split(",")) or not text


def test_crf_finds_the_labelled_spans_alone(spark):
    """Trained on some texts, the field alone finds most base spans of others, and little else."""
    texts = [r["text"] for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect() if r["text"]]
    train, test = texts[::2], texts[1::2]
    rows = [(t, pii.as_text(pii.base_spans(t))) for t in train if pii.base_spans(t)] + [(t, "") for t in train[:60] if not pii.base_spans(t)]
    model = pii.train(spark.createDataFrame(rows, "text string, spans string"))
    words = pii.words_of(pa.array(test))
    got, want = pii.decode(words, model), pii.label_words(words, [pii.base_spans(t) for t in test], test)
    assert (want > 0).sum() > 30
    assert ((got > 0) & (want > 0)).sum() / (want > 0).sum() > 0.85
    assert ((got > 0) & (want == 0)).sum() / max((got > 0).sum(), 1) < 0.15


def test_field_finds_layouts_that_the_patterns_miss(spark):
    """Trained on some texts, it finds the spans of others in layouts the patterns miss, and adds little to clean ones."""
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    half = docs.where("crc32(CAST(doc_id AS STRING)) % 2 = 0")
    model = pii.train(pii.labelled_by_patterns(half))
    rest = [r["text"] for r in docs.where("crc32(CAST(doc_id AS STRING)) % 2 = 1 AND text IS NOT NULL").select("text").collect()]
    with_spans = [(t, pii.base_spans(t)) for t in rest if pii.base_spans(t)]
    hit, all_of = [0] * 4, [0] * 4
    for turn in (0, 1):
        new = [pii.relaid(t, b, turn) for t, b in with_spans]
        for (_, want), (_, got) in zip(new, pii.find(pa.array([t for t, _ in new]), model)):
            for kind, a, b in want:
                all_of[kind] += 1
                hit[kind] += any(k == kind and x < b and a < y for k, x, y in got)
    added = [set(every) - set(base) for base, every in pii.find(pa.array(rest), model)]
    print("recall by kind", [(k, h, n) for k, h, n in zip(pii.KINDS, hit, all_of)], "added", sum(map(len, added)), "to", sum(map(bool, added)), "of", len(rest),
          [t[a:b] for t, s in zip(rest, added) for _, a, b in s][:12])
    assert sum(hit) > 0.85 * sum(all_of)
    assert sum(map(bool, added)) < 0.02 * len(rest)


def test_relaid():
    text = "x a.b@c.org y +1 (523) 555-7040, 1.2.3.4, 4111 1111 1111 1111"
    new, spans = pii.relaid(text, pii.base_spans(text), 0)
    assert [k for k, _, _ in spans] == [0, 1, 2, 3] and new.startswith("x ") and " y " in new
    assert not {new[a:b] for _, a, b in spans} & {text[a:b] for _, a, b in pii.base_spans(text)}
    assert pii.relaid("no spans", [], 1) == ("no spans", [])


def test_added_spans_do_not_replace_base_ones():
    texts = ["tel (017) 555-7713! now", "é (017) 555-7713", "+1 (017) 555-7713"]
    words = pii.words_of(pa.array(texts))
    labels = np.zeros(len(words.start), int)
    raw = [words.buf[a:b].tobytes() for a, b in zip(words.start, words.end)]
    for k, w in enumerate(raw):
        if w.startswith(b"(0"):
            labels[k], labels[k + 1] = 7, 8
    spans = pii.added_spans(words, labels)
    assert [texts[0].encode()[a:b] for _, a, b in spans[0]] == [b"(017) 555-7713"]
    assert spans[1] == [(3, 3, 17)]


def test_odd_documents_and_empty_tables(spark):
    docs = frame(spark, [*ODD, "mail a.b@c.org. x", "mail a.b@c.org. x"], extra="base spans")
    for model in (pii.Model.empty(), pii.train(pii.labelled_by_patterns(docs)), pii.train(pii.labelled_by_patterns(frame(spark, [])))):
        rows = {r["row"]["doc_id"]: r for r in pii.scan(docs, model).collect()}
        assert len(rows) == len(ODD) + 2
        assert rows[0]["spans"] == rows[1]["spans"] == ""
        assert rows[len(ODD)]["base"] == rows[len(ODD) + 1]["base"] == "email:5:14"
        assert pii.scan(frame(spark, []), model).collect() == []


def test_redact():
    assert pii.redact("a b c", "") == "a b c" and pii.redact(None, "") is None
    assert pii.redact("0123456789", "ip:1:3,card:2:5,phone:7:8") == "0[IP]56[PHONE]89"
