import hashlib
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from panelspark.llm import bpe, catalog
from tests.llm.common import ODD, SF, frame

PATH = catalog.tokenizer_path()


def brute(text):
    tok = bpe.tokenizer(PATH)
    ids = tok.encode(text or "", add_special_tokens=False).ids
    decoded = tok.decode(ids, skip_special_tokens=False)
    return len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet="abthe'sxyzé́日本Σß1２.!-", min_size=1, max_size=400), st.integers(5, 60), st.integers(4, 12))
def test_tree_equals_plain(text, leaf, agree):
    tok = bpe.tokenizer(PATH)
    text = "".join(text.split()) or "a"
    assert bpe.encode_tree(tok, text, leaf, agree) == tok.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("text", ["a" * 30000, "ab" * 9001, "the<|endoftext|>quick" * 900, "日本語" * 4000,
                                  "".join(random.Random(3).choices("aeioutnshrdl", k=60000))])
def test_long_unsplit_text(text):
    tok = bpe.tokenizer(PATH)
    assert bpe.encode_tree(tok, text) == tok.encode(text, add_special_tokens=False).ids


def test_joins_stay_local():
    """A long word of usual letters is joined through small windows, not encoded anew."""
    tok, seen = bpe.tokenizer(PATH), []

    class Spy:
        def encode(self, text, **k):
            seen.append(len(text))
            return tok.encode(text, **k)

        def encode_batch(self, texts, **k):
            return tok.encode_batch(texts, **k)

    text = "".join(random.Random(5).choices("aeioutnshrdl", k=40000))
    assert bpe.encode_tree(Spy(), text) == tok.encode(text, add_special_tokens=False).ids
    assert max(seen) < 4000


def test_odd_documents(spark):
    texts = [*ODD, "İstanbul <|startoftext|> it's", "e\ń é"]
    rows = {r["doc_id"]: r for r in bpe.encode(frame(spark, texts, extra="ids n_tokens"), PATH).collect()}
    for k, t in enumerate(texts):
        r = rows[k]
        assert (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) == brute(t)
        assert len(r["ids"]) == r["n_tokens"]


def test_query_equals_library(spark):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    for r in catalog.op10_bpe_roundtrip(spark, SF).collect():
        assert (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) == brute(docs[r["doc_id"]])


def test_empty_table(spark):
    assert bpe.encode(frame(spark, []), PATH).collect() == []


def test_long_pieces_that_differ_in_bytes_alone(spark):
    """Words of 2,048 bytes whose polynomial hashes modulo 2 ** 64 are equal."""
    morse = [bin(k).count("1") % 2 for k in range(2048)]
    texts = ["".join("ab"[b] for b in morse), "".join("ba"[b] for b in morse)]
    got = {r["doc_id"]: list(r["ids"]) for r in bpe.encode(frame(spark, texts), PATH).collect()}
    tok = bpe.tokenizer(PATH)
    assert [got[k] for k in (0, 1)] == [tok.encode(t, add_special_tokens=False).ids for t in texts]
    assert got[0] != got[1]


def test_bounds_of_memory_change_nothing(spark, monkeypatch):
    texts = ODD + [f"word{k} " * 3 + f"x{k}" for k in range(60)]
    want = sorted(map(str, bpe.encode(frame(spark, texts), PATH).collect()))
    encoder = bpe.Encoder(PATH)
    monkeypatch.setattr(bpe, "CACHE_BYTES", 20)
    monkeypatch.setattr(bpe, "BATCH_PIECES", 3)
    import pyarrow as pa
    first, again = encoder(pa.array(texts)), encoder(pa.array(texts))
    assert all((a == b).all() for a, b in zip(first, again)) and want
