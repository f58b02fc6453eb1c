"""Pieces kept between slices of a corpus with many different words."""

import public_tokenizers
import pyarrow as pa

from panelspark.llm import bpe


def test_pieces_are_encoded_once_over_many_slices(monkeypatch):
    asked = []
    plain = bpe._encode_pieces

    def counted(tok, pieces, leaf, agree):
        asked.append(len(pieces))
        return plain(tok, pieces, leaf, agree)
    monkeypatch.setattr(bpe, "_encode_pieces", counted)
    encoder = bpe.Encoder(public_tokenizers.path("word_bpe_49k.json"))
    texts = pa.array([" ".join(f"w{k}" for k in range(lo, lo + 30_000)) for lo in range(0, 150_000, 30_000)])
    first = encoder(texts)
    again = encoder(texts)
    assert asked == [150_000] and (first[0] == again[0]).all() and (first[1] == again[1]).all()
