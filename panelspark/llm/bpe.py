"""Operator 10: BPE encoding and decoding by tree concatenation.

White space always ends a pre-token of the tokenizer family handled here (its
normaliser squeezes white space, its splitter drops it), so a text is the
concatenation of its white-space-free *pieces*, and equal pieces encode alike.
Each distinct piece of an Arrow slice is encoded once.  A piece longer than
``leaf`` code points (an unsplit text) is encoded as a tree: its leaves are
encoded in parallel by the tokenizer's batch threads, then neighbours are
joined pairwise: a window of tokens around the join is encoded again, and
grows until ``agree`` consecutive tokens on both sides agree, in ids and in
offsets, with what is already there; a window that reaches both ends is the
plain encoding, so the fallback is exact.

Cases: null or empty text: no tokens.  Extra columns are not read.  Repeated
rows are encoded row by row.  A text of any length is read whole.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from panelspark.llm import textkit as K

#: Code points of a leaf of the tree.
LEAF = 2048
#: Tokens on each side that must agree before a join is taken.
AGREE = 16
#: Distinct pieces, and their bytes, kept encoded between slices; and pieces that the
#: tokenizer gets at a time.  Bounds of memory only.
CACHE_PIECES, CACHE_BYTES, BATCH_PIECES = 300_000, 16 << 20, 4096

_tokenizers: dict[str, object] = {}

Encoding = tuple[list[int], list[tuple[int, int]]]


def tokenizer(path: str):
    """The tokenizer of a file, one per Python worker; truncation and padding off."""
    if path not in _tokenizers:
        from tokenizers import Tokenizer

        made = Tokenizer.from_file(path)
        made.no_truncation()
        made.no_padding()
        _tokenizers[path] = made
    return _tokenizers[path]


def _plain(tok, text: str) -> Encoding:
    enc = tok.encode(text, add_special_tokens=False)
    return enc.ids, enc.offsets


def _agreement(window: list, side: list, agree: int, places: range) -> tuple[int, int] | None:
    """First of ``places`` of the window from which ``agree`` tokens stand in
    ``side`` too, with the same ids and offsets; and their place there."""
    at = {token: k for k, token in enumerate(side)}
    for p in places:
        k = at.get(window[p])
        if k is not None and len(side) - k >= agree and window[p:p + agree] == side[k:k + agree]:
            return p, k
    return None


def _join(tok, text: str, left: Encoding, right: Encoding, agree: int) -> Encoding:
    """Encoding of ``text`` from those of its two parts (offsets are in ``text``).

    The window's own ends are cuts too, so its outermost tokens may differ from
    those of either side; the two encodings are spliced where they agree first."""
    (lid, loff), (rid, roff) = left, right
    reach = 4 * agree
    while True:
        i, j = len(lid) - reach, reach
        if i <= 0 or j >= len(rid):
            return _plain(tok, text)
        a, b = loff[i][0], roff[j - 1][1]
        ids, off = _plain(tok, text[a:b])
        off = [(x + a, y + a) for x, y in off]
        window = list(zip(ids, off))
        from_left = _agreement(window, list(zip(lid[i:], loff[i:])), agree, range(max(0, len(window) - agree + 1)))
        to_right = _agreement(window, list(zip(rid[:j], roff[:j])), agree, range(len(window) - agree, -1, -1))
        if from_left and to_right and from_left[0] + agree <= to_right[0]:
            (p, x), (q, y) = from_left, to_right
            return lid[:i + x] + ids[p:q] + rid[y:], loff[:i + x] + off[p:q] + roff[y:]
        reach *= 2


def encode_tree(tok, text: str, leaf: int = LEAF, agree: int = AGREE) -> list[int]:
    """Ids of one long text without white space."""
    if len(text) <= leaf:
        return _plain(tok, text)[0]
    cuts = list(range(0, len(text), leaf)) + [len(text)]
    parts = [text[a:b] for a, b in zip(cuts, cuts[1:])]
    level = []
    for a, b, enc in zip(cuts, cuts[1:], tok.encode_batch(parts, add_special_tokens=False)):
        level.append((a, b, (enc.ids, [(x + a, y + a) for x, y in enc.offsets])))
    while len(level) > 1:
        joined = []
        for k in range(0, len(level) - 1, 2):
            (a, m, left), (_, b, right) = level[k], level[k + 1]
            shift = lambda e: (e[0], [(x - a, y - a) for x, y in e[1]])
            ids, off = _join(tok, text[a:b], shift(left), shift(right), agree)
            joined.append((a, b, (ids, [(x + a, y + a) for x, y in off])))
        level = joined + ([level[-1]] if len(level) % 2 else [])
    return level[0][2][0]


def _encode_pieces(tok, pieces: list[str], leaf: int, agree: int) -> list[list[int]]:
    short = [k for k, p in enumerate(pieces) if len(p) <= leaf]
    out: list[list[int]] = [[]] * len(pieces)
    for lo in range(0, len(short), BATCH_PIECES):
        some = short[lo:lo + BATCH_PIECES]
        for k, enc in zip(some, tok.encode_batch_fast([pieces[k] for k in some], add_special_tokens=False)):
            out[k] = enc.ids
    for k, p in enumerate(pieces):
        if len(p) > leaf:
            out[k] = encode_tree(tok, p, leaf, agree)
    return out


def _ragged(offsets: np.ndarray, pick: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the rows ``pick`` of a ragged array, and the lengths of those rows."""
    size = (offsets[1:] - offsets[:-1])[pick]
    ends = np.cumsum(size)
    where = np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - size, size) + np.repeat(offsets[:-1][pick], size)
    return where, size


class Encoder:
    """Encodes Arrow slices; keeps pieces between slices up to a bound."""

    def __init__(self, path: str, leaf: int = LEAF, agree: int = AGREE) -> None:
        self.tok, self.leaf, self.agree = tokenizer(path), leaf, agree
        self.known: dict[bytes, int] = {}
        self.held = 0
        self.ids = np.zeros(0, np.uint32)
        self.offsets = np.zeros(1, np.int64)

    def __call__(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the rows, and the n + 1 offsets of the rows in them."""
        buf, off = K.text_bytes(column)
        start, end, row = K.word_spans(buf, off, K.NON_SPACE)
        if len(self.known) > CACHE_PIECES or self.held > CACHE_BYTES:
            self.known, self.ids, self.offsets, self.held = {}, np.zeros(0, np.uint32), np.zeros(1, np.int64), 0
        ends = np.concatenate([[0], np.cumsum(end - start)]).astype(np.int64)
        pieces = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(start), [None, pa.py_buffer(ends), pa.py_buffer(buf[K.NON_SPACE[buf]])]) \
            .dictionary_encode()  # by their bytes
        fresh, code = [], np.empty(len(pieces.dictionary), np.int64)
        for k, piece in enumerate(pieces.dictionary.to_pylist()):
            at = self.known.get(piece)
            if at is None:
                at = self.known[piece] = len(self.known)
                self.held += len(piece)
                fresh.append(piece.decode("utf-8"))
            code[k] = at
        if fresh:
            made = _encode_pieces(self.tok, fresh, self.leaf, self.agree)
            sizes = np.fromiter(map(len, made), np.int64, len(made))
            flat = np.fromiter((x for ids in made for x in ids), np.uint32, int(sizes.sum()))
            self.ids = np.concatenate([self.ids, flat])
            self.offsets = np.concatenate([self.offsets, self.offsets[-1] + np.cumsum(sizes)])
        where, size = _ragged(self.offsets, code[pieces.indices.to_numpy()])
        per_row = np.bincount(row, weights=size, minlength=len(off) - 1).astype(np.int64)
        return self.ids[where], np.concatenate([[0], np.cumsum(per_row)])


def _mapper(path: str | Callable[[], str], leaf: int, agree: int, keep_ids: bool, keep_decoded: bool):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        where = path() if callable(path) else path
        encoder = Encoder(where, leaf, agree)
        for batch in batches:
            for part in K.chunks(batch, "text"):
                ids, off = encoder(part.column("text"))
                raw = ids.astype("<u4")
                decoded, hashes, shas = [], [], []
                for a, b in zip(off[:-1].tolist(), off[1:].tolist()):
                    text = encoder.tok.decode(raw[a:b].tolist(), skip_special_tokens=False)
                    if keep_decoded:
                        decoded.append(text)
                    hashes.append(hashlib.sha256(raw[a:b].tobytes()).hexdigest())
                    shas.append(hashlib.sha256(text.encode()).hexdigest())
                cols = [part.column("doc_id"), pa.array(off[1:] - off[:-1], pa.int64()), pa.array(hashes), pa.array(shas)]
                names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
                if keep_ids:
                    cols.append(pa.ListArray.from_arrays(pa.array(off, pa.int32()), pa.array(ids.astype(np.int32))))
                    names.append("ids")
                if keep_decoded:
                    cols.append(pa.array(decoded, pa.string()))
                    names.append("decoded")
                yield pa.RecordBatch.from_arrays(cols, names=names)
                del ids, raw, cols, decoded
                pa.default_memory_pool().release_unused()
    return run


def encode(docs: DataFrame, path: str | Callable[[], str], leaf: int = LEAF, agree: int = AGREE,
           keep_ids: bool = True, keep_decoded: bool = True) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` of every row, with
    ``ids array<int>`` and ``decoded string`` unless they are switched off.

    ``path`` is the tokenizer file, or a function that names it on the executor."""
    schema = f"doc_id {dict(docs.dtypes)['doc_id']}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    if keep_ids:
        schema += ", ids array<int>"
    if keep_decoded:
        schema += ", decoded string"
    return K.documents(docs, "doc_id", "text").mapInArrow(_mapper(path, leaf, agree, keep_ids, keep_decoded), schema)
