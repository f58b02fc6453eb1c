"""Vectorised text helpers shared by the operators (numpy over Arrow buffers).

Texts are handled as UTF-8 bytes of a whole Arrow slice, so no Python loop runs
per word.  Word classes are byte classes: every delimiter is ASCII, so a byte
of a multi-byte character is always part of a word.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Text bytes that one numpy pass takes at a time; a longer text is a pass of its own.
CHUNK_BYTES = 2 << 20

_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_BASE_INV = np.uint64(pow(int(_BASE), -1, 1 << 64))
_powers: dict[str, np.ndarray] = {}


def _byte_class(members: bytes) -> np.ndarray:
    table = np.zeros(256, dtype=bool)
    table[list(members)] = True
    return table


#: ``[^\x20\x09-\x0D]+``
NON_SPACE = ~_byte_class(b" \t\n\x0b\x0c\r")
#: ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` of text whose A-Z are lower-cased
ALNUM = _byte_class(b"0123456789abcdefghijklmnopqrstuvwxyz" + bytes(range(128, 256)))

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def lower(buf: np.ndarray) -> np.ndarray:
    """A-Z to a-z, byte by byte."""
    return _LOWER[buf]


def chunks(batch: pa.RecordBatch, column: str, limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of whole rows with at most ``limit`` bytes of text, one row at least."""
    n = batch.num_rows
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes, dtype=np.int64)
    at = 0
    while at < n:
        base = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, base + limit, "right")))
        yield batch.slice(at, to - at)
        at = to


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a text column and the n + 1 offsets of its rows (null: empty)."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, np.int64, len(column) + 1, column.offset * 8)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[off[0]:off[-1]], off - off[0]


def word_spans(buf: np.ndarray, off: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte start, byte end and row of every word; a word never crosses rows."""
    if not len(buf):
        empty = np.zeros(0, np.int64)
        return empty, empty, empty
    inside = table[buf]
    first = np.zeros(len(buf) + 1, bool)
    first[off[:-1]] = True
    first = first[:-1]
    before = np.empty_like(inside)
    before[0] = False
    before[1:] = inside[:-1]
    start = np.flatnonzero(inside & (first | ~before))
    after = np.empty_like(inside)
    after[-1] = False
    after[:-1] = inside[1:] & ~first[1:]
    end = np.flatnonzero(inside & ~after) + 1
    return start, end, np.searchsorted(off, start, "right") - 1


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers.get("p", ())) < n:
        size = max(n, 1 << 16)
        for key, base in (("p", _BASE), ("i", _BASE_INV)):
            table = np.full(size, base, np.uint64)
            table[0] = 1
            _powers[key] = np.multiply.accumulate(table)
    return _powers["p"][:n], _powers["i"][:n]


def mix(h: np.ndarray, seed: int = 0) -> np.ndarray:
    """A bijective finaliser of 64 bits (xor-shift-multiply)."""
    h = h + np.uint64(seed)
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xC4CEB9FE1A85EC53)
    h ^= h >> np.uint64(33)
    return h


#: Bytes up to which a span is hashed by words of eight bytes; a longer one by BLAKE2.
_SHORT = 64
_KEY = b"panelspark span hash"
_KEEP = np.array([(1 << 8 * k) - 1 for k in range(8)] + [(1 << 64) - 1], np.uint64)


def span_hash(buf: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of each span's bytes; equal bytes have equal hashes anywhere.

    Short spans take one bijective mix for every eight bytes (so spans of one size
    up to eight bytes never collide), long ones a keyed BLAKE2: no sum or product
    of bytes, which crafted spans could balance out."""
    size = end - start
    words = np.ndarray((len(buf) + 1,), "<u8", np.concatenate([buf, np.zeros(8, np.uint8)]), 0, (1,))
    out = mix(size.astype(np.uint64), 0x5EED)
    live = np.flatnonzero(size <= _SHORT)
    for j in range(0, _SHORT, 8):
        live = live[size[live] > j] if j else live
        if not len(live):
            break
        chunk = words[start[live] + j] & _KEEP[np.minimum(size[live] - j, 8)]
        out[live] = mix(out[live] ^ chunk, 0x9E3779B97F4A7C15)
    for k in np.flatnonzero(size > _SHORT).tolist():
        out[k] = int.from_bytes(hashlib.blake2b(buf[start[k]:end[k]].tobytes(), digest_size=8, key=_KEY).digest(), "little")
    return out


def window_hash(items: np.ndarray, width: int, seed: int = 0) -> np.ndarray:
    """Hash of every run of ``width`` consecutive hashes (the caller masks those that cross rows)."""
    n = len(items) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    power, inverse = _power(len(items))
    sums = np.zeros(len(items) + 1, np.uint64)
    np.cumsum(mix(items, seed) * power, out=sums[1:])
    return mix((sums[width:] - sums[:-width]) * inverse[:n], seed)


def same_row(row: np.ndarray, width: int) -> np.ndarray:
    """Whether the ``width`` items from each start lie in one row."""
    if len(row) < width:
        return np.zeros(0, bool)
    return row[width - 1:] == row[: len(row) - width + 1]


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` consecutive values, by doubling."""
    span = 1
    out = values
    while span < width:
        step = min(span, width - span)
        out = np.minimum(out[:-step], out[step:]) if len(out) > step else out[:0]
        span += step
    return out


def covered(starts: np.ndarray, width: int, size: int) -> np.ndarray:
    """Mask of the ``size`` places that some run of ``width`` from ``starts`` covers."""
    marks = np.zeros(size + 1, np.int64)
    np.add.at(marks, starts, 1)
    np.add.at(marks, np.minimum(starts + width, size), -1)
    return np.cumsum(marks[:-1]) > 0


def documents(df, *names: str):
    """The columns an operator needs; others may have any name."""
    return df.select(*[df[n] for n in names])


def as_rows(df: DataFrame, *names: str) -> DataFrame:
    """The frame as one struct column ``row`` (all columns, or ``names``), which
    operators carry along unread: columns of any name cannot clash with theirs."""
    return df.select(F.struct(*[df[f"`{n}`"] for n in names or df.columns]).alias("row"))


def row_type(df: DataFrame) -> str:
    return df.schema["row"].dataType.simpleString()


def row_chunks(batches, limit: int = CHUNK_BYTES) -> Iterator[tuple[pa.StructArray, pa.Array]]:
    """``row`` and its texts, in slices bounded by bytes of text."""
    for batch in batches:
        row = batch.column("row")
        both = pa.RecordBatch.from_arrays([row, row.field("text")], names=["row", "text"])
        for part in chunks(both, "text", limit):
            yield part.column("row"), part.column("text")
