"""Operator 7: quality rules and a calibrated n-gram classifier.

Base rules are counts over the whole text (see ``scan``).  The classifier is a
logistic regression over hashed word uni- and bigrams and byte trigrams, each
kind as relative frequencies of the document.  It is fitted on a bounded sample
of labelled quality rows (``max_rows``, picked by a hash of doc_id): three
quarters fit the weights, and the rest gives a Platt scaling, so that scores are
probabilities.  All documents are scored in Arrow slices against the fixed
threshold.

Cases: null or empty texts have no words: they fail the base rules.  A table
without labels of both classes gives every document the probability 0.5, which
passes the threshold.  Repeated documents are judged row by row.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelspark.llm import textkit as K
from panelspark.llm.toxicity import sample

BITS = 17
MAX_ROWS = 4_000
#: Fixed thresholds of the rules: words at least, per cent of words in repeated
#: 3-word windows at most, probability of good quality at least.
MIN_WORDS, MAX_REPEAT_PERCENT, MIN_PROBABILITY = 50, 50, 0.5
REPEAT_WINDOW = 3
_SYMBOLS = np.zeros(256, bool)
_SYMBOLS[list(b"#*$%&|<>")] = True
_NOT_NEWLINE = np.ones(256, bool)
_NOT_NEWLINE[10] = False


def _per_row(mask: np.ndarray, off: np.ndarray) -> np.ndarray:
    sums = np.concatenate([[0], np.cumsum(mask, dtype=np.int64)])
    return sums[off[1:]] - sums[off[:-1]]


def _repeats(row: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whether each value stands more than once in its row, and whether it did before."""
    if not len(row):
        return np.zeros(0, bool), np.zeros(0, bool)
    order = np.lexsort((value, row))
    r, v = row[order], value[order]
    as_last = np.concatenate([[False], (r[1:] == r[:-1]) & (v[1:] == v[:-1])])
    as_next = np.concatenate([as_last[1:], [False]])
    many, again = np.empty(len(row), bool), np.empty(len(row), bool)
    many[order], again[order] = as_last | as_next, as_last  # lexsort is stable
    return many, again


@dataclass
class Counts:
    n_words: np.ndarray
    word_chars: np.ndarray
    n_symbols: np.ndarray
    n_dup_lines: np.ndarray
    n_repeat_words: np.ndarray
    base_failed: np.ndarray
    grams: tuple[tuple[np.ndarray, np.ndarray], ...]  # (row, feature) by kind


def count(text: pa.Array, bits: int) -> Counts:
    buf, off = K.text_bytes(text)
    rows = len(off) - 1
    start, end, row = K.word_spans(buf, off, K.NON_SPACE)
    word = K.span_hash(buf, start, end)
    n_words = np.bincount(row, minlength=rows).astype(np.int64)
    points = K.NON_SPACE[buf] & ((buf & 0xC0) != 0x80)
    a, b, line_row = K.word_spans(buf, off, _NOT_NEWLINE)
    first = np.searchsorted(start, a)
    with_word = (first < len(start)) & (np.append(start, len(buf))[first] < b)
    a, b, line_row = a[with_word], b[with_word], line_row[with_word]
    again = _repeats(line_row, K.span_hash(buf, a, b))[1]
    same = K.same_row(row, REPEAT_WINDOW)
    at = np.flatnonzero(same)
    many = _repeats(row[at], K.window_hash(word, REPEAT_WINDOW)[at])[0] if len(at) else np.zeros(0, bool)
    repeated = K.covered(at[many], REPEAT_WINDOW, len(word))
    n_repeat = np.bincount(row[repeated], minlength=rows).astype(np.int64)
    two = np.flatnonzero(K.same_row(row, 2))
    cut = np.uint64(64 - bits)
    as_place = lambda h, kind: ((h >> cut) | np.uint64(kind << bits)).astype(np.int64)
    byte_row = np.repeat(np.arange(rows), off[1:] - off[:-1])
    three = np.flatnonzero(K.same_row(byte_row, 3))
    wide = buf.astype(np.uint64)
    chars = (wide[three] | wide[three + 1] << np.uint64(8) | wide[three + 2] << np.uint64(16)) if len(three) else wide[:0]
    grams = (
        (row, as_place(K.mix(word, 1), 0)),
        (row[two], as_place(K.window_hash(word, 2)[two] if len(two) else word[:0], 1)),
        (byte_row[three], as_place(chars * np.uint64(0x9E3779B97F4A7C15), 2)),
    )
    return Counts(n_words, _per_row(points, off), _per_row(_SYMBOLS[buf], off),
                  np.bincount(line_row[again], minlength=rows).astype(np.int64), n_repeat,
                  (n_words < MIN_WORDS) | (100 * n_repeat > MAX_REPEAT_PERCENT * n_words), grams)


def raw_score(counts: Counts, weights: np.ndarray) -> np.ndarray:
    """Sum over the kinds of the mean weight of a document's grams."""
    total = np.zeros(len(counts.n_words))
    for row, place in counts.grams:
        n = np.bincount(row, minlength=len(total))
        total += np.bincount(row, weights=weights[place], minlength=len(total)) / np.maximum(n, 1)
    return total


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


@dataclass
class Model:
    """Weights by place, with the scale and shift that calibrate the raw score."""
    place: np.ndarray
    weight: np.ndarray
    scale: float = 0.0
    shift: float = 0.0


def fit(examples: list[tuple[int, int, np.ndarray, np.ndarray]], bits: int, epochs: int = 4, rate: float = 0.5, batch: int = 32) -> Model:
    """``examples`` are (pick, label, places, frequencies).  Adagrad on the log loss, then Platt."""
    if len({x[1] for x in examples}) < 2:
        return Model(np.zeros(0, np.int64), np.zeros(0, np.float32))
    tune = [x for x in examples if x[0] % 4 == 0]
    learn = [x for x in examples if x[0] % 4 != 0]
    if len({x[1] for x in tune}) < 2 or len({x[1] for x in learn}) < 2:
        tune = learn = examples
    size = 3 << bits
    w, squares, bias, bias_squares = np.zeros(size), np.full(size, 1e-8), 0.0, 1e-8
    for _ in range(epochs):
        for k in range(0, len(learn), batch):
            part = learn[k:k + batch]
            row = np.repeat(np.arange(len(part)), [len(x[2]) for x in part])
            place, value = np.concatenate([x[2] for x in part]), np.concatenate([x[3] for x in part])
            raw = np.bincount(row, weights=w[place] * value, minlength=len(part)) + bias
            miss = (_sigmoid(raw) - np.array([x[1] for x in part])) / len(part)
            touched, to = np.unique(place, return_inverse=True)
            gradient = np.bincount(to, weights=miss[row] * value)
            squares[touched] += gradient ** 2
            w[touched] -= rate * gradient / np.sqrt(squares[touched])
            bias_squares += miss.sum() ** 2
            bias -= rate * miss.sum() / np.sqrt(bias_squares)
    raw = np.array([float((w[x[2]] * x[3]).sum()) for x in tune])
    labels = np.array([x[1] for x in tune], float)
    positive, negative = labels.sum(), len(labels) - labels.sum()
    target = np.where(labels == 1, (positive + 1) / (positive + 2), 1 / (negative + 2))  # Platt's smoothed targets
    spread = raw.std() or 1.0
    x = np.column_stack([raw / spread, np.ones(len(raw))])
    a = np.array([1.0, 0.0])
    for _ in range(50):  # Newton steps on two numbers
        p = _sigmoid(x @ a)
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + 1e-6 * np.eye(2), x.T @ (p - target) + 1e-6 * a)
        a = a - np.clip(step, -2, 2)
    place = np.flatnonzero(w)
    return Model(place, w[place].astype(np.float32), float(a[0] / spread), float(a[1]))


def _feature_mapper(bits: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in K.chunks(batch, "text", K.CHUNK_BYTES // 2):
                places, values, size = [], [], np.zeros(part.num_rows, np.int64)
                for row, place in count(part.column("text"), bits).grams:
                    key, n = np.unique((row << (bits + 2)) | place, return_counts=True)
                    r = key >> (bits + 2)
                    total = np.bincount(row, minlength=part.num_rows)
                    places.append((r, key & ((1 << bits + 2) - 1)))
                    values.append(n / total[r])
                    size += np.bincount(r, minlength=part.num_rows)
                order = np.argsort(np.concatenate([r for r, _ in places]), kind="stable")
                ends = pa.array(np.concatenate([[0], np.cumsum(size)]), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [part.column("pick"), part.column("label"),
                     pa.ListArray.from_arrays(ends, pa.array(np.concatenate([p for _, p in places])[order].astype(np.int32))),
                     pa.ListArray.from_arrays(ends, pa.array(np.concatenate(values)[order].astype(np.float32)))],
                    names=["pick", "label", "places", "parts"])
    return run


def _train_mapper(bits: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        examples = []
        for batch in batches:
            off = batch.column("places").offsets.to_numpy()
            off = off - off[0]
            place, value = batch.column("places").flatten().to_numpy(), batch.column("parts").flatten().to_numpy()
            for pick, label, a, b in zip(batch.column("pick").to_pylist(), batch.column("label").to_pylist(), off[:-1], off[1:]):
                examples.append((pick, label, place[a:b], value[a:b]))
        m = fit(examples, bits)
        yield pa.RecordBatch.from_arrays(  # the calibration is told by places below 0
            [pa.array(np.concatenate([[-1, -2], m.place]), pa.int64()), pa.array(np.concatenate([[m.scale, m.shift], m.weight]))],
            names=["place", "weight"])
    return run


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", bits: int = BITS, max_rows: int = MAX_ROWS) -> Model:
    made = sample(docs, labels, label, None, max_rows).mapInArrow(
        _feature_mapper(bits), "pick long, label int, places array<int>, parts array<float>")
    rows = made.repartition(1).sortWithinPartitions("pick", "label", "places") \
        .mapInArrow(_train_mapper(bits), "place long, weight double").toPandas()
    if not len(rows):
        return Model(np.zeros(0, np.int64), np.zeros(0, np.float32))
    scale, shift = (float(rows.loc[rows["place"] == k, "weight"].iloc[0]) for k in (-1, -2))
    rest = rows[rows["place"] >= 0]
    return Model(rest["place"].to_numpy(np.int64), rest["weight"].to_numpy(np.float32), scale, shift)


_EXTRA = ("n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
          "base_failed boolean, probability double, kept boolean")


def _scan_mapper(shared, bits: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        weights = np.zeros(3 << bits, np.float32)
        weights[model.place] = model.weight
        for row, text in K.row_chunks(batches, K.CHUNK_BYTES // 2):
            c = count(text, bits)
            p = _sigmoid(raw_score(c, weights) * model.scale + model.shift)
            cols = [c.n_words, c.word_chars, c.n_symbols, c.n_dup_lines, c.n_repeat_words, c.base_failed, p,
                    ~c.base_failed & (p >= MIN_PROBABILITY)]
            yield pa.RecordBatch.from_arrays([row, *map(pa.array, cols)], names=["row", *(x.split()[0] for x in _EXTRA.split(", "))])
    return run


def scan(docs: DataFrame, model: Model, bits: int = BITS, columns: tuple[str, ...] = ()) -> DataFrame:
    """``row`` (all columns of ``docs`` or ``columns``), the base counts of words
    (runs of anything but ASCII white space), ``base_failed``, the calibrated
    ``probability`` of good quality, and ``kept``."""
    rows = K.as_rows(docs, *columns)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return rows.mapInArrow(_scan_mapper(shared, bits), f"row {K.row_type(rows)}, {_EXTRA}")
