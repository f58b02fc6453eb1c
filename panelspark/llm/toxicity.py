"""Operator 3: toxicity by FTRL-proximal logistic regression.

Features are hashed word unigrams, bigrams and skip-grams (pairs with one or two
words between), each at most once a document; a unigram also stands for its
stems (its first 4, 6, 7 and 8 bytes), as insults are inflected and compounded.
Nothing but the text is read.
Training is online FTRL-proximal (per-coordinate rates, L1 and L2): it runs over
a bounded sample of labelled rows (``max_rows``, picked by a hash of doc_id),
whose features are made in parallel and learned in one task.  L1 leaves few
non-zero weights; these are broadcast (at most ``2 ** bits`` pairs), and every
document is scored in numpy over Arrow slices.

Cases: null or empty texts score the bias alone.  Rows of ``labels`` without a
doc_id or a label are not learned; of several labels of one doc_id the largest
counts.  Without any labelled row all scores are 0.5.  Repeated documents get
equal scores.  Columns of any name are carried along unread.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelspark.llm import textkit as K

#: Hash bits of the feature space.
BITS = 22
#: Labelled rows that are learned, about (they are picked by hash).
MAX_ROWS = 20_000
THRESHOLD = 0.3
_SKIPS = (2, 3)
_STEMS = (4, 6, 7, 8)


def features(text: pa.Array, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, feature) of all grams of an Arrow column, repeats included."""
    buf, off = K.text_bytes(text)
    buf = K.lower(buf)
    start, end, row = K.word_spans(buf, off, K.ALNUM)
    word = K.span_hash(buf, start, end)
    rows, grams = [row], [K.mix(word, 1)]
    for size in _STEMS:
        rows.append(row)
        grams.append(K.mix(K.span_hash(buf, start, np.minimum(end, start + size)), 100 + size))
    for gap in (1, *_SKIPS):
        same = K.same_row(row, gap + 1)
        n = len(same)
        pair = K.mix(word[:n] + K.mix(word[gap:], gap) * np.uint64(3), gap)
        rows.append(row[:n][same])
        grams.append(pair[same])
    return np.concatenate(rows), (np.concatenate(grams) >> np.uint64(64 - bits)).astype(np.int64)


def _distinct(row: np.ndarray, gram: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    key = np.unique((row << bits) | gram)
    return key >> bits, key & ((1 << bits) - 1)


def _feature_mapper(bits: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in K.chunks(batch, "text"):
                row, gram = _distinct(*features(part.column("text"), bits), bits)
                ends = np.searchsorted(row, np.arange(part.num_rows + 1))
                yield pa.RecordBatch.from_arrays(
                    [part.column("pick"), part.column("label"),
                     pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(gram.astype(np.int32)))],
                    names=["pick", "label", "grams"])
    return run


def ftrl(examples: list[tuple[np.ndarray, int]], bits: int, alpha: float = 0.1, beta: float = 1.0,
         l1: float = 3.0, l2: float = 1.0, epochs: int = 3) -> tuple[np.ndarray, np.ndarray]:
    """FTRL-proximal weights (non-zero places and values); the last place is the bias."""
    size = (1 << bits) + 1
    z, n = np.zeros(size), np.zeros(size)

    def weights(at: np.ndarray) -> np.ndarray:
        zs = z[at]
        w = -(zs - np.sign(zs) * l1) / ((beta + np.sqrt(n[at])) / alpha + l2)
        return np.where(np.abs(zs) <= l1, 0.0, w)

    for _ in range(epochs):
        for grams, label in examples:
            at = np.append(grams, size - 1)
            w = weights(at)
            gradient = 1 / (1 + np.exp(-np.clip(w.sum(), -35, 35))) - label
            squares = n[at]
            sigma = (np.sqrt(squares + gradient * gradient) - np.sqrt(squares)) / alpha
            z[at] += gradient - sigma * w
            n[at] += gradient * gradient
    every = np.flatnonzero(np.abs(z) > l1)
    return every, weights(every)


def _train_mapper(bits: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        examples = []
        for batch in batches:
            grams = batch.column("grams")
            flat, off = grams.flatten().to_numpy(), grams.offsets.to_numpy()
            off = off - off[0]
            for label, a, b in zip(batch.column("label").to_pylist(), off[:-1], off[1:]):
                examples.append((flat[a:b], label))
        place, weight = ftrl(examples, bits)
        yield pa.RecordBatch.from_arrays([pa.array(place, pa.int64()), pa.array(weight)], names=["place", "weight"])
    return run


def sample(docs: DataFrame, labels: DataFrame, label: str, learn: Column | None, max_rows: int) -> DataFrame:
    """``pick, label, text`` of about ``max_rows`` labelled documents, all if there
    are fewer.  ``learn`` is a condition on ``doc_id``.  The picked labels are
    bounded by ``max_rows`` and so are broadcast; texts stay where they are."""
    known = labels.select(labels["doc_id"], labels[label].cast("int").alias("label")).where("doc_id IS NOT NULL AND label IS NOT NULL")
    if learn is not None:
        known = known.where(learn)
    known = known.groupBy("doc_id").agg(F.max("label").alias("label")).withColumn("pick", F.xxhash64("doc_id"))
    n = known.count()
    if n > max_rows:
        known = known.where(F.pmod("pick", F.lit(1 << 30)) < int(max_rows / n * (1 << 30)))
    return docs.select(docs["doc_id"], docs["text"]).join(F.broadcast(known), "doc_id").select("pick", "label", "text")


def train(docs: DataFrame, labels: DataFrame, learn: Column | None = None, label: str = "toxic",
          bits: int = BITS, max_rows: int = MAX_ROWS) -> tuple[np.ndarray, np.ndarray]:
    """Places and values of the non-zero weights (the bias is at ``2 ** bits``)."""
    made = sample(docs, labels, label, learn, max_rows).mapInArrow(_feature_mapper(bits), "pick long, label int, grams array<int>")
    rows = made.repartition(1).sortWithinPartitions("pick", "label", "grams") \
        .mapInArrow(_train_mapper(bits), "place long, weight double").toPandas()
    return rows["place"].to_numpy(np.int64), rows["weight"].to_numpy(np.float64)


def _score_mapper(shared, bits: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, weight = shared.value
        dense = np.zeros((1 << bits) + 1, np.float32)
        dense[place] = weight
        for row, text in K.row_chunks(batches):
            doc, gram = features(text, bits)
            known = dense[gram] != 0
            doc, gram = _distinct(doc[known], gram[known], bits)
            total = np.bincount(doc, weights=dense[gram], minlength=len(row)) + float(dense[-1])
            yield pa.RecordBatch.from_arrays([row, pa.array(1 / (1 + np.exp(-np.clip(total, -35, 35))))], names=["row", "score"])
    return run


def score(docs: DataFrame, model: tuple[np.ndarray, np.ndarray], bits: int = BITS, columns: tuple[str, ...] = ()) -> DataFrame:
    """``row`` (all columns of ``docs`` or ``columns``) and ``score`` in [0, 1]."""
    rows = K.as_rows(docs, *columns)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return rows.mapInArrow(_score_mapper(shared, bits), f"row {K.row_type(rows)}, score double")


def held_out(doc_id: Column) -> Column:
    """The quarter of doc_ids that is never learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))
