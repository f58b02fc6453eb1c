"""Operator 4: LM scoring by cross-entropy difference.

Two bigram models, one of the target corpus and one of the background, share one
vocabulary, one set of bigrams and one smoothing; a document's score is the mean
over its words of the target's loss minus the background's (nats; the lower, the
more target-like).

All counts are taken over all documents, and all words and bigrams are kept: both
tables grow with the corpus and stay in Spark.  Only a bounded *head* of them, the
most frequent ones, is broadcast.  A document's bigrams in the head are scored where
its text is read.  Of the documents that were learned, the others are dealt by
bigram, packed: where all occurrences of a bigram meet, it is counted, and its loss
goes back to the documents in sums, packed by part and bundle of documents.  What has a word outside the head is
dealt by that word, so the word is counted there too; only two such words in a row
take a join for the second one's count.  For other documents, and bounded models,
bigrams are counted in the document, joined to the table's losses and summed.  What
is in the head changes the cost and no score.  Target documents are known by a bit
table of fixed size and a list of what it takes for one, so texts are not shuffled.  A caller may
bound the model by ``max_words`` (others are one unknown word) and ``max_bigrams``
(others back off to unigrams, in both models).  For heads and bounds alike the least
count within the limit is read off a histogram of the counts, so all words (bigrams)
of one count class share their fate.

P(b | a) = LAMBDA * c(a b) / c(a) + (1 - LAMBDA) * P(b), and
P(b) = (c(b) + 1) / (N + size of the vocabulary + 1); an unseen context leaves P(b).

Words are runs of letters, digits and bytes beyond ASCII, A-Z lower-cased, told by
a hash of 64 bits; the first word's context is the start of the text.  Cases: a text
without words has n_tokens 0 and losses 0.  Without target rows the target model is
uniform.  Repeated rows count, and are scored, row by row.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelspark.llm import textkit as K
from panelspark.llm.tables import written

#: What is broadcast, at most.
HEAD_WORDS = 1 << 16
HEAD_BIGRAMS = 1 << 18
#: Occurrences in one slice that make a bigram a candidate of the head.
HOT = 4
#: Bits of the broadcast table of target documents (8 MB).
FILTER_BITS = 26
#: Words of text that one part of the dealt bigrams stands for.
PART_WORDS = 2 << 20
LAMBDA = 0.7
#: Count classes a factor of two.
_CLASSES = 8
#: Stand for the start of a text and for a word that ``max_words`` left out.
_START, _UNKNOWN = np.uint64(0), np.uint64(1)


@dataclass
class Table:
    """Rows in Spark, counted when asked."""
    rows: DataFrame

    def __len__(self) -> int:
        return self.rows.count()


@dataclass
class Vocabulary:
    words: Table                # ``key, n, target``: words that are kept
    counts: DataFrame           # the same, and the start of a text and the unknown word
    head: DataFrame             # the most frequent of ``counts``
    only: np.ndarray | None     # sorted hashes of the words of a bounded model
    total: tuple[int, int]      # words in the background and in the target
    size: int

    def chance(self, n: Column, target: Column) -> tuple[Column, Column]:
        return tuple((c + 1) / F.lit(float(total + self.size + 1)) for c, total in zip((n, target), self.total))


@dataclass
class Head:
    """Losses of the most frequent bigrams, sorted by ``pair``."""
    pair: np.ndarray
    before: np.ndarray
    word: np.ndarray
    loss: np.ndarray  # background and target of each


@dataclass
class Model:
    docs: DataFrame         # what it was trained on
    wanted: Broadcast       # which of them are target documents
    vocabulary: Vocabulary
    max_bigrams: int | None
    head: Head | None = None

    @cached_property
    def _counts(self) -> DataFrame:
        only = self.vocabulary.only
        shared = self.docs.sparkSession.sparkContext.broadcast(only) if only is not None else None
        return written(_spotted(self.docs).mapInArrow(_count_mapper(self.wanted, shared, True), "a long, b long, n long, target long")
                       .groupBy("a", "b").agg(F.sum("n").alias("n"), F.sum("target").alias("target")), "bigrams")

    @cached_property
    def _kept(self) -> Column:
        return _frequent(self._counts, self.max_bigrams)

    @cached_property
    def bigrams(self) -> Table:
        """``a, b, n, target``: bigrams that are kept."""
        return Table(self._counts.where(self._kept))

    @cached_property
    def pairs(self) -> DataFrame:
        """All bigrams; counts of those that are not kept are 0."""
        return self._bounded(self._counts)

    def frequent(self, limit: int) -> DataFrame:
        """The most frequent of ``pairs``."""
        return self._bounded(self._counts.where(_frequent(self._counts, limit)))

    def _bounded(self, counts: DataFrame) -> DataFrame:
        if self.max_bigrams is None:
            return counts
        return counts.select("a", "b", *[F.when(self._kept, F.col(x)).otherwise(0).alias(x) for x in ("n", "target")])


def _spotted(docs: DataFrame) -> DataFrame:
    """``name, doc_id, spot, text``: the spot is the id's place in the table of targets."""
    return docs.select(F.xxhash64(docs["doc_id"], docs["text"]).alias("name"), docs["doc_id"].cast("long").alias("doc_id"),
                       _spot(docs["doc_id"]).alias("spot"), docs["text"].alias("text"))


def _spot(doc_id: Column) -> Column:
    return F.xxhash64(doc_id.cast("long")).bitwiseAND((1 << FILTER_BITS) - 1)


def _is_target(wanted: tuple[np.ndarray, np.ndarray], batch: pa.RecordBatch) -> np.ndarray:
    """Of every row, whether its document is a target one."""
    bits, mistaken = wanted
    spot = batch.column("spot").to_numpy(zero_copy_only=False).astype(np.int64)
    hit = (bits[spot >> 6] >> (spot & 63).astype(np.uint64)) & np.uint64(1) == 1
    known = batch.column("doc_id").is_valid().to_numpy(zero_copy_only=False)
    return hit & known & ~np.isin(batch.column("doc_id").fill_null(0).to_numpy(), mistaken)


def _targets(docs: DataFrame, target: DataFrame) -> Broadcast:
    """A bit table of the target ids, and the ids of other documents that it hits."""
    context = docs.sparkSession.sparkContext
    wanted = target.select(F.col("doc_id").cast("long").alias("doc_id")).where("doc_id IS NOT NULL").distinct()
    words = wanted.select(_spot(F.col("doc_id")).alias("spot")).select(
        F.shiftright("spot", 6).alias("word"), F.expr("shiftleft(1L, int(spot & 63))").alias("mask")) \
        .groupBy("word").agg(F.bit_or("mask").alias("mask")).toPandas()
    bits = np.zeros(1 << (FILTER_BITS - 6), np.uint64)
    bits[words["word"].to_numpy(np.int64)] = words["mask"].to_numpy(np.int64).view(np.uint64)
    shared = context.broadcast((bits, np.zeros(0, np.int64)))

    def hit(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.select(["doc_id"]).filter(pa.array(_is_target(shared.value, batch)))

    mistaken = _spotted(docs).select("doc_id", "spot").mapInArrow(hit, "doc_id long").join(wanted.hint("merge"), "doc_id", "left_anti").distinct()
    return context.broadcast((bits, np.sort(mistaken.toPandas()["doc_id"].to_numpy(np.int64))))


def _words(text: pa.Array, only: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    buf, off = K.text_bytes(text)
    buf = K.lower(buf)
    start, end, row = K.word_spans(buf, off, K.ALNUM)
    word = K.span_hash(buf, start, end)
    return row, word if only is None else np.where(np.isin(word, only), word, _UNKNOWN)


def _first(row: np.ndarray) -> np.ndarray:
    first = np.ones(len(row), bool)
    first[1:] = row[1:] != row[:-1]
    return first


def _before(row: np.ndarray, word: np.ndarray) -> np.ndarray:
    return np.where(_first(row), _START, np.roll(word, 1))


def _pair(before: np.ndarray, word: np.ndarray) -> np.ndarray:
    return K.mix(K.mix(before, 3) + word, 4)


def _changes(*sorted_: np.ndarray) -> np.ndarray:
    """Where a run of equal rows begins."""
    new = np.zeros(len(sorted_[0]), bool)
    new[:1] = True
    for x in sorted_:
        new[1:] |= x[1:] != x[:-1]
    return np.flatnonzero(new)


def _long(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64) if x.dtype == np.uint64 else x.astype(np.int64))


def _counted(keys: list[np.ndarray], target: np.ndarray, names: list[str]) -> pa.RecordBatch:
    order = np.lexsort(keys[::-1]) if len(keys) > 1 else np.argsort(keys[0], kind="stable")
    keys, target = [k[order] for k in keys], target[order].astype(np.int64)
    at = _changes(*keys)
    n = np.diff(np.append(at, len(order)))
    wanted = np.add.reduceat(target, at) if len(at) else target
    return pa.RecordBatch.from_arrays([*(_long(k[at]) for k in keys), _long(n), _long(wanted)], names=[*names, "n", "target"])


def _count_mapper(wanted: Broadcast, only: Broadcast | None, pairs: bool):
    """Counts in each slice: of bigrams, or of words, the start of a text among them,
    (``b`` is null) and of those bigrams that are frequent in the slice."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = only.value if only is not None else None
        for batch in batches:
            for part in K.chunks(batch, "text", 2 * K.CHUNK_BYTES):
                row, word = _words(part.column("text"), known)
                target = _is_target(wanted.value, part)[row]
                both = _counted([_before(row, word), word], target, ["a", "b"])
                if pairs:
                    yield both
                    continue
                first = _first(row)
                single = _counted([np.concatenate([word, np.full(first.sum(), _START)])], np.concatenate([target, target[first]]), ["a"])
                yield pa.RecordBatch.from_arrays([single.column("a"), pa.nulls(single.num_rows, pa.int64()), single.column("n"), single.column("target")],
                                                 names=both.schema.names)
                yield both.filter(pc.greater_equal(both.column("n"), HOT))
    return run


def _hot_mapper(wanted: Broadcast, hot: Broadcast):
    """Counts of the bigrams of ``hot`` in each slice."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in K.chunks(batch, "text", 2 * K.CHUNK_BYTES):
                row, word = _words(part.column("text"), None)
                before = _before(row, word)
                known = _in_head(hot.value, before, word)[1]
                yield _counted([before[known], word[known]], _is_target(wanted.value, part)[row[known]], ["a", "b"])
    return run


def _kind() -> Column:
    return F.floor(F.log2("n") * _CLASSES).cast("int")


def _frequent(counted: DataFrame, limit: int | None) -> Column:
    """Whether a row's count class is high enough that at most ``limit`` are left (None: all are)."""
    if limit is None:
        return F.lit(True)
    histogram = counted.groupBy(_kind().alias("kind")).count().orderBy(F.desc("kind")).collect()  # a few hundred rows
    total, least = 0, None
    for r in histogram:
        total += r["count"]
        if total > limit:
            break
        least = r["kind"]
    return F.lit(False) if least is None else _kind() >= least


def train(docs: DataFrame, target: DataFrame, max_words: int | None = None, max_bigrams: int | None = None,
          head_words: int = HEAD_WORDS, head_bigrams: int = HEAD_BIGRAMS) -> Model:
    """Models of ``docs`` (the background) and of those whose doc_id is in ``target``."""
    context = docs.sparkSession.sparkContext
    wanted = _targets(docs, target)
    sums = F.sum("n").alias("n"), F.sum("target").alias("target")

    table = written(_spotted(docs).mapInArrow(_count_mapper(wanted, None, False), "a long, b long, n long, target long").groupBy("a", "b").agg(*sums), "words")
    counts = table.where("b IS NULL").select(F.col("a").alias("key"), "n", "target")
    start, unknown = (F.lit(int(x)).cast("long") for x in (_START, _UNKNOWN))
    words = counts.where(F.col("key") != start)
    every = words.agg(*sums).first()
    only = None
    if max_words is not None:
        kept = _frequent(words, max_words)
        words = words.where(kept)
        only = np.sort(words.select("key").toPandas()["key"].to_numpy(np.int64).view(np.uint64))
        counts = counts.withColumn("key", F.when(kept | (F.col("key") == start), F.col("key")).otherwise(unknown)).groupBy("key").agg(*sums)
    vocabulary = Vocabulary(Table(words), counts, counts.where(_frequent(counts, head_words) | (F.col("key") == start)),
                            only, tuple(x or 0 for x in every), words.count())

    model = Model(docs, wanted, vocabulary, max_bigrams)
    if only is None and max_bigrams is None:
        often = table.where("b IS NOT NULL")
        places = _head(often.where(_frequent(often, head_bigrams)).select("a", "b", F.lit(0.0).alias("background"), F.lit(0.0).alias("wanted")))
        hot = written(_spotted(docs).mapInArrow(_hot_mapper(wanted, context.broadcast(places)), "a long, b long, n long, target long")
                      .groupBy("a", "b").agg(*sums), "hot")
    else:
        hot = model.frequent(head_bigrams)
    model.head = _head(losses(hot, vocabulary))
    return model


def _head(found: DataFrame) -> Head:
    found = found.toPandas()
    before, word = (found[x].to_numpy(np.int64).view(np.uint64) for x in ("a", "b"))
    pair = _pair(before, word)
    order = np.argsort(pair)
    return Head(pair[order], before[order], word[order], found[["background", "wanted"]].to_numpy(np.float64).reshape(-1, 2)[order])


def losses(pairs: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """``a, b, background, wanted``: the loss of b after a under the background and
    the target model, for rows ``a, b, n, target``.

    Counts of frequent words come from the broadcast head.  Only rows with another
    word are dealt by words, and only by such, so no word gathers many rows."""
    head = vocabulary.head
    of = lambda x: F.broadcast(head.select(F.col("key").alias(f"k{x}"), F.col("n").alias(f"n{x}"), F.col("target").alias(f"t{x}")))
    both = pairs.join(of("a"), F.col("a") == F.col("ka"), "left").join(of("b"), F.col("b") == F.col("kb"), "left").drop("ka", "kb")
    rare_a, rare_b = F.col("na").isNull(), F.col("nb").isNull()
    rest = both.where(rare_a | rare_b).withColumns({"ka": F.when(rare_a, F.col("a")).otherwise(F.col("b")),
                                                    "kb": F.when(rare_b, F.col("b")).otherwise(F.col("a"))})
    for x, rare in (("a", rare_a), ("b", rare_b)):
        counts = vocabulary.counts.select(F.col("key").alias("key"), F.col("n").alias("more"), F.col("target").alias("wanted")).hint("merge")
        rest = rest.join(counts, F.col(f"k{x}") == F.col("key"), "left").withColumns(
            {f"n{x}": F.when(rare, F.coalesce("more", F.lit(0))).otherwise(F.col(f"n{x}")),
             f"t{x}": F.when(rare, F.coalesce("wanted", F.lit(0))).otherwise(F.col(f"t{x}"))}).drop("key", "more", "wanted")
    found = both.where(~rare_a & ~rare_b).unionByName(rest.drop("ka", "kb"))
    return found.select("a", "b", *_loss(vocabulary))


def _loss(vocabulary: Vocabulary) -> list[Column]:
    """``background, wanted`` of rows with the counts of a bigram and its words."""
    out = []
    for seen, context, chance, name in zip(("n", "target"), ("na", "ta"), vocabulary.chance(F.col("nb"), F.col("tb")), ("background", "wanted")):
        p = F.when(F.col(context) > 0, LAMBDA * F.col(seen) / F.col(context) + (1 - LAMBDA) * chance).otherwise(chance)
        out.append((-F.log(p)).alias(name))
    return out


def _in_head(head: Head, before: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Place in the head of each bigram, and whether it is there."""
    if not len(head.pair):
        return np.zeros(len(word), np.int64), np.zeros(len(word), bool)
    at = np.minimum(np.searchsorted(head.pair, _pair(before, word)), len(head.pair) - 1)
    return at, (head.before[at] == before) & (head.word[at] == word)


def _head_mapper(shared):
    """Of every row its words, its losses within the head, and how many bigrams are not in it."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head, only = shared.value
        for batch in batches:
            for part in K.chunks(batch, "text", K.CHUNK_BYTES // 2):
                r, word = _words(part.column("text"), only)
                at, known = _in_head(head, _before(r, word), word)
                loss = head.loss[at[known]]
                count = lambda x, **a: np.bincount(x, minlength=part.num_rows, **a)
                yield pa.RecordBatch.from_arrays(
                    [part.column("row"), part.column("name"), _long(count(r)), _long(count(r[~known])),
                     *(pa.array(count(r[known], weights=loss[:, k]).astype(np.float64)) for k in (0, 1))],
                    names=["row", "name", "n_tokens", "n_rest", "background", "wanted"])
    return run


def _rest_mapper(shared):
    """The bigrams of every row that are not in the head, counted."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head, only = shared.value
        for batch in batches:
            for part in K.chunks(batch, "text", K.CHUNK_BYTES // 2):
                r, word = _words(part.column("text"), only)
                before = _before(r, word)
                rest = ~_in_head(head, before, word)[1]
                r, before, word = r[rest], before[rest], word[rest]
                order = np.lexsort((_pair(before, word), r))
                r, before, word = r[order], before[order], word[order]
                at = _changes(r, before, word)
                yield pa.RecordBatch.from_arrays(
                    [part.column("name").take(pa.array(r[at])), _long(before[at]), _long(word[at]),
                     pa.array(np.diff(np.append(at, len(r))).astype(np.int32))], names=["name", "a", "b", "times"])
    return run


#: What a packed run of a part holds: bigrams of two head words, of a rare first or
#: second word or two of them, or rare words with their counts.
_WORDS = 4


def _pack(x: np.ndarray) -> bytes:
    """Whole numbers as planes of bytes, as many as the largest needs."""
    width = max(1, -(-int(x.max()).bit_length() // 8))
    return bytes([width]) + x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T.tobytes()


def _unpack(raw: bytes) -> np.ndarray:
    planes = np.frombuffer(raw, np.uint8, offset=1).reshape(raw[0], -1)
    out = np.zeros((planes.shape[1], 8), np.uint8)
    out[:, :raw[0]] = planes.T
    return out.view("<u8").ravel()


def _place(keys: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Place of each in the sorted ``keys``, and whether it is there."""
    if not len(keys):
        return np.zeros(len(x), np.int64), np.zeros(len(x), bool)
    at = np.minimum(np.searchsorted(keys, x), len(keys) - 1)
    return at, keys[at] == x


_DEALT = "part long, kind int, a binary, b binary, doc binary, times binary, names binary"


def _deal_mapper(shared: Broadcast, wanted: Broadcast, parts: int):
    """The bigrams of every row that are not in the head, counted, and counts of words
    that are not: packed by part."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head, keys = shared.value
        for batch in batches:
            for part in K.chunks(batch, "text", 2 * K.CHUNK_BYTES):
                name = part.column("name").to_numpy()
                target = _is_target(wanted.value, part)
                r, word = _words(part.column("text"), None)
                before = _before(r, word)
                out = []
                lone = np.flatnonzero(~_place(keys, word)[1])
                if len(lone):
                    lone = lone[np.argsort(word[lone], kind="stable")]
                    at = _changes(word[lone])
                    w = word[lone][at]
                    n, t = np.diff(np.append(at, len(lone))), np.add.reduceat(target[r[lone]].astype(np.int64), at)
                    to = K.mix(w, 9) % np.uint64(parts)
                    order = np.argsort(to, kind="stable")
                    cut = _changes(to[order])
                    for x in np.split(order, cut[1:]):
                        out.append((int(to[x[0]]), _WORDS, _pack(w[x]), b"", _pack(t[x]), _pack(n[x]), b""))
                rest = np.flatnonzero(~_in_head(head, before, word)[1])
                r, before, word = r[rest], before[rest], word[rest]
                (at_a, has_a), (at_b, has_b) = _place(keys, before), _place(keys, word)
                a, b = np.where(has_a, at_a.astype(np.uint64), before), np.where(has_b, at_b.astype(np.uint64), word)
                kind = (~has_a).astype(np.int64) + 2 * ~has_b
                to = K.mix(np.where(has_a, np.where(has_b, K.mix(a, 7) + b, b), a), 9) % np.uint64(parts)
                to = to.astype(np.int64) * _WORDS + kind
                order = np.lexsort((r, b, a, to))
                r, a, b, to = r[order], a[order], b[order], to[order]
                at = _changes(r, a, b, to)
                times = np.diff(np.append(at, len(order)))
                r, a, b, to = r[at], a[at], b[at], to[at]
                for x in np.split(np.arange(len(to)), _changes(to)[1:]) if len(to) else ():
                    docs, doc = np.unique(r[x], return_inverse=True)
                    # the flag of a document is the lowest bit of its place
                    names = np.ascontiguousarray(name[docs])
                    out.append((int(to[x[0]]) // _WORDS, int(to[x[0]]) % _WORDS, _pack(a[x]), _pack(b[x]),
                                _pack(doc * 2 + target[docs][doc]), _pack(times[x]), names.tobytes()))
                if out:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), pa.int32(), *[pa.binary()] * 5))],
                        names=["part", "kind", "a", "b", "doc", "times", "names"])
    return run


_SUMS = "bundle long, names binary, found binary, sums binary, name long, times long, b long, n long, target long, na long, ta long"
_UNITED = "n_found long, background double, wanted double, name long, times long, b long, n long, target long, na long, ta long"


def _part_sums(shared: Broadcast, bundles: int):
    """The documents' losses within one part, packed by bundles of documents, and
    their bigrams of two rare words, of which the part does not know the second
    one's counts."""
    def run(group: pa.Table) -> pa.Table:
        keys, head_counts, size, total = shared.value
        group = group.combine_chunks()
        kinds = group.column("kind").to_numpy()
        read = {c: group.column(c).to_pylist() for c in ("a", "b", "doc", "times", "names")}
        lone = np.flatnonzero(kinds == _WORDS)
        words, lone_counts = np.zeros(0, np.uint64), np.zeros((0, 2), np.int64)
        if len(lone):
            w, t, n = (np.concatenate([_unpack(read[c][k]) for k in lone]) for c in ("a", "doc", "times"))
            words, which = np.unique(w, return_inverse=True)
            lone_counts = np.stack([np.bincount(which, weights=x) for x in (n, t)], axis=1).astype(np.int64)
        of = lambda x, rare: lone_counts[_place(words, x)[0]] if rare else head_counts[x.astype(np.int64)]
        names, found, sums, left = [], [], [], []
        for kind in range(_WORDS):
            rows = np.flatnonzero(kinds == kind)
            if not len(rows):
                continue
            a, b, doc, times = ([_unpack(read[c][k]) for k in rows] for c in ("a", "b", "doc", "times"))
            called = [np.frombuffer(read["names"][k], np.int64) for k in rows]
            base = np.concatenate([[0], np.cumsum([len(x) for x in called])])
            name = np.concatenate(called)
            flag = (np.concatenate(doc) & np.uint64(1)).astype(np.int64)
            doc = np.concatenate([(x >> np.uint64(1)).astype(np.int64) + lead for x, lead in zip(doc, base)])
            a, b, times = np.concatenate(a), np.concatenate(b), np.concatenate(times).astype(np.int64)
            order = np.lexsort((b, a))
            a, b, doc, times, flag = a[order], b[order], doc[order], times[order], flag[order]
            at = _changes(a, b)
            count = np.diff(np.append(at, len(order)))
            seen = np.stack([np.add.reduceat(x, at) for x in (times, times * flag)], axis=1)
            context = of(a[at], kind & 1)
            if kind == 3:
                each = np.repeat(np.concatenate([seen, context], axis=1), count, axis=0)
                left.append([name[doc], times, b, *each.T])
                continue
            chance = (of(b[at], kind & 2) + 1) / (np.array(total) + size + 1.0)
            with np.errstate(divide="ignore", invalid="ignore"):
                p = np.where(context > 0, LAMBDA * seen / context + (1 - LAMBDA) * chance, chance)
            loss = np.repeat(-np.log(p), count, axis=0)
            names.append(name)
            found.append(np.bincount(doc, weights=times, minlength=len(name)))
            sums.append(np.stack([np.bincount(doc, weights=times * loss[:, k], minlength=len(name)) for k in (0, 1)], axis=1))
        types = {"binary": pa.binary(), "long": pa.int64()}
        schema = pa.schema([(c, types[t]) for c, t in (x.split() for x in _SUMS.split(", "))])
        tables = []
        if names:
            name, which = np.unique(np.concatenate(names), return_inverse=True)
            found, sums = _summed(which, np.concatenate(found), np.concatenate(sums))
            bundle = K.mix(name.view(np.uint64), 10) % np.uint64(bundles)
            order = np.argsort(bundle, kind="stable")
            out = [(int(bundle[x[0]]), name[x].tobytes(), _pack(found[x].astype(np.uint64)), sums[x].tobytes())
                   for x in np.split(order, _changes(bundle[order])[1:])]
            tables.append(pa.Table.from_arrays([*map(pa.array, zip(*out)), *[pa.nulls(len(out), pa.int64())] * 7], schema=schema))
        if left:
            bundle = K.mix(left[0][0].view(np.uint64), 10) % np.uint64(bundles)
            none = [pa.nulls(len(bundle), pa.binary())] * 3
            tables.append(pa.Table.from_arrays([_long(bundle), *none, *map(_long, left[0])], schema=schema))
        return pa.concat_tables(tables) if tables else schema.empty_table()
    return run


def _summed(which: np.ndarray, found: np.ndarray, sums: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return np.bincount(which, weights=found), np.stack([np.bincount(which, weights=sums[:, k]) for k in (0, 1)], axis=1)


def _bundle_sums(group: pa.Table) -> pa.Table:
    """The documents' sums over all parts; what is left of the parts stays as it is."""
    left = group.filter(pc.is_valid(group.column("b"))).select(["name", "times", "b", "n", "target", "na", "ta"])
    packed = group.filter(pc.is_null(group.column("b")))
    read = {c: packed.column(c).to_pylist() for c in ("names", "found", "sums")}
    tables = [left]
    if packed.num_rows:
        name, which = np.unique(np.concatenate([np.frombuffer(x, np.int64) for x in read["names"]]), return_inverse=True)
        found, sums = _summed(which, np.concatenate([_unpack(x) for x in read["found"]]),
                              np.concatenate([np.frombuffer(x, np.float64) for x in read["sums"]]).reshape(-1, 2))
        tables.append(pa.table({"name": name, "n_found": found.astype(np.int64), "background": sums[:, 0], "wanted": sums[:, 1]}))
    both = pa.concat_tables(tables, promote_options="default")
    return pa.table({c: both.column(c) if c in both.column_names else pa.nulls(len(both), pa.float64() if t == "double" else pa.int64())
                     for c, t in (x.split() for x in _UNITED.split(", "))})


def _learned(docs: DataFrame, model: Model) -> DataFrame:
    """``name, n_found, background_rest, wanted_rest`` of the documents that the
    (unbounded) model was trained on: their bigrams that are not in the head."""
    context, vocabulary = docs.sparkSession.sparkContext, model.vocabulary
    head = vocabulary.head.toPandas()
    keys = head["key"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(keys)
    keys, counts = keys[order], head[["n", "target"]].to_numpy(np.int64)[order]
    parts = max(1, vocabulary.total[0] // PART_WORDS)
    dealt = _spotted(docs).mapInArrow(
        _deal_mapper(context.broadcast((model.head, keys)), model.wanted, parts), _DEALT)
    sums = written(dealt.groupBy("part").applyInArrow(
        _part_sums(context.broadcast((keys, counts, vocabulary.size, vocabulary.total)), parts), _SUMS)
        .groupBy("bundle").applyInArrow(_bundle_sums, _UNITED), "sums")
    known = sums.where("b IS NULL").select("name", "n_found", "background", "wanted")
    words = vocabulary.counts.select("key", F.col("n").alias("nb"), F.col("target").alias("tb"))
    rare = sums.where("b IS NOT NULL").select("name", "times", "b", "n", "target", "na", "ta") \
        .join(words.hint("merge"), F.col("b") == F.col("key")).select("name", "times", *_loss(vocabulary)) \
        .select("name", F.col("times").alias("n_found"), *[(F.col("times") * F.col(x)).alias(x) for x in ("background", "wanted")])
    return known.unionByName(rare).groupBy("name").agg(
        F.sum("n_found").alias("n_found"), *[F.sum(x).alias(f"{x}_rest") for x in ("background", "wanted")])


def _looked_up(rows: DataFrame, docs: DataFrame, model: Model, shared: Broadcast) -> DataFrame:
    """The same of any documents, from the model's table of bigrams."""
    rest = rows.select("name", "text").mapInArrow(
        _rest_mapper(shared), "name long, a long, b long, times int")
    found = rest.join(losses(model.pairs, model.vocabulary).hint("merge"), ["a", "b"]).select("name", "times", "background", "wanted")
    if not docs.sameSemantics(model.docs):  # else the table has every bigram
        new = rest.join(model.pairs.select("a", "b").hint("merge"), ["a", "b"], "left_anti")
        unseen = losses(new.select("a", "b").distinct().withColumns({"n": F.lit(0), "target": F.lit(0)}), model.vocabulary)
        found = found.unionByName(new.join(unseen.hint("merge"), ["a", "b"]).select("name", "times", "background", "wanted"))
    return found.groupBy("name").agg(F.sum("times").alias("n_found"), *[
        F.sum(F.col("times") * F.col(x)).alias(f"{x}_rest") for x in ("background", "wanted")])


def score(docs: DataFrame, model: Model, columns: tuple[str, ...] = ()) -> DataFrame:
    """``row`` (all columns of ``docs`` or ``columns``), ``n_tokens``, the mean
    ``target_loss`` and ``background_loss`` a word, and their difference ``score``."""
    shared = docs.sparkSession.sparkContext.broadcast((model.head, model.vocabulary.only))
    # Rows of one name have one text, and so one score.
    rows = docs.select(F.struct(*[docs[f"`{n}`"] for n in columns or docs.columns]).alias("row"),
                       F.xxhash64(docs["doc_id"], docs["text"]).alias("name"), docs["text"].alias("text"))
    heads = rows.mapInArrow(_head_mapper(shared), f"row {K.row_type(rows)}, name long, n_tokens long, n_rest long, background double, wanted double")
    learned = docs.sameSemantics(model.docs) and model.vocabulary.only is None and model.max_bigrams is None
    sums = _learned(docs, model) if learned else _looked_up(rows, docs, model, shared)
    # Repeated rows add to one sum: each takes its share.
    mean = lambda x: F.when(F.col("n_tokens") > 0, (F.col(x) + F.when(F.col("n_rest") > 0, F.col(f"{x}_rest") * (
        F.col("n_rest") / F.col("n_found"))).otherwise(0.0)) / F.col("n_tokens")).otherwise(0.0)
    return heads.join(sums.hint("merge"), "name", "left") \
        .select("row", "n_tokens", mean("wanted").alias("target_loss"), mean("background").alias("background_loss")) \
        .withColumn("score", F.col("target_loss") - F.col("background_loss"))
