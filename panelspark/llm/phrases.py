"""Operator 12: phrase collocation mining by dynamic itemset counting.

Documents are dealt to ``shards``, which are scanned in a cycle, one shard a
step.  Words are counted from the first step on.  A longer phrase is activated
after the step in which both its subphrases (all words but the last, all but the
first) have reached ``least``, and is then counted in each of the next
``shards`` steps: one full cycle, so every document is read for it once.  One
step thus counts phrases of all lengths side by side.  The scans end when no
activated phrase is left without its full cycle.

The running counts stay in Spark, under 58 bits of a hash, with the step that the
phrase began in.  A scan learns what is active from one bit table for each step
and length, sized by the number of phrases that it holds and never over
``MAX_BITS``; a table's false positives activate phrases too early for nothing,
always for the same cycle, and change no result.  A last scan then counts the
phrases found, and those alone, by their words, so counts are exact whatever the
hashes do.

Scores: a cut of a phrase with count ``a`` gives ``floor(scale * a / (l + r))``,
in decimals of 38 digits; the lowest-scoring cut counts, then the first.
Phrases that lie inside a longer one of at least 80 % of their count go.

Cases: null and empty texts and texts of delimiters have no words; a null lang is
``und``, the same group as rows that say so; repeated rows count each time;
extra columns are not read; an empty table, or one without a phrase of ``least``
occurrences, gives an empty result.  Ties of score and count go by the phrase's
UTF-8 bytes, so ranks have no ties.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelspark.llm import textkit as K
from panelspark.llm.tables import written

#: Fixed values of the contract.
LEAST, LONGEST, SCALE, INSIDE, TOP = 30, 4, 2_000_000, 80, 2000
#: Shards of a cycle.  A step has four bits of a count's key, so at most 4.
SHARDS = 2
#: Bits of one table of active phrases: 32 a phrase, and at most 2 ** MAX_BITS (16 MB).
MAX_BITS = 27

_BREAK = K._byte_class(b".,;:!?\n\x0b\x0c\r")
_WORD = ~(_BREAK | K._byte_class(b" \t"))
_ODD = np.uint64(0xD6E8FEB86659FD93)
_LOW = np.uint64(63)  # of a key: four bits of the first step, two of the length
_NEVER = np.uint8(255)


class Words:
    """The words of a slice: ``word`` (place in ``spelled``), ``row``, ``lang`` (place
    in ``langs``) and ``runs[n]``, whether n words from each one lie in one piece."""

    def __init__(self, text: pa.Array, lang: pa.Array):
        buf, off = K.text_bytes(text)
        buf = K.lower(buf)
        start, end, row = K.word_spans(buf, off, _WORD)
        named = pc.fill_null(lang.cast(pa.string()), "und").dictionary_encode()
        self.langs, self.lang = named.dictionary, named.indices.to_numpy()[row].astype(np.int64)
        data = buf[_WORD[buf]]
        ends = np.concatenate([[0], np.cumsum(end - start)]).astype(np.int64)
        spelled = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(start), [None, pa.py_buffer(ends), pa.py_buffer(data)]).dictionary_encode()
        self.spelled, self.word = spelled.dictionary, spelled.indices.to_numpy().astype(np.int64)
        breaks = np.concatenate([[0], np.cumsum(_BREAK[buf])])
        near = (row[1:] == row[:-1]) & (breaks[start[1:]] == breaks[end[:-1]])
        self.runs = {1: np.ones(len(start), bool)}
        for n in range(2, LONGEST + 1):
            below = self.runs[n - 1]
            self.runs[n] = below[:-1] & near[n - 2:] if len(below) > 1 else np.zeros(0, bool)

    def hashes(self) -> dict[int, np.ndarray]:
        """For each length the hash of the phrase from every word on (lang included)."""
        _, offsets, data = self.spelled.buffers()
        offsets = np.frombuffer(offsets, np.int64, len(self.spelled) + 1)
        spelled = K.span_hash(np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8), offsets[:-1], offsets[1:])
        langs = np.array([K.span_hash(np.frombuffer(s.encode(), np.uint8), np.array([0]), np.array([len(s.encode())]))[0]
                          for s in self.langs.to_pylist()] or [0], np.uint64)
        one = K.mix(spelled[self.word] ^ langs[self.lang])
        found = {1: one}
        for n in range(2, LONGEST + 1):
            found[n] = K.mix(found[n - 1][:-1] * _ODD ^ one[n - 1:], n)
        return found


def _slices(batches: Iterable[pa.RecordBatch]) -> Iterator[Words]:
    for batch in batches:
        for part in K.chunks(batch, "text"):
            yield Words(part.column("text"), part.column("lang"))


def _holds(table: np.ndarray, hashed: np.ndarray) -> np.ndarray:
    at = (hashed >> np.uint64(6)) & np.uint64(len(table) * 64 - 1)
    return (table[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))) & np.uint64(1) == 1


def _count_mapper(tables, step: int, shards: int):
    """Counts of the phrases that are in their cycle at ``step``, by key."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        active = {n: [(at, held.value) for at, held in found] for n, found in tables.items()}
        for words in _slices(batches):
            hashed, keys = words.hashes(), []
            if step < shards:
                keys.append(hashed[1] & ~_LOW)
            for n in range(2, LONGEST + 1):
                if not active.get(n - 1):
                    break
                below = hashed[n - 1]
                since = np.full(len(below), _NEVER)
                for at, table in reversed(active[n - 1]):
                    since[_holds(table, below)] = at
                # both subphrases active since `at`: counted in the steps at + 1 to at + shards
                begun = np.maximum(since[:-1], since[1:])[:len(hashed[n])]
                due = np.flatnonzero(words.runs[n] & (begun != _NEVER) & (begun + np.int64(shards) >= step))
                keys.append(hashed[n][due] & ~_LOW | (begun[due].astype(np.uint64) + np.uint64(1)) << np.uint64(2) | np.uint64(n - 1))
            key, times = np.unique(np.concatenate(keys) if keys else np.zeros(0, np.uint64), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(times.astype(np.int64))], names=["key", "times"])
    return run


def _bit_table(keys: DataFrame, count: int) -> np.ndarray:
    """The keys' hashes as bits; the driver sees its words, at most 2 ** (MAX_BITS - 6)."""
    bits = min(MAX_BITS, max(12, int(count * 32 - 1).bit_length()))
    bit = F.shiftrightunsigned("key", 6).bitwiseAND((1 << bits) - 1)
    words = keys.select(F.shiftright(bit, 6).alias("word"), F.expr("shiftleft(1L, int(shiftrightunsigned(key, 6) & 63))").alias("mask")) \
        .groupBy("word").agg(F.bit_or("mask").alias("mask")).toArrow()
    table = np.zeros(1 << (bits - 6), np.uint64)
    table[words["word"].to_numpy()] = words["mask"].to_numpy().view(np.uint64)
    return table


def _tables(spark, keys: DataFrame, sizes: range) -> dict[int, object]:
    """A broadcast bit table for each length that has keys."""
    length = (F.col("key").bitwiseAND(3) + 1).alias("n")
    counts = {r["n"]: r["count"] for r in keys.groupBy(length).count().collect() if r["n"] in sizes}
    return {n: spark.sparkContext.broadcast(_bit_table(keys.where(length == n), counts[n])) for n in sorted(counts)}


def frequent(docs: DataFrame, least: int = LEAST, shards: int = SHARDS) -> DataFrame:
    """``key`` of every phrase of at least ``least`` occurrences (and, rarely, of
    phrases whose keys collide), by dynamic itemset counting.  ``docs`` has
    ``lang, text``; jobs run while this is built."""
    spark = docs.sparkSession
    lines = written(docs.select("lang", "text").withColumn("shard", F.pmod(F.xxhash64("lang", "text", F.rand(12)), F.lit(shards))), "lines")
    since = F.shiftright("key", 2).bitwiseAND(15)
    tables: dict[int, list] = {n: [] for n in range(1, LONGEST)}
    running, complete = None, None
    step, last = 0, shards - 1
    while step <= last:
        scanned = lines.where(F.col("shard") == step % shards).select("lang", "text") \
            .mapInArrow(_count_mapper(tables, step, shards), "key long, times long").withColumn("before", F.lit(0).cast("long"))
        if running is not None:
            scanned = running.select("key", "times", F.col("times").alias("before")).unionByName(scanned)
        counted = scanned.groupBy("key").agg(F.sum("times").alias("times"), F.sum("before").alias("before"))
        kept = written(counted.where((F.col("times") >= least) | (since + shards > step + 1)), "phrases")
        ended = kept.where((since + shards <= step + 1) & (F.col("times") >= least)).select("key")
        complete = ended if complete is None else complete.union(ended)
        running = kept.where(since + shards > step + 1)
        for n, table in _tables(spark, kept.where((F.col("times") >= least) & (F.col("before") < least)).select("key"), range(1, LONGEST)).items():
            tables[n].append((step, table))
            last = max(last, step + shards)
        step += 1
    for found in tables.values():
        for _, table in found:
            table.destroy()
    return complete


def _confirm_mapper(tables):
    """Counts, by their words, of the phrases in the tables; and of all words of a
    lang, as the phrase of no word."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = {n: table.value for n, table in tables.items()}
        names = ["lang", "size", "phrase", "times"]
        for words in _slices(batches):
            hashed = words.hashes()
            total = np.bincount(words.lang, minlength=len(words.langs))
            yield pa.RecordBatch.from_arrays([words.langs, pa.array(np.zeros(len(total), np.int32)), pa.array([""] * len(total)),
                                              pa.array(total.astype(np.int64))], names=names)
            for n in sorted(held):
                at = np.flatnonzero(words.runs[n] & _holds(held[n], hashed[n]))
                code = words.lang[at]
                for k in range(n):  # exact: by the words' places in the slice's dictionary
                    code = np.unique(code * len(words.spelled) + words.word[at + k], return_inverse=True)[1]
                _, first, times = np.unique(code, return_index=True, return_counts=True)
                at = at[first]
                spelled = [words.spelled.take(pa.array(words.word[at + k])) for k in range(n)]
                phrase = pc.binary_join_element_wise(*spelled, pa.scalar(b" ", pa.large_binary()))
                yield pa.RecordBatch.from_arrays([words.langs.take(pa.array(words.lang[at])), pa.array(np.full(len(at), n, np.int32)),
                                                  phrase.cast(pa.large_string()).cast(pa.string()), pa.array(times.astype(np.int64))], names=names)
    return run


def counts(docs: DataFrame, least: int = LEAST, shards: int = SHARDS) -> DataFrame:
    """``lang, size, phrase, times``: exact counts of the phrases of at least
    ``least`` occurrences, and of all words of each lang (size 0)."""
    docs = docs.select(docs["lang"].cast("string").alias("lang"), docs["text"].alias("text"))
    tables = _tables(docs.sparkSession, written(frequent(docs, least, shards), "frequent"), range(1, LONGEST + 1))
    found = docs.mapInArrow(_confirm_mapper(tables), "lang string, size int, phrase string, times long")
    return written(found.groupBy("lang", "size", "phrase").agg(F.sum("times").alias("times"))
                   .where((F.col("times") >= least) | (F.col("size") == 0)), "counts")


def _part(lo, size):
    return F.array_join(F.slice("words", lo, size), " ")


def collocations(docs: DataFrame, least: int = LEAST, top: int = TOP, shards: int = SHARDS) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: the ``top`` phrases of every lang."""
    counted = counts(docs, least, shards)
    phrases = counted.where("size > 1").select("lang", "size", "phrase", F.col("times").alias("a")).withColumn("words", F.split("phrase", " "))
    # Longest count of a longer candidate around each phrase.
    inner = phrases.where("size > 2").withColumn("m", F.explode(F.sequence(F.lit(2), F.col("size") - 1))) \
        .withColumn("at", F.explode(F.sequence(F.lit(1), F.col("size") - F.col("m") + 1))) \
        .groupBy("lang", _part(F.col("at"), F.col("m")).alias("phrase")).agg(F.max("a").alias("around"))
    left = phrases.join(inner, ["lang", "phrase"], "left").where(F.coalesce(100 * F.col("around") < INSIDE * F.col("a"), F.lit(True)))
    known = counted.where("size > 0").select("lang", "phrase", "times")
    cuts = left.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("size") - 1))) \
        .select("lang", "phrase", "a", "k", _part(F.lit(1), F.col("k")).alias("head"), _part(F.col("k") + 1, F.col("size") - F.col("k")).alias("tail"))
    cuts = cuts.join(known.select("lang", F.col("phrase").alias("head"), F.col("times").alias("l")), ["lang", "head"]) \
        .join(known.select("lang", F.col("phrase").alias("tail"), F.col("times").alias("r")), ["lang", "tail"])
    exact = F.expr(f"CAST({SCALE} AS DECIMAL(7,0)) * CAST(a AS DECIMAL(19,0)) div (CAST(l AS DECIMAL(19,0)) + CAST(r AS DECIMAL(19,0)))")
    scored = cuts.groupBy("lang", "phrase").agg(F.max("a").alias("a"), F.min(F.struct(exact.alias("score"), "k", "l", "r")).alias("cut")) \
        .select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")
    # Two steps, so that no lang's candidates meet in one task.
    best = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    for keys in ([F.col("lang"), F.pmod(F.xxhash64("phrase"), F.lit(64))], [F.col("lang")]):
        scored = scored.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*best))).where(F.col("rank") <= top)
    totals = counted.where("size = 0").select("lang", F.col("times").alias("n"))
    return scored.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
