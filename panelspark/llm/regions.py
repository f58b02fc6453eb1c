"""Where equal windows can be: lossless narrowing and dealing, for operator 8 and, through ``packed``, operator 2.

A text is a sequence of *units* (bytes or words), a window is ``width`` units in
a row.  The *anchor* of a window is its run of ``gram`` units with the smallest
hash (the leftmost of equal ones), so equal windows have equal anchors at equal
offsets.  The steps:

1. ``shared_anchors``: anchors are counted over all documents; those that stand
   once cannot belong to a repeated window.  The rest goes into a bit table of
   fixed size (``FILTER_BITS``), which is broadcast.  Its false positives cost
   work and change no result, however full it is.
2. For every anchor in the table, the *region* that its windows cover.  Equal
   regions are one class; a slice sends each class once, counted.
3. The operator gets all classes of one bucket of anchors, and says which runs
   of units of each class are to go.  Equal windows share their anchor, so they
   meet in one bucket.  An anchor whose classes alone would fill a bucket is dealt
   by windows instead: there each class is one window that stands more than once,
   and windows go to any bucket.  So regions that differ only at their edges (the
   ends of a passage that many documents share) do not gather in one task.
4. Runs are carried back to the rows (told by doc_id and a hash of the text, so
   that only equal rows share a name).
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelspark.llm import textkit as K
from panelspark.llm.tables import written

#: Bits of the broadcast table of shared anchors (8 MB).
FILTER_BITS = 26


@dataclass(frozen=True)
class Plan:
    """What a window is, and what makes an anchor worth a look."""
    words: bool       # units are words, else bytes
    width: int
    gram: int
    across: bool      # only repeats in other documents count
    bucket_bytes: int


@dataclass
class Units:
    row: np.ndarray
    value: np.ndarray
    start: np.ndarray  # byte start and end of each unit (words only)
    end: np.ndarray
    buf: np.ndarray
    first: np.ndarray  # first unit of each row


def units_of(text: pa.Array, plan: Plan) -> Units:
    buf, off = K.text_bytes(text)
    if plan.words:
        start, end, row = K.word_spans(buf, off, K.NON_SPACE)
        return Units(row, K.span_hash(buf, start, end), start, end, buf, np.searchsorted(row, np.arange(len(off))))
    row = np.repeat(np.arange(len(off) - 1), np.diff(off))
    return Units(row, buf.astype(np.uint64), row, row, buf, off)


def anchors_of(units: Units, plan: Plan) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of every window that lies in one row: its first unit, and its anchor's place and hash."""
    gram = K.window_hash(units.value, plan.gram)
    span = plan.width - plan.gram + 1
    if len(gram) < span:
        empty = np.zeros(0, np.int64)
        return empty, empty, np.zeros(0, np.uint64)
    # hash and place in one number: the place breaks ties to the left within the span
    place = np.arange(len(gram), dtype=np.uint64)
    low = np.uint64((1 << 24) - 1)
    if len(gram) >= 1 << 24:
        place, low = place % np.uint64(1 << 31), np.uint64((1 << 31) - 1)
    least = K.sliding_min((gram & ~low) | place, span)
    window = np.flatnonzero(K.same_row(units.row, plan.width))
    at = (least[window] & low).astype(np.int64)
    return window, at, gram[at]


def named(docs: DataFrame) -> DataFrame:
    """``doc_id, mark, text`` of every row: the row's name and its whole text."""
    text = F.coalesce(docs["text"], F.lit(""))
    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), F.xxhash64(text).alias("mark"), text.alias("text"))


def _count_mapper(plan: Plan):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in K.chunks(batch, "text", K.CHUNK_BYTES // 2):
                units = units_of(part.column("text"), plan)
                _, at, anchor = anchors_of(units, plan)
                first = np.ones(len(at), bool)
                first[1:] = at[1:] != at[:-1]
                at, anchor = at[first], anchor[first]
                # ``across``: the documents' ids; else places, which no two occurrences share
                who = part.column("did").to_numpy()[units.row[at]] if plan.across else at
                order = np.argsort(anchor, kind="stable")
                anchor, who = anchor[order], who[order]
                cut = np.flatnonzero(np.concatenate([[True], anchor[1:] != anchor[:-1]])) if len(anchor) else np.zeros(0, np.int64)
                if len(cut):
                    low, high = np.minimum.reduceat(who, cut), np.maximum.reduceat(who, cut)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(anchor[cut].view(np.int64)), pa.array(low if plan.across else np.zeros_like(low)),
                         pa.array(high if plan.across else (low != high).astype(np.int64))], names=["anchor", "low", "high"])
    return run


def shared_anchors(texts: DataFrame, plan: Plan) -> np.ndarray:
    """The bit table of anchors that stand more than once (``across``: in several documents)."""
    counted = texts.select("did", "text").mapInArrow(_count_mapper(plan), "anchor long, low long, high long")
    if plan.across:
        shared = counted.groupBy("anchor").agg(F.min("low").alias("low"), F.max("high").alias("high")).where("low != high")
    else:  # in two slices, or twice in one
        shared = counted.groupBy("anchor").agg(F.count(F.lit(1)).alias("n"), F.max("high").alias("high")).where("n > 1 OR high > 0")
    return bit_table(shared)


def bit_table(shared: DataFrame) -> np.ndarray:
    """The bit table that holds every ``anchor``."""
    bit = F.col("anchor").bitwiseAND((1 << FILTER_BITS) - 1)
    words = shared.select(F.shiftright(bit, 6).alias("word"), F.expr("shiftleft(1L, int(anchor & 63))").alias("mask")) \
        .groupBy("word").agg(F.bit_or("mask").alias("mask")).toPandas()
    table = np.zeros(1 << (FILTER_BITS - 6), np.uint64)
    table[words["word"].to_numpy(np.int64)] = words["mask"].to_numpy(np.int64).view(np.uint64)
    return table


def _region_mapper(shared, plan: Plan):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = shared.value
        for batch in batches:
            for part in K.chunks(batch, "text", K.CHUNK_BYTES // 2):
                units = units_of(part.column("text"), plan)
                window, at, anchor = anchors_of(units, plan)
                bit = anchor & np.uint64((1 << FILTER_BITS) - 1)
                keep = (bits[(bit >> np.uint64(6)).astype(np.int64)] >> (bit & np.uint64(63))) & np.uint64(1) == 1
                window, at, anchor = window[keep], at[keep], anchor[keep]
                if not len(window):
                    continue
                # the windows of one anchor's place follow each other
                lead = np.flatnonzero(np.concatenate([[True], (at[1:] != at[:-1]) | (np.diff(window) != 1)]))
                last = np.append(lead[1:], len(at)) - 1
                begin, end = window[lead], window[last] + plan.width
                power, inverse = K._power(len(units.value))
                sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(K.mix(units.value, 5) * power)])
                same = K.mix((sums[end] - sums[begin]) * inverse[begin] + (end - begin).astype(np.uint64), 6)
                offset = (at[lead] - begin).astype(np.uint64)
                same = K.mix(same + offset, 8)
                row = units.row[begin]
                did = part.column("did").to_numpy()[row]
                order = np.lexsort((did, same, anchor[lead]))
                a, c = anchor[lead][order], same[order]
                group = np.flatnonzero(np.concatenate([[True], (a[1:] != a[:-1]) | (c[1:] != c[:-1])]))
                once, times = order[group], np.zeros(len(lead), np.int64)  # of each class, an occurrence with the least id
                times[once] = np.diff(np.append(group, len(order)))
                texts: list[bytes | None] = [None] * len(lead)
                for k in once.tolist():
                    a, b = int(begin[k]), int(end[k])
                    if plan.words:
                        texts[k] = b" ".join(units.buf[x:y].tobytes() for x, y in zip(units.start[a:b].tolist(), units.end[a:b].tolist()))
                    else:
                        texts[k] = units.buf[a:b].tobytes()
                yield pa.RecordBatch.from_arrays(
                    [pa.array(anchor[lead].view(np.int64)), pa.array(same.view(np.int64)), pa.array(did),
                     part.column("mark").take(pa.array(row)), pa.array((begin - units.first[row]).astype(np.int64)),
                     pa.array(times), pa.array(texts, pa.binary())],
                    names=["anchor", "region", "did", "mark", "start", "n", "words"])
    return run


_JUDGED = "anchor long, region long, a array<int>, b array<int>, low array<long>"


def _hot_anchors(slices: DataFrame, plan: Plan) -> DataFrame | None:
    """Anchors whose distinct classes hold more than a bucket's bytes: at most one for each bucket."""
    size = slices.select("anchor", "region", F.length("words").alias("size"))
    perhaps = size.groupBy("anchor").agg(F.sum("size").alias("size")).where(F.col("size") > plan.bucket_bytes).select("anchor")
    hot = written(size.join(perhaps, "anchor", "left_semi").groupBy("anchor", "region").agg(F.first("size").alias("size"))
                  .groupBy("anchor").agg(F.sum("size").alias("size")).where(F.col("size") > plan.bucket_bytes).select("anchor"), "hot")
    return None if hot.isEmpty() else hot


def _class_units(words: pa.Array, plan: Plan) -> Units:
    if plan.words:
        return units_of(words.cast(pa.string()), plan)
    words = words.cast(pa.large_binary())
    _, offsets, data = words.buffers()
    off = np.frombuffer(offsets, np.int64, len(words) + 1, words.offset * 8)
    buf = np.frombuffer(data, np.uint8)[off[0]:off[-1]]
    row = np.repeat(np.arange(len(words)), np.diff(off))
    return Units(row, buf.astype(np.uint64), row, row, buf, off - off[0])


def _window_mapper(plan: Plan):
    """Every window of each class, and its place there."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in K.chunks(batch, "words", K.CHUNK_BYTES // 2):
                units = _class_units(part.column("words"), plan)
                at = np.flatnonzero(K.same_row(units.row, plan.width))
                row = units.row[at]
                of = [part.column(x).take(pa.array(row)) for x in ("anchor", "region", "did", "n")]
                window = K.window_hash(units.value, plan.width)[at]
                yield pa.RecordBatch.from_arrays([*of, pa.array(window.view(np.int64)), pa.array((at - units.first[row]).astype(np.int32))],
                                                 names=["anchor", "region", "did", "n", "window", "at"])
    return run


def _text_mapper(plan: Plan):
    """The units of the window that starts at ``at`` of each class."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text, at in zip(batch.column("words").to_pylist(), batch.column("at").to_pylist()):
                out.append(b" ".join(text.split(b" ")[at:at + plan.width]) if plan.words else text[at:at + plan.width])
            yield pa.RecordBatch.from_arrays([*(batch.column(x) for x in ("anchor", "window", "did", "n")), pa.array(out, pa.binary())],
                                             names=["anchor", "region", "did", "n", "words"])
    return run


def _judged_windows(slices: DataFrame, plan: Plan, judge: Callable[[pa.Table], pa.Table]) -> DataFrame:
    """What ``judge`` says of these classes, got from their windows one by one."""
    classes = written(slices.groupBy("anchor", "region").agg(F.first("words").alias("words"), F.min("did").alias("did"), F.sum("n").alias("n")), "classes")
    windows = classes.mapInArrow(_window_mapper(plan), "anchor long, region long, did long, n long, window long, at int")
    again = written(windows.groupBy("anchor", "window").agg(
        F.min("did").alias("did"), F.sum("n").alias("n"), F.min(F.struct("region", "at")).alias("one")).where("n > 1"), "windows")
    texts = again.select("anchor", "window", "did", "n", "one.region", "one.at").join(classes.select("anchor", "region", "words"), ["anchor", "region"]) \
        .mapInArrow(_text_mapper(plan), "anchor long, region long, did long, n long, words binary")
    buckets = max(1, -(-again.count() * plan.width * (6 if plan.words else 1) // plan.bucket_bytes))
    dealt = texts.withColumn("bucket", F.pmod(F.xxhash64("anchor", "region"), F.lit(buckets)))
    judged = dealt.groupBy("bucket").applyInArrow(judge, _JUDGED) \
        .select("anchor", F.col("region").alias("window"), F.explode(F.arrays_zip("a", "b", "low")).alias("run"))
    runs = windows.select("anchor", "region", "window", "at").join(judged, ["anchor", "window"]).groupBy("anchor", "region").agg(
        F.collect_list(F.struct((F.col("at") + F.col("run.a")).alias("a"), (F.col("at") + F.col("run.b")).alias("b"), F.col("run.low").alias("low"))).alias("runs"))
    return runs.select("anchor", "region", "runs.a", "runs.b", "runs.low")


def removed_runs(rows: DataFrame, plan: Plan, judge: Callable[[pa.Table], pa.Table], table: np.ndarray | None = None) -> DataFrame:
    """``doc_id, mark, runs`` (start, end, ... in units, not merged) of the rows of
    ``named`` that lose units.  ``judge`` gets ``anchor, region, words, did, n`` of
    one bucket's classes and returns ``anchor, region, a, b, low``: runs [a, b) of
    a class that go where ``low`` is less than the document's id (null: everywhere).
    ``table`` has the anchors to look at, if not all shared ones."""
    spark = rows.sparkSession
    texts = rows.withColumn("did", F.coalesce("doc_id", F.lit(0)))  # without ``across`` the id is not looked at
    if plan.across:
        texts = texts.where("doc_id IS NOT NULL")
    shared = spark.sparkContext.broadcast(shared_anchors(texts, plan) if table is None else table)
    found = written(texts.select("did", "mark", "text").mapInArrow(
        _region_mapper(shared, plan),
        "anchor long, region long, did long, mark long, start long, n long, words binary"), "regions")
    slices = found.where("words IS NOT NULL").select("anchor", "region", "did", "n", "words")
    hot = _hot_anchors(slices, plan)
    judged = None
    if hot is not None:
        judged = _judged_windows(slices.join(F.broadcast(hot), "anchor", "left_semi"), plan, judge)
        slices = slices.join(F.broadcast(hot), "anchor", "left_anti")
    total = slices.agg(F.sum(F.length("words"))).first()[0] or 0
    buckets = max(1, -(-total // plan.bucket_bytes))
    # dealt once, by bucket; the classes of a bucket are united where they lie
    classes = slices.withColumn("bucket", F.pmod(F.xxhash64("anchor"), F.lit(buckets))).repartition("bucket") \
        .groupBy("bucket", "anchor", "region").agg(F.first("words").alias("words"), F.min("did").alias("did"), F.sum("n").alias("n"))
    others = classes.groupBy("bucket").applyInArrow(judge, _JUDGED)
    judged = others if judged is None else others.unionByName(judged)
    runs = found.select("anchor", "region", "did", "mark", "start").join(judged, ["anchor", "region"]) \
        .select("did", "mark", "start", F.explode(F.arrays_zip("a", "b", "low")).alias("run"))
    if plan.across:
        runs = runs.where("run.low < did")
    return runs.groupBy("did", "mark").agg(F.flatten(F.collect_list(F.array(
        F.col("start") + F.col("run.a"), F.col("start") + F.col("run.b")))).alias("runs"))


def with_runs(rows: DataFrame, runs: DataFrame, across: bool) -> DataFrame:
    """``doc_id, text, runs`` of every row of ``named``."""
    did = F.col("doc_id") if across else F.coalesce("doc_id", F.lit(0))
    return rows.withColumn("did", did).join(runs, ["did", "mark"], "left").select("doc_id", "text", "runs")


def merge_runs(runs: list[int] | None) -> list[int]:
    """Sorted, joined runs (start, end, ...)."""
    out: list[int] = []
    for a, b in sorted(zip(runs[::2], runs[1::2])) if runs else ():
        if out and a <= out[-1]:
            out[-1] = max(out[-1], b)
        else:
            out += [a, b]
    return out


def kept(size: int, runs: list[int]) -> Iterator[tuple[int, int]]:
    """What is left between runs."""
    edges = [0, *runs, size]
    return ((a, b) for a, b in zip(edges[::2], edges[1::2]) if a < b)


def ragged_runs(classes: np.ndarray, a: np.ndarray, b: np.ndarray, low: np.ndarray | None, group: pa.Table) -> pa.Table:
    """The judge's table from runs listed by class (place in ``group``), in order."""
    which, count = np.unique(classes, return_counts=True)
    ends = pa.array(np.concatenate([[0], np.cumsum(count)]), pa.int32())
    lows = pa.array(low, pa.int64()) if low is not None else pa.nulls(len(a), pa.int64())
    lists = [pa.ListArray.from_arrays(ends, x) for x in (pa.array(a, pa.int32()), pa.array(b, pa.int32()), lows)]
    take = pa.array(which)
    return pa.table({"anchor": group.column("anchor").take(take), "region": group.column("region").take(take),
                     "a": lists[0], "b": lists[1], "low": lists[2]})
