"""Operator 11: near-duplicate documents by MinHash bands and odd sketches.

Documents are sets of ``width`` consecutive words (A-Z lower-cased; a text of
fewer words is one shingle of all of them).  Equal word sequences are one *class*
before anything else.  A class has ``BANDS`` bands of ``ROWS`` MinHash values;
classes are candidates when some band is equal (a pair at the threshold 0.8 is
missed with a chance below 4e-7).

A class also has a MinHash sample of its set: all shingles whose hash lies under
2 ** -level, the level being the smallest that leaves at most ``SAMPLE`` of the
set's size (0, the whole set, for most texts).  The sample is folded into a bitmap
of ``BITS`` parities, the odd sketch: each shingle flips the bit of its hash.
Shared shingles cancel out in the XOR of two sketches, so its population count is
at most the number of sampled shingles in which the sets differ, and close to it.
Sets that reach the similarity s differ in at most (1 - s) / (1 + s) of their
sizes' sum, so candidates whose count exceeds that are dropped: surely not linked
at level 0; at higher levels the limit adds Bernstein's bound for a chance of
``MISS``.  Candidates of different levels go on unfiltered.

Verification is exact, on whole texts: words are told apart by their bytes, and
the sets' intersection is counted.  It goes in rounds, so that a large group of
near copies costs work in proportion to its members, not to its pairs:

1. In each band one class leads, by a hash of the round; every class against the
   closest, by sketch, of the leaders that lie in other components than itself.
   ``STARS`` such rounds merge nearly all that is linked.
2. All candidates that are still in different components.  In each band only the
   classes outside its largest component ask; pairs inside a component need no
   link of their own.  A pair is met in the first band that it shares and in no
   other, and is also judged by wide sketches (``WIDE_BITS`` parities of samples of
   ``WIDE_SAMPLE`` shingles, made for these classes alone), by the same limits: their
   parities seldom collide, and most texts are whole in them.

Pairs are dealt to tasks by hash in bundles of bounded bytes; a class that many
pairs name is salted over several bundles.

Cases: a null or empty text, or one of white space, has an empty set and is its
own component; null doc_ids count as larger than all others (a component of such
rows alone has a null id and its rows are kept); rows that share a doc_id are
rows like others; extra columns are not read; empty tables give empty results.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelspark.llm import textkit as K
from panelspark.llm.components import components
from panelspark.llm.jaccard import shingles
from panelspark.llm.tables import written

#: Fixed values of the contract.
WIDTH, PERCENT = 2, 80
BANDS, ROWS, BITS, SAMPLE, MISS = 28, 4, 1024, 512, 1e-7
#: Of the sketches of classes that are left to the last round.
WIDE_BITS, WIDE_SAMPLE = 4096, 2048
#: Rounds of leaders before all pairs of different components.
STARS = 4
#: Bytes of text that one bundle of pairs holds, and pairs of one class before it is salted.
BUNDLE_BYTES, SALT_PAIRS = 4 << 20, 512
_rng = np.random.default_rng(11_2024)
_A = _rng.integers(1, 1 << 62, BANDS * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_B = _rng.integers(0, 1 << 62, BANDS * ROWS, dtype=np.uint64)
_SKETCH = [f"s{k}" for k in range(BITS // 64)]


def most(differing, level, miss: float = MISS, sqrt=np.sqrt):
    """The population count that sets which differ in ``differing`` shingles exceed with a
    chance of at most ``miss``, if each is sampled with the chance 2 ** -level
    (Bernstein).  Of numbers, or of columns with ``F.sqrt``."""
    mean, odds = differing / 2 ** level, -float(np.log(miss)) / 3
    return mean + odds + sqrt(odds * odds + 6 * odds * mean)


def sketches(row: np.ndarray, hashed: np.ndarray, size: np.ndarray, bits: int = BITS, sample: int = SAMPLE) -> tuple[np.ndarray, np.ndarray]:
    """Level, and odd sketch as words of 64 bits, of each row's distinct shingles."""
    level = np.ceil(np.log2(np.maximum(size, sample) / sample)).astype(np.int64)
    hashed = K.mix(hashed, bits)
    taken = hashed >> np.uint64(11) < np.uint64(1) << (53 - level[row]).astype(np.uint64)
    odd = np.zeros((len(size), bits), np.uint8)
    np.bitwise_xor.at(odd, (row[taken], (hashed[taken] % np.uint64(bits)).astype(np.int64)), 1)
    return level, np.packbits(odd, axis=1, bitorder="little").view(np.int64)


def _named(text: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[bytes | None]]:
    """Row and hash of the distinct shingles, the sets' sizes, and the digests of the words."""
    r, h = shingles(text, width)
    size = np.bincount(r, minlength=len(text))
    buf, off = K.text_bytes(text)
    buf = K.lower(buf)
    keys = [hashlib.blake2b(b" ".join(buf[off[k]:off[k + 1]].tobytes().split()), digest_size=16).digest() if size[k] else None
            for k in range(len(text))]
    return r, h, size, keys


def _name_mapper(width: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in K.chunks(batch, "text"):
                _, _, size, keys = _named(part.column("text"), width)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(keys, pa.binary()), pa.array(size, pa.int64())],
                                                 names=["doc_id", "key", "size"])
    return run


def _sign_mapper(width: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in K.chunks(batch, "text"):
                text, n = part.column("text"), part.num_rows
                r, h, size, keys = _named(text, width)
                full, first = np.unique(r, return_index=True)
                bands = np.zeros((len(full), BANDS), np.uint64)
                for band in range(BANDS if len(full) else 0):
                    label = np.full(len(full), band, np.uint64)
                    for p in range(band * ROWS, band * ROWS + ROWS):
                        least = np.minimum.reduceat((h * _A[p] + _B[p]) >> np.uint64(8), first)
                        label = K.mix(label ^ least, p)
                    bands[:, band] = label
                level, sketch = sketches(r, h, size)
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(np.where(size > 0, BANDS, 0))]), pa.int32()),
                                                 pa.array(bands.ravel().view(np.int64)))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(keys, pa.binary()), pa.array(size, pa.int64()), lists, pa.array(level),
                     *[pa.array(np.ascontiguousarray(sketch[:, k])) for k in range(BITS // 64)], text],
                    names=["doc_id", "key", "size", "bands", "level", *_SKETCH, "text"])
    return run


def _rows(docs: DataFrame) -> DataFrame:
    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].alias("text"))


def sign(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """``doc_id, key`` (digest of the words, null without any), ``size`` of the
    set, ``bands``, the odd sketch with its ``level``, and ``text`` of every row."""
    sketch = ", ".join(f"{s} long" for s in _SKETCH)
    return _rows(docs).mapInArrow(_sign_mapper(width), f"doc_id long, key binary, size long, bands array<long>, level long, {sketch}, text string")


def _wide_mapper(width: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in K.chunks(batch, "text"):
                r, h = shingles(part.column("text"), width)
                level, sketch = sketches(r, h, np.bincount(r, minlength=part.num_rows), WIDE_BITS, WIDE_SAMPLE)
                ends = pa.array(np.arange(part.num_rows + 1) * (WIDE_BITS // 64), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [part.column("key"), part.column("bands"), pa.array(level), pa.ListArray.from_arrays(ends, pa.array(sketch.ravel()))],
                    names=["key", "bands", "level", "odd"])
    return run


def widened(placed: DataFrame, classes: DataFrame, width: int) -> DataFrame:
    """``placed`` with the class's ``bands`` and its wide sketch, as ``wide``."""
    wide = classes.select("key", "bands", "text").join(placed.select("key").distinct(), "key", "left_semi") \
        .mapInArrow(_wide_mapper(width), "key binary, bands array<long>, level long, odd array<long>")
    return placed.join(wide.select("key", F.struct("bands", "level", "odd").alias("wide")), "key")


def exact_sets(text: pa.Array, width: int) -> list[np.ndarray]:
    """The sorted shingles of each text as numbers, told apart by the words' bytes."""
    buf, off = K.text_bytes(text)
    buf = K.lower(buf)
    start, end, row = K.word_spans(buf, off, K.NON_SPACE)
    ends = np.concatenate([[0], np.cumsum(end - start)]).astype(np.int64)
    data = buf[K.NON_SPACE[buf]]
    spelled = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(start), [None, pa.py_buffer(ends), pa.py_buffer(data)]).dictionary_encode()
    word, many = spelled.indices.to_numpy().astype(np.int64) + 1, len(spelled.dictionary) + 1
    code = word
    inside = np.searchsorted(row, np.arange(len(off)))
    for k in range(1, width):  # 0 where the row has no further word: short rows keep theirs apart
        following = np.zeros(len(word), np.int64)
        same = row[k:] == row[:-k] if k < len(row) else np.zeros(0, bool)
        following[:len(same)][same] = word[k:][same]
        code = np.unique(code * many + following, return_inverse=True)[1] if k + 1 < width else code * many + following
    found = []
    for k in range(len(off) - 1):
        a, b = inside[k], inside[k + 1]
        found.append(np.unique(code[a:max(b - width + 1, a + 1)] if b > a else code[:0]))
    return found


def _verify(width: int, percent: int):
    def run(key: tuple, pairs: pa.Table, texts: pa.Table) -> pa.Table:
        names = {k: n for n, k in enumerate(texts.column("key").to_pylist())}
        text = texts.column("text").combine_chunks()
        sets = exact_sets(text.chunk(0) if isinstance(text, pa.ChunkedArray) else text, width)
        us, vs = pairs.column("u").to_pylist(), pairs.column("v").to_pylist()
        linked = np.zeros(len(us), bool)
        for k, (u, v) in enumerate(zip(us, vs)):
            a, b = sets[names[u]], sets[names[v]]
            a, b = (a, b) if len(a) <= len(b) else (b, a)
            if 100 * len(a) < percent * len(b):
                continue
            at = np.minimum(np.searchsorted(b, a), len(b) - 1)
            both = int(np.count_nonzero(b[at] == a))
            linked[k] = 100 * both >= percent * (len(a) + len(b) - both)
        return pairs.select(["u", "v"]).filter(pa.array(linked))
    return run


def verified(pairs: DataFrame, members: DataFrame, width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """The rows of ``pairs`` (u, v: keys) whose sets reach the similarity; written."""
    pairs = written(pairs.select("u", "v"), "pairs")
    sized = members.select(F.col("key").alias("v"), F.octet_length("text").alias("bytes"))
    held = pairs.join(sized, "v").agg(F.coalesce(F.sum("bytes"), F.lit(0))).first()[0]
    bundles = max(1, -(-held // BUNDLE_BYTES))
    salts = pairs.groupBy("u").agg(F.ceil(F.count(F.lit(1)) / SALT_PAIRS).alias("salts"))
    dealt = pairs.join(salts, "u").select("u", "v", F.pmod(F.xxhash64("u", F.pmod(F.xxhash64("v"), F.col("salts"))), F.lit(bundles)).alias("bundle"))
    dealt = written(dealt, "dealt")
    needed = dealt.select(F.col("bundle").alias("place"), F.explode(F.array("u", "v")).alias("key")).distinct()
    texts = needed.join(members.select("key", "text"), "key")
    found = dealt.groupBy("bundle").cogroup(texts.groupBy("place")).applyInArrow(_verify(width, percent), "u binary, v binary")
    return written(found, "links")


def _differ(a: str, b: str) -> F.Column:
    """Population count of the XOR of two sketches."""
    counts = [F.bit_count(F.col(f"{a}.{s}").bitwiseXOR(F.col(f"{b}.{s}"))) for s in _SKETCH]
    return reduce(lambda x, y: x + y, counts)


def _limit(size: F.Column, other: F.Column, level: F.Column, percent: int) -> F.Column:
    """What the sketches of two sets of the similarity differ in, at most."""
    differing = F.floor((size + other) * (100 - percent) / (100 + percent))
    return F.when(level == 0, differing).otherwise(most(differing, level, sqrt=F.sqrt))


def _close(a: str, b: str, percent: int) -> F.Column:
    """Whether sizes and sketches allow the similarity."""
    (size, level), (other, same) = [(F.col(f"{x}.size"), F.col(f"{x}.level")) for x in (a, b)]
    return (100 * F.least(size, other) >= percent * F.greatest(size, other)) & (
        (level != same) | (_differ(a, b) <= _limit(size, other, level, percent)))


def _first_shared(band: str, a: str, b: str) -> F.Column:
    """Whether ``band`` is the first band of both."""
    same = F.zip_with(f"{a}.bands", f"{b}.bands", lambda x, y: x == y)
    return F.element_at(f"{a}.bands", F.array_position(same, F.lit(True)).cast("int")) == F.col(band)


def _close_wide(a: str, wa: str, b: str, wb: str, percent: int) -> F.Column:
    """Whether the wide sketches allow the similarity."""
    odd = F.aggregate(F.zip_with(f"{wa}.odd", f"{wb}.odd", lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda s, x: s + x)
    level = F.col(f"{wa}.level")
    return (level != F.col(f"{wb}.level")) | (odd <= _limit(F.col(f"{a}.size"), F.col(f"{b}.size"), level, percent))


def _placed(shared: DataFrame, links: DataFrame | None) -> DataFrame:
    """``shared`` with each class's component (``root``), in bands of several ones."""
    if links is None:
        return shared.withColumn("root", F.col("key"))
    groups = components(links).select(F.col("node").alias("key"), "root")
    placed = shared.join(groups, "key", "left").withColumn("root", F.coalesce("root", "key"))
    several = placed.groupBy("band").agg(F.min("root").alias("a"), F.max("root").alias("b")).where("a != b").select("band")
    return written(placed.join(several, "band"), "placed")


def led(placed: DataFrame, percent: int, turn: int) -> DataFrame:
    """``u, v``: every class with its closest leader in another component, if any is close."""
    leaders = placed.groupBy("band").agg(F.min_by(F.struct("key", "root", "about"), F.xxhash64("key", F.lit(turn))).alias("lead")) \
        .select("band", F.col("lead.key").alias("u"), F.col("lead.root").alias("ru"), F.col("lead.about").alias("au"))
    met = placed.join(leaders, "band").where((F.col("root") != F.col("ru")) & _close("about", "au", percent))
    return met.groupBy("key").agg(F.min(F.struct(_differ("about", "au").alias("differ"), "u")).alias("best")) \
        .select(F.col("best.u").alias("u"), F.col("key").alias("v"))


def crossing(placed: DataFrame, percent: int) -> DataFrame:
    """``u, v`` of every two classes of ``widened`` that share a band, are close, and
    lie in different components; each pair once."""
    largest = placed.groupBy("band", "root").count().groupBy("band").agg(F.max_by("root", F.struct("count", "root")).alias("main"))
    asking = placed.join(largest, "band").where("root != main").select("band", F.col("key").alias("u"), F.col("root").alias("ru"), F.col("about").alias("au"), F.col("wide").alias("wu"), "main")
    others = placed.select("band", F.col("key").alias("v"), F.col("root").alias("rv"), F.col("about").alias("av"), F.col("wide").alias("wv"))
    # Two that both ask meet once.
    met = asking.join(others, "band").where(
        (F.col("ru") != F.col("rv")) & ((F.col("rv") == F.col("main")) | (F.col("u") < F.col("v"))) & _close("au", "av", percent)
        & _first_shared("band", "wu", "wv") & _close_wide("au", "wu", "av", "wv", percent))
    return met.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct()


def link(signed: DataFrame, width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """``key, component_id`` of every class; jobs run while this is built."""
    # One row of each class: the first of any equal ones.
    classes = written(signed.where("key IS NOT NULL").withColumn("about", F.struct("size", "level", *_SKETCH)).groupBy("key").agg(
        F.min("doc_id").alias("cid"), *[F.first(c).alias(c) for c in ("bands", "about", "text")]), "classes")
    held = classes.select("key", F.explode("bands").alias("band"))
    several = held.groupBy("band").agg(F.min("key").alias("low"), F.max("key").alias("high")).where("low != high").select("band")
    shared = written(held.join(several, "band"), "shared")
    members = written(classes.select("key", "cid", "about", "text").join(shared.select("key").distinct(), "key"), "members")
    shared = written(shared.join(members.select("key", "about"), "key"), "shared")
    links = None
    for turn in range(STARS + 1):
        placed = _placed(shared, links)
        pairs = led(placed, percent, turn) if turn < STARS else crossing(written(widened(placed, classes, width), "wide"), percent)
        found = verified(pairs, members, width, percent)
        links = found if links is None else links.union(found)
    ids = written(components(links), "found").join(members.select(F.col("key").alias("node"), "cid"), "node")
    heads = ids.groupBy("root").agg(F.min("cid").alias("component_id"))
    linked = ids.join(heads, "root").select(F.col("node").alias("key"), "component_id")
    return linked.union(classes.select("key", "cid").join(linked.select("key"), "key", "left_anti"))


def dedup(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` of every row."""
    found = link(sign(docs, width), width, percent)
    rows = _rows(docs).mapInArrow(_name_mapper(width), "doc_id long, key binary, size long").join(found, "key", "left")
    component = F.when(F.col("key").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return rows.select("doc_id", F.col("size").alias("n_shingles"), component.alias("component_id")) \
        .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
