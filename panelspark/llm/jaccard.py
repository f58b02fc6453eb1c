"""Operator 1: n-gram Jaccard join by a MinHash LSH forest.

Documents are sets of word shingles (``width`` consecutive words, A-Z
lower-cased; a text of fewer words is one shingle of all of them).  Equal sets
are one *class* before anything else, so copies cost one member.  Each class is
signed with ``DEPTH`` MinHash values for each of ``TREES`` tries; a node of a trie
is a prefix of these values, and classes under one node match.

Branches that one class has to itself at the shortest length that can be needed are
cut off.  Prefixes are then matched at full depth, and the matches verified.  A link of
similarity s shares a prefix of length k with probability ``1 - (1 - s ** k) **
TREES``; the prefixes are shortened to the longest length whose recall of the
least similar link verified so far reaches ``RECALL`` (of the threshold, while no
link is known), and matched again, until that length no longer shrinks.  It never
needs to fall below the length that reaches the target at the threshold.

Matches are verified exactly on all shingles.  Connected matches are a family.
Its members, ranked by their prefixes, are cut into blocks of bounded size; blocks
are compared where some node has members in both, and the shared shingles of all
their pairs are counted by a matrix product.  A group returns one row per member
(how many documents it is linked to, and the smallest member it is connected
with), never its pairs.  A family of one block that did not grow between two
depths is not compared again.  Components of the links give the groups.

Cases: a null or empty text has no shingle, no link, and is its own group.
Several rows of one doc_id and null doc_ids are rows like others; ``class_id``
is the smallest doc_id of the group (null if all are).  Extra columns are
carried along.  Empty tables give empty results.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelspark.llm import textkit as K
from panelspark.llm.components import components
from panelspark.llm.tables import written

WIDTH, THRESHOLD = 5, 0.8
TREES, DEPTH, RECALL = 20, 6, 0.9999
#: Members and shingles of a block that is compared with another in one task.
BLOCK_MEMBERS, BLOCK_SHINGLES = 256, 400_000
_COLUMNS = 8192
_rng = np.random.default_rng(20_240_229)
_A = _rng.integers(1, 1 << 62, TREES * DEPTH, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_B = _rng.integers(0, 1 << 62, TREES * DEPTH, dtype=np.uint64)


def prefix_length(threshold: float, trees: int = TREES, depth: int = DEPTH, target: float = RECALL) -> int:
    """The longest prefix whose recall at ``threshold`` reaches the target."""
    length = depth
    while length > 1 and 1 - (1 - threshold ** length) ** trees < target:
        length -= 1
    return length


def shingles(text: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (row, shingle hash) of a column, by row and hash."""
    buf, off = K.text_bytes(text)
    buf = K.lower(buf)
    start, end, row = K.word_spans(buf, off, K.NON_SPACE)
    word = K.span_hash(buf, start, end)
    same = K.same_row(row, width)
    n = len(same)
    r, h = [row[:n][same]], [K.window_hash(word, width)[same] if n else word[:0]]
    count = np.bincount(row, minlength=len(off) - 1)
    first = np.searchsorted(row, np.arange(len(off) - 1))
    for size in range(1, width):  # short texts: one shingle of all words
        at = np.flatnonzero(count == size)
        if len(at):
            r.append(at)
            h.append(K.window_hash(word, size, size)[first[at]])
    r, h = np.concatenate(r), np.concatenate(h)
    order = np.lexsort((h, r))
    r, h = r[order], h[order]
    fresh = np.ones(len(r), bool)
    fresh[1:] = (r[1:] != r[:-1]) | (h[1:] != h[:-1])
    return r[fresh], h[fresh]


def _sign_mapper(width: int, trees: int):
    values = trees * DEPTH

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row, text in K.row_chunks(batches):
            r, h = shingles(text, width)
            n = len(row)
            bounds = np.searchsorted(r, np.arange(n + 1))
            size = np.diff(bounds)
            full = np.flatnonzero(size)
            keys: list[bytes | None] = [None] * n
            for k in full.tolist():
                keys[k] = hashlib.blake2b(h[bounds[k]:bounds[k + 1]].tobytes(), digest_size=16).digest()
            least = np.zeros((len(full), values), np.int32)
            if len(full):
                for p in range(values):
                    low = np.minimum.reduceat((h * _A[p] + _B[p]) >> np.uint64(20), bounds[full])
                    least[:, p] = (K.mix(low, p) >> np.uint64(32)).astype(np.uint32).view(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(np.where(size > 0, values, 0))]), pa.int32()),
                                             pa.array(least.ravel()))
            yield pa.RecordBatch.from_arrays([row, pa.array(keys, pa.binary()), pa.array(size, pa.int64()), lists],
                                             names=["row", "key", "size", "signature"])
    return run


def sign(rows: DataFrame, width: int = WIDTH, trees: int = TREES) -> DataFrame:
    """``row``, ``key`` (digest of the shingle set, null without words), ``size``
    and ``signature`` (``DEPTH`` MinHash values for each trie, one trie after another)."""
    return rows.mapInArrow(_sign_mapper(width, trees), f"row {K.row_type(rows)}, key binary, size long, signature array<int>")


def nodes(depth: int) -> Column:
    """The node of every trie that holds a signature at ``depth``: a hash of the
    trie's number and its first ``depth`` values."""
    return F.array(*[F.xxhash64(F.lit(t), F.slice("signature", t * DEPTH + 1, depth)) for t in range(TREES)])


def _compare(width: int, threshold: float):
    per_mille = round(threshold * 1000)

    def run(group: pa.Table) -> pa.Table:
        group = group.combine_chunks()
        text = group.column("text").combine_chunks()
        text = text.chunk(0) if isinstance(text, pa.ChunkedArray) else text
        keys, weight = group.column("node").to_pylist(), group.column("n").to_numpy().astype(np.float64)
        block = group.column("block").to_numpy()
        _, once = np.unique(np.array([k.hex() for k in keys]), return_index=True)  # by key; repeated rows once
        r, h = shingles(text, width)
        m = len(once)
        place = np.full(len(keys), -1)
        place[once] = np.arange(m)
        r = place[r]
        r, h = r[r >= 0], h[r >= 0]
        size = np.bincount(r, minlength=m)
        _, column, times = np.unique(h, return_inverse=True, return_counts=True)
        shared = times > 1
        name = np.cumsum(shared) - 1
        keep = shared[column]
        r, column = r[keep], name[column[keep]]
        order = np.argsort(column, kind="stable")
        r, column = r[order], column[order]
        both = np.zeros((m, m), np.float32)
        for lo in range(0, int(shared.sum()), _COLUMNS):
            a, b = np.searchsorted(column, [lo, lo + _COLUMNS])
            part = np.zeros((m, _COLUMNS), np.float32)
            part[r[a:b], column[a:b] - lo] = 1
            both += part @ part.T
        inter = both.astype(np.int64)
        linked = inter * 1000 >= per_mille * (size[:, None] + size[None, :] - inter)
        np.fill_diagonal(linked, False)
        side = block[once]
        if group.column("lo")[0].as_py() != group.column("hi")[0].as_py():
            linked &= side[:, None] != side[None, :]
        links = linked @ weight[once]
        alike = inter * 1000 // np.maximum(size[:, None] + size[None, :] - inter, 1)
        lowest = np.where(linked, alike, 1000).min(axis=1, initial=1000)
        root = np.arange(m)
        while True:
            low = np.minimum(root, np.where(linked, root[None, :], m).min(axis=1, initial=m))
            if np.array_equal(low, root):
                break
            root = low
        ordered = [keys[k] for k in once.tolist()]
        return pa.table({"family": pa.array([group.column("root")[0].as_py()] * m, pa.binary()), "node": pa.array(ordered, pa.binary()),
                         "links": pa.array(links.astype(np.int64)), "lowest": pa.array(lowest.astype(np.int64)),
                         "root": pa.array([ordered[k] for k in root.tolist()], pa.binary()),
                         "alone": pa.array([group.column("alone")[0].as_py()] * m, pa.bool_())})
    return run


def _near(classes: DataFrame, threshold: float) -> DataFrame:
    """Tries without the branches that no other class shares: the classes with a
    companion at the shortest length that can be needed."""
    held = classes.select("key", F.explode(nodes(prefix_length(threshold))).alias("prefix"))
    wide = held.groupBy("prefix").agg(F.min("key").alias("low"), F.max("key").alias("high")).where("low != high").select("prefix")
    return written(classes.join(held.join(wide, "prefix").select("key").distinct(), "key"), "near")


def _matched(classes: DataFrame, depth: int) -> DataFrame:
    """``node, root, n, block, of, alone`` of the classes that share a node at
    ``depth`` with another: their family, the block of it that they are in, the
    family's members, and whether it is one block."""
    held = classes.select("key", F.explode(nodes(depth)).alias("prefix"))
    least = held.groupBy("prefix").agg(F.min("key").alias("low"), F.max("key").alias("high")).where("low != high")
    families = components(held.join(least, "prefix").select(F.col("key").alias("u"), F.col("low").alias("v")))
    members = families.join(classes, families["node"] == classes["key"])
    path = F.slice("signature", 1, DEPTH)  # the first trie's order keeps sharers together
    order = ["root", "path", "node"]
    placed = written(members.select("node", "root", "n", "size", path.alias("path")).repartitionByRange(*order).sortWithinPartitions(*order)
                     .drop("path").withColumn("place", F.monotonically_increasing_id()).withColumn("part", F.shiftright("place", 33)), "placed")
    spans = placed.groupBy("root", "part").agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("held"), F.sum("size").alias("weight"))
    family = Window.partitionBy("root")
    earlier = family.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    spans = spans.select("root", "part", "first", F.coalesce(F.sum("held").over(earlier), F.lit(0)).alias("offset"), F.sum("held").over(family).alias("of"),
                         F.ceil(F.greatest(F.sum("held").over(family) / BLOCK_MEMBERS, F.sum("weight").over(family) / BLOCK_SHINGLES)).alias("blocks"))
    rank = F.col("offset") + F.col("place") - F.col("first")
    return written(placed.join(spans, ["root", "part"]).select("node", "root", "n", F.floor(rank * F.col("blocks") / F.col("of")).alias("block"),
                                                               "of", (F.col("blocks") == 1).alias("alone")), "members")


def _sharing(classes: DataFrame, members: DataFrame, depth: int) -> DataFrame:
    """``root, block, groups``: the pairs of blocks (lo, hi) that a family's block is
    compared in, itself and every block that holds members of one of its nodes."""
    many = members.where("NOT alone").select(F.col("node").alias("key"), "root", "block")
    held = classes.join(many, "key").select("root", "block", F.explode(nodes(depth)).alias("prefix")).distinct()
    across = held.withColumnRenamed("block", "lo").join(held.withColumnRenamed("block", "hi"), ["root", "prefix"]).where("lo < hi") \
        .select("root", "lo", "hi").distinct()
    itself = members.select("root", F.col("block").alias("lo"), F.col("block").alias("hi")).distinct()
    pairs = across.union(itself)
    sides = pairs.select("root", F.explode(F.array_distinct(F.array("lo", "hi"))).alias("block"), F.struct("lo", "hi").alias("pair"))
    return sides.groupBy("root", "block").agg(F.collect_list("pair").alias("groups"))


def _verified(texts: DataFrame, classes: DataFrame, members: DataFrame, depth: int, width: int, threshold: float) -> DataFrame:
    """``family, node, links, lowest, root, alone`` of every member, for each group it is compared in."""
    dealt = members.join(_sharing(classes, members, depth), ["root", "block"])
    found = texts.join(dealt, texts["key"] == dealt["node"]).select("root", "node", "n", "block", "alone", F.explode("groups").alias("pair"), "text")
    return found.select("root", "node", "n", "block", "alone", "pair.lo", "pair.hi", "text").groupBy("root", "lo", "hi") \
        .applyInArrow(_compare(width, threshold), "family binary, node binary, links long, lowest long, root binary, alone boolean")


def forest(texts: DataFrame, classes: DataFrame, width: int, threshold: float) -> DataFrame:
    """The verified matches of all classes (see ``_verified``), prefixes shortened
    from full depth until the target recall is reached."""
    depth, before = DEPTH, None
    while True:
        members = _matched(classes, depth)
        if before is None:
            compared = written(_verified(texts, classes, members, depth, width, threshold), "compared")
        else:
            # a family that has as many members as before, in one block then and now, has the same links
            kept = members.where("alone").select("root", "of").distinct() \
                .join(before[0].where("alone").select("root", "of").distinct(), ["root", "of"]).select("root")
            grown = members.where("NOT alone").union(members.where("alone").join(kept, "root", "left_anti").select(members.columns))
            same = before[1].where("alone").join(kept.withColumnRenamed("root", "family"), "family", "left_semi")
            compared = written(_verified(texts, classes, grown, depth, width, threshold).unionByName(same), "compared")
        least = compared.where("links > 0").agg(F.min("lowest")).first()[0]
        shorter = min(depth, prefix_length(threshold if least is None else max(threshold, least / 1000)))
        if shorter == depth:
            return compared
        depth, before = shorter, (members, compared)


def link(rows: DataFrame, width: int = WIDTH, threshold: float = THRESHOLD) -> DataFrame:
    """``key, root, class_id, n_links`` of every class of equal shingle sets:
    the key that names its group, the group's smallest doc_id, and the links of
    each of its documents.  ``rows`` has ``row.doc_id`` and ``row.text``."""
    copies = sign(rows, width).where("key IS NOT NULL").groupBy("key").agg(
        F.min("row.doc_id").alias("cid"), F.count(F.lit(1)).alias("n"), F.max("size").alias("size"),
        F.first("signature").alias("signature"), F.min(F.struct(F.col("row.doc_id").alias("doc_id"), F.md5("row.text").alias("digest"))).alias("at"))
    classes = written(copies, "classes")
    near = _near(classes, threshold)
    texts = rows.select(F.col("row.doc_id").alias("doc_id"), F.col("row.text").alias("text")).withColumn("digest", F.md5("text"))
    found = texts.join(near, texts["doc_id"].eqNullSafe(near["at.doc_id"]) & (texts["digest"] == near["at.digest"]))
    one_each = written(found.groupBy("key").agg(F.first("text").alias("text")), "texts")  # a row may be repeated as it is
    compared = forest(one_each, near.drop("at"), width, threshold)
    links = compared.groupBy("node").agg(F.sum("links").alias("links"))
    group = components(compared.where("node != root").select(F.col("node").alias("u"), F.col("root").alias("v")))
    joined = written(classes.select("key", "cid", "n").join(links.withColumnRenamed("node", "key"), "key", "left")
                     .join(group.withColumnRenamed("node", "key"), "key", "left")
                     .select("key", F.coalesce("root", "key").alias("root"), "cid", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links")), "linked")
    heads = joined.groupBy("root").agg(F.min("cid").alias("class_id"))
    return joined.join(heads, "root").select("key", "root", "class_id", "n_links")


def join(docs: DataFrame, width: int = WIDTH, threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id, class_id, n_links`` of every row: the smallest doc_id of its
    group of linked documents, and the number of other rows it is linked to."""
    rows = K.as_rows(docs, "doc_id", "text")
    found = link(rows, width, threshold)
    rows = sign(rows, width, 0).select(F.col("row.doc_id").alias("doc_id"), "key").join(found, "key", "left")
    return rows.select("doc_id", F.when(F.col("key").isNull(), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
                       F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"))


def keep_one(docs: DataFrame, width: int = WIDTH, threshold: float = THRESHOLD) -> DataFrame:
    """One whole row of every group, the one with the smallest doc_id (of rows
    that share it, one); rows without words all stay."""
    found = link(K.as_rows(docs, "doc_id", "text"), width, threshold)
    rows = sign(K.as_rows(docs), width, 0).select("row", "key").join(found.select("key", "root", "class_id"), "key", "left")
    free = rows.where("key IS NULL").select("row")
    heads = rows.where(F.col("key").isNotNull() & F.col("row.doc_id").eqNullSafe(F.col("class_id")))
    one = heads.groupBy("root").agg(F.min_by("row", F.struct("key", F.md5("row.text"))).alias("row"))
    return free.union(one.select("row")).select("row.*")
