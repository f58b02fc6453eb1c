"""Operator 13: a Merkle manifest of a dataset, by nested-interval labels.

Rows are leaves of one tree a source, ordered by doc_id; sixteen consecutive
nodes have one parent, up to the source's subroot, and the subroots form a tree
of their own.  Every node carries the interval ``[lo, hi)`` of leaf ranks that
it covers.  A node of level k can only lie in the parent whose interval starts
at the same multiple of 16 ** (k + 1), so ancestors are attached level by level
by a join on that bucket and the containment of intervals.  The siblings of a
node are the rest of its parent's interval once its own is taken out: nodes that
end before it starts (left) and nodes that start after it ends (right).

Nothing is gathered by source: ranks come from a range partitioning on (source,
doc_id) and the offsets of its parts, groups have at most sixteen nodes, and the
paths of siblings are attached top-down, so leaves meet only their level-1 node.
The driver sees three numbers: the leaves of the largest source, the number of
sources, and the root.

Cases: a null field is written ``-``; a null source is a source of its own, the
first; null doc_ids come first in their source; rows that share a doc_id stand
by their leaf digests, so equal rows are leaves of their own.  A source of one
row has that leaf as its subroot, a table of one source that subroot as its root.
Proofs without siblings are the digest of no input.  Extra columns are not read.
An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelspark.llm.tables import written

#: Fixed values of the contract.
ARITY = 16
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

_STEPS = "array<struct<left:string,right:string>>"


def digest(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts), 256)


def framed(value: Column) -> Column:
    """``-`` of null, else the UTF-8 byte count, ``:`` and the value."""
    text = value.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaves(docs: DataFrame, tampered: Column | None = None) -> DataFrame:
    """``tree, doc_id, leaf, touched``: each row's digest, and its digest after
    tampering where ``tampered`` holds (A-Z of the text lower-cased)."""
    columns = {name: docs[name] for name in FIELDS}
    leaf = digest(*[framed(c) for c in columns.values()])
    changed = columns | {"text": F.translate(columns["text"], _UPPER, _LOWER)}
    tampered = F.lit(False) if tampered is None else F.coalesce(tampered, F.lit(False))
    source = columns["source"].cast("string")
    return docs.select(F.when(source.isNull(), F.lit("")).otherwise(F.concat(F.lit("="), source)).alias("tree"),
                       columns["doc_id"].alias("doc_id"), leaf.alias("leaf"),
                       F.when(tampered, digest(*[framed(c) for c in changed.values()])).alias("touched")) \
        .withColumn("touched", F.coalesce("touched", "leaf"))


def ranked(rows: DataFrame, order: list[str], name: str) -> DataFrame:
    """The rows with ``lo``, their place in their ``tree`` by ``order``, and
    ``n``, the size of the tree; sorted by range, never one tree in one task."""
    keys = ["tree", *order]
    placed = written(rows.repartitionByRange(*keys).sortWithinPartitions(*keys)
                     .withColumn("at", F.monotonically_increasing_id()).withColumn("part", F.shiftright("at", 33)), name)
    tree = Window.partitionBy("tree")
    earlier = tree.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    runs = placed.groupBy("tree", "part").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("m")) \
        .select("tree", "part", (F.coalesce(F.sum("m").over(earlier), F.lit(0)) - F.col("first")).alias("shift"),
                F.sum("m").over(tree).alias("n"))
    return written(placed.join(runs, ["tree", "part"]).withColumn("lo", F.col("at") + F.col("shift"))
                   .drop("at", "part", "shift"), name)


def _bucket(level: int) -> Column:
    """Start of the interval of ``level`` that the row's interval lies in."""
    return F.col("lo") - F.pmod(F.col("lo"), F.lit(ARITY ** level))


def levels(base: DataFrame, largest: int) -> list[DataFrame]:
    """The nodes of every level (``tree, n, lo, hi, digest, kids``), the leaves'
    first; a tree has a level while the one below has several nodes."""
    found = [base.select("tree", "n", "lo", (F.col("lo") + 1).alias("hi"), "digest")]
    while ARITY ** (len(found) - 1) < largest:
        level = len(found)
        kids = found[-1].where(F.col("n") > ARITY ** (level - 1)).groupBy("tree", _bucket(level).alias("low")).agg(
            F.max("n").alias("n"), F.array_sort(F.collect_list(F.struct("lo", "hi", "digest"))).alias("kids"))
        found.append(written(kids.select("tree", "n", F.col("low").alias("lo"), F.array_max("kids.hi").alias("hi"),
                                         digest(F.array_join("kids.digest", "")).alias("digest"), "kids"), "nodes"))
    return found


def roots(nodes: list[DataFrame]) -> DataFrame:
    """``tree, root`` of every tree: its one node at the level where one is left."""
    tops = [rows.where((F.col("n") <= ARITY ** level) & (F.col("n") > (ARITY ** (level - 1) if level else 0)))
            .select("tree", F.col("digest").alias("root")) for level, rows in enumerate(nodes)]
    whole = tops[0]
    for rows in tops[1:]:
        whole = whole.union(rows)
    return whole


def _siblings(parent: str = "kids") -> Column:
    """The parent's interval less the node's own: digests to its left and right."""
    side = lambda test: F.array_join(F.transform(F.filter(parent, test), lambda x: x["digest"]), "")
    return F.struct(side(lambda x: x["hi"] <= F.col("lo")).alias("left"), side(lambda x: x["lo"] >= F.col("hi")).alias("right"))


def attached(nodes: list[DataFrame], base: DataFrame, above: DataFrame) -> DataFrame:
    """``base`` (the leaves, with ``hi``) with ``root`` and ``steps``, the siblings
    of the leaf and of each ancestor, upwards; ``above`` (``tree, root, more``)
    continues the steps beyond a tree's root."""
    held = None
    for level in range(len(nodes) - 1, -1, -1):
        rows = nodes[level] if level else base
        alone = F.col("n") <= ARITY ** level
        top = rows.where(alone).join(above, "tree").withColumnRenamed("more", "steps")
        if held is not None:
            parent = held.select("tree", F.col("lo").alias("low"), F.col("hi").alias("high"), F.col("kids").alias("family"),
                                 "root", F.col("steps").alias("upper"))
            joined = rows.where(~alone).withColumn("low", _bucket(level + 1)).join(parent, ["tree", "low"]) \
                .where((F.col("low") <= F.col("lo")) & (F.col("hi") <= F.col("high")))
            inner = joined.withColumn("steps", F.concat(F.array(_siblings("family")), "upper")).drop("low", "high", "family", "upper")
            top = top.unionByName(inner)
        held = written(top, "paths") if level else top
    return held


def manifest(docs: DataFrame, tampered: Column | None = None) -> DataFrame:
    """``doc_id, leaf, subroot, root, proof_sha256, folded_root, verified`` of
    every row; ``tampered`` marks rows whose text is changed before folding."""
    base = ranked(leaves(docs, tampered), ["doc_id", "leaf"], "leaves") \
        .withColumn("hi", F.col("lo") + 1).withColumn("digest", F.col("leaf"))
    sources = levels(base, base.agg(F.max("n")).first()[0] or 0)
    subroots = ranked(roots(sources).select(F.lit("").alias("tree"), F.col("tree").alias("source"), F.col("root").alias("digest")),
                      ["source"], "subroots").withColumn("hi", F.col("lo") + 1)
    tops = levels(subroots, subroots.agg(F.max("n")).first()[0] or 0)
    found = roots(tops).first()
    root = F.lit(found["root"] if found else None).cast("string")
    none = F.array().cast(_STEPS)
    above = attached(tops, subroots, roots(tops).select("tree", "root", none.alias("more"))) \
        .select(F.col("source").alias("tree"), F.col("digest").alias("root"), F.col("steps").alias("more"))
    proofs = attached(sources, base, above)
    listed = F.array_join(F.transform("steps", lambda s: F.concat(s["left"], s["right"])), "")
    folded = F.aggregate("steps", F.col("touched"), lambda now, s: digest(s["left"], now, s["right"]))
    return proofs.select("doc_id", "leaf", F.col("root").alias("subroot"), root.alias("root"),
                         F.sha2(listed, 256).alias("proof_sha256"), folded.alias("folded_root")) \
        .withColumn("verified", F.col("folded_root") == F.col("root"))
