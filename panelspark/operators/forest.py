"""Random forests of many bagged rows, grown over binned cells.

MLlib keeps a weight a row and tree and reads all rows again for every group of
nodes.  But its trees see a row only by its bins (at most ``max_bins`` a feature)
and its label, so here rows are counted by (cell, label), a cell being one
combination of bins; every row's Poisson weight in every tree is drawn once and
summed to the three sums the variance needs (weight, label, squared label) a cell
and tree; and each tree is grown whole in one task from its cells' sums.  The
rules are MLlib's: thresholds from a sample of ``max(max_bins ** 2, 10000)`` rows,
a random subset of the features a node, the split of the highest gain in variance,
leaves where no split gains.  The draws are other draws of the same distribution.

Nothing relies on rows that repeat: rows of one cell and label share a draw
(a sum of n Poisson(1) is Poisson(n)), others are drawn one by one.  The draws
follow the rows alone, not files, partitions or cores.  The nodes are written in
the layout of a saved ``RandomForestRegressionModel`` and loaded as one.
"""

from __future__ import annotations

import json
import math
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import RandomForestRegressionModel, RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelspark.session import shared_dir

#: Rows x trees above which a forest is grown over cells; below, by MLlib.
MANY_BAGGED = 1 << 26
#: Cells that one task holds to grow a tree (about 100 bytes each, a few times that while it grows).
MOST_CELLS = 1 << 21
#: Sums (cells x trees) a task gathers before it passes them on.
HELD_SUMS = 1 << 21
#: Weights drawn at once.
DRAWN = 1 << 20
EPSILON = 2.0 ** -52

_NODES = ("treeID int, nodeData struct<id:int, prediction:double, impurity:double, impurityStats:array<double>, "
          "rawCount:bigint, gain:double, leftChild:int, rightChild:int, "
          "split:struct<featureIndex:int, leftCategoriesOrThreshold:array<double>, numCategories:int>>")
_NODE_TYPE = pa.struct([
    ("id", pa.int32()), ("prediction", pa.float64()), ("impurity", pa.float64()), ("impurityStats", pa.list_(pa.float64())),
    ("rawCount", pa.int64()), ("gain", pa.float64()), ("leftChild", pa.int32()), ("rightChild", pa.int32()),
    ("split", pa.struct([("featureIndex", pa.int32()), ("leftCategoriesOrThreshold", pa.list_(pa.float64())),
                         ("numCategories", pa.int32())]))])


def subset_size(subset: str, features: int) -> int | None:
    """Features a node chooses from (MLlib's rule); None where it is not known here."""
    sizes = {"all": features, "sqrt": math.ceil(math.sqrt(features)), "onethird": math.ceil(features / 3),
             "log2": max(1, math.ceil(math.log2(features))) if features else 1}
    return sizes.get(subset)


# ---- bins --------------------------------------------------------------------

def thresholds(values: np.ndarray, most: int) -> np.ndarray:
    """MLlib's thresholds of a continuous feature: midpoints between all values
    where they are few, else about equally many sampled rows between two."""
    found, counts = np.unique(values, return_counts=True)
    middles = (found[:-1] + found[1:]) / 2
    if len(middles) <= most:
        return middles
    kept, stride = [], len(values) / (most + 1)
    target, upto = stride, np.cumsum(counts)
    for i in range(1, len(found)):
        if abs(upto[i - 1] - target) < abs(upto[i] - target):
            kept.append(middles[i - 1])
            target += stride
    return np.array(kept)


def _attributes(frame: DataFrame, column: str) -> dict:
    return frame.schema[column].metadata.get("ml_attr", {})


def feature_thresholds(frame: DataFrame, column: str, by: Sequence[str], rows: int, max_bins: int,
                       seed: int) -> list[np.ndarray] | None:
    """Thresholds of every feature, from a sample picked by the hash of its rows
    (of ``by``); 0.5 for one-hot slots.  None for features of other kinds."""
    kinds = _attributes(frame, column).get("attrs", {})
    if kinds.keys() - {"numeric", "binary"}:
        return None
    needed = max(max_bins * max_bins, 10000)
    share = min(1.0, needed / max(rows, 1))
    narrow = frame.select(vector_to_array(column).alias("x"), F.xxhash64(*by, F.lit(seed)).alias("h"))
    picked = narrow if share == 1.0 else narrow.where(F.pmod("h", F.lit(1 << 40)) < int(share * (1 << 40)))
    found = picked.select("x").collect()
    if len(found) < min(needed, rows) / 2:  # few different rows, each often: their hashes are too few
        found = narrow.sample(False, share, seed).select("x").collect()
    sample = np.array([r[0] for r in found], dtype=float).reshape(len(found), -1)
    slots = {a["idx"] for a in kinds.get("binary", [])}
    most = min(max_bins, rows) - 1
    return [np.array([0.5]) if i in slots else thresholds(sample[:, i], most) for i in range(sample.shape[1])]


def _bin_mapper(splits: Sequence[np.ndarray]):
    sizes = [len(s) + 1 for s in splits]

    def binned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            y = batch.column("y").to_numpy(zero_copy_only=False).astype(float)
            if np.isnan(y).any():
                raise ValueError("Labels MUST NOT be Null or NaN")
            x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, len(splits))
            if not np.isfinite(x).all():
                raise ValueError("Vector values MUST NOT be NaN or Infinity")
            cell = np.zeros(batch.num_rows, dtype=np.int64)
            for i, (at, size) in enumerate(zip(splits, sizes)):
                cell = cell * size + np.searchsorted(at, x[:, i], side="left")
            yield pa.RecordBatch.from_arrays([pa.array(cell), pa.array(y)], ["cell", "y"])
    return binned


def bins_of(cells: np.ndarray, sizes: Sequence[int]) -> np.ndarray:
    """The bins (cells x features) that ``_bin_mapper`` made the cells of."""
    out = np.empty((len(cells), len(sizes)), dtype=np.int32)
    for i in range(len(sizes) - 1, -1, -1):
        cells, out[:, i] = np.divmod(cells, sizes[i])
    return out


@dataclass(frozen=True)
class Cells:
    """Rows counted by (cell, label), persisted; ``dealt`` into so many shares."""
    counted: DataFrame
    splits: list[np.ndarray]
    shares: int

    @property
    def sizes(self) -> list[int]:
        return [len(s) + 1 for s in self.splits]


@contextmanager
def cells_of(frame: DataFrame, column: str, label: str, by: Sequence[str], rows: int, shares: int,
             max_bins: int, seed: int) -> Iterator[Cells | None]:
    """The ``Cells`` of ``rows`` rows; None where they are too many for a task, or
    the features have kinds that are not binned here.

    A cell of more rows than a share is split by its labels, and rows equal in both
    are one counted row, so no cell is a hot partition."""
    splits = feature_thresholds(frame, column, by, rows, max_bins, seed)
    if splits is None or math.prod(len(s) + 1 for s in splits) >= 1 << 62:
        yield None
        return
    binned = frame.select(vector_to_array(column).alias("x"), F.col(label).cast("double").alias("y")) \
        .mapInArrow(_bin_mapper(splits), "cell long, y double")
    counted = binned.groupBy("cell", "y").agg(F.count(F.lit(1)).alias("m")).persist(StorageLevel.MEMORY_AND_DISK)
    by_cell = counted.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        found, different = by_cell.agg(F.count(F.lit(1)), F.sum("n")).first()
        if found > MOST_CELLS:
            yield None
            return
        share = max(1, different // shares)
        hot = by_cell.where(F.col("n") > share).select("cell", F.ceil(F.col("n") / share).alias("parts"))
        part = F.coalesce(F.pmod(F.xxhash64("y"), F.col("parts")), F.lit(0))
        dealt = counted.join(F.broadcast(hot), "cell", "left").withColumn("part", part) \
            .repartition(shares, "cell", "part").select("cell", "y", "m").sortWithinPartitions("cell", "y")
        yield Cells(dealt, splits, shares)
    finally:
        by_cell.unpersist()
        counted.unpersist()


# ---- bags --------------------------------------------------------------------

def _sums_mapper(trees: int, bootstrap: bool, seed: int):
    """Per tree: the cells and their weight, label and squared label summed over
    the rows as the tree draws them (each as bytes)."""
    step = max(1, DRAWN // trees)

    def passed(cells: list, sums: list) -> Iterator[pa.RecordBatch]:
        if not cells:
            return
        keys, held = np.concatenate(cells), np.concatenate(sums, axis=1)
        for tree in range(trees):
            drawn = np.flatnonzero(held[0, :, tree])
            yield pa.RecordBatch.from_arrays(
                [pa.array([tree], pa.int32()), pa.array([keys[drawn].tobytes()], pa.binary()),
                 pa.array([np.ascontiguousarray(held[:, drawn, tree]).tobytes()], pa.binary())], ["tree", "cells", "sums"])

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        draws = np.random.Generator(np.random.PCG64([seed & 0xFFFFFFFF, TaskContext.get().partitionId()]))
        cells, sums, held = [], [], 0
        for batch in batches:
            columns = [batch.column(c).to_numpy(zero_copy_only=False) for c in ("cell", "y", "m")]
            for at in range(0, batch.num_rows, step):
                cell, y, m = (c[at:at + step] for c in columns)
                starts = np.flatnonzero(np.concatenate(([True], cell[1:] != cell[:-1])))
                often = np.broadcast_to(m.astype(float)[:, None], (len(m), trees))
                weight = draws.poisson(often).astype(float) if bootstrap else often
                times = weight * y[:, None]
                cells.append(cell[starts])
                sums.append(np.stack([np.add.reduceat(v, starts) for v in (weight, times, times * y[:, None])]))
                held += len(starts) * trees
                if held >= HELD_SUMS:
                    yield from passed(cells, sums)
                    cells, sums, held = [], [], 0
        yield from passed(cells, sums)
    return summed


# ---- trees -------------------------------------------------------------------

def _impurity(sums: np.ndarray) -> np.ndarray:
    weight = np.maximum(sums[..., 0], 1.0)
    return (sums[..., 2] - sums[..., 1] * sums[..., 1] / weight) / weight


def grown(bins: np.ndarray, sums: np.ndarray, sizes: Sequence[int], depth: int, choose: int,
          draws: np.random.Generator) -> dict[str, np.ndarray]:
    """A tree over cells, level by level: per node its sums, gain, feature, last
    bin on the left and left child (-1 in leaves; the right child is the next)."""
    sizes, width, features = np.asarray(sizes), max(sizes), len(sizes)
    level = sums.sum(axis=0, keepdims=True)
    at, rows = np.zeros(len(bins), dtype=np.int64), np.arange(len(bins))
    tables, upto = [], 0
    for deep in range(depth + 1):
        count = len(level)
        impurity = _impurity(level)
        gain, feature, last = np.zeros(count), np.full(count, -1), np.full(count, -1)
        lefts = np.zeros((count, 3))
        if deep < depth:
            picked = np.argsort(draws.random((count, features)), axis=1)[:, :choose]
            for f in picked.T:
                slot = at * width + bins[rows, f[at]]
                hist = np.stack([np.bincount(slot, sums[rows, i], count * width) for i in range(3)], axis=-1)
                left = hist.reshape(count, width, 3).cumsum(axis=1)[:, :-1]
                right = level[:, None] - left
                gains = impurity[:, None] - (left[..., 0] * _impurity(left) + right[..., 0] * _impurity(right)) / level[:, :1]
                allowed = (left[..., 0] > 0.5) & (right[..., 0] > 0.5) & (np.arange(width - 1) < sizes[f][:, None] - 1)
                gains = np.where(allowed, gains, -np.inf)
                if not gains.size:
                    continue
                best = gains.argmax(axis=1)
                each = np.arange(count)
                better = gains[each, best] > gain
                gain = np.where(better, gains[each, best], gain)
                feature, last = np.where(better, f, feature), np.where(better, best, last)
                lefts = np.where(better[:, None], left[each, best], lefts)
        split = (gain > 0) & (np.abs(impurity) >= EPSILON)
        children = np.full(count, -1)
        children[split] = upto + count + 2 * np.arange(split.sum())
        tables.append({"sums": level, "impurity": impurity, "gain": np.where(split, gain, -1.0),
                       "feature": np.where(split, feature, -1), "last": last, "left": children})
        if not split.any():
            break
        upto += count
        kept = split[at]
        rows, at = rows[kept], at[kept]
        right = bins[rows, feature[at]] > last[at]
        at = 2 * (np.cumsum(split) - 1)[at] + right
        level = np.stack([lefts[split], level[split] - lefts[split]], axis=1).reshape(-1, 3)
    return {k: np.concatenate([t[k] for t in tables]) for k in tables[0]}


def _in_order(left: np.ndarray) -> np.ndarray:
    """Each node's number when a node comes before its left, then its right subtree."""
    size, number = np.ones(len(left), dtype=np.int64), np.zeros(len(left), dtype=np.int64)
    for i in range(len(left) - 1, -1, -1):
        if left[i] >= 0:
            size[i] += size[left[i]] + size[left[i] + 1]
    for i in range(len(left)):
        if left[i] >= 0:
            number[left[i]] = number[i] + 1
            number[left[i] + 1] = number[i] + 1 + size[left[i]]
    return number


def _node_rows(number: int, tree: dict[str, np.ndarray], splits: Sequence[np.ndarray]) -> pa.Table:
    ids = _in_order(tree["left"])
    nodes = [None] * len(ids)
    for i, me in enumerate(ids):
        weight, total, _ = sums = [float(v) for v in tree["sums"][i]]
        left, f = int(tree["left"][i]), int(tree["feature"][i])
        inner = left >= 0
        nodes[me] = {"id": int(me), "prediction": total / weight, "impurity": float(tree["impurity"][i]),
                     "impurityStats": sums, "rawCount": round(weight), "gain": float(tree["gain"][i]),
                     "leftChild": int(ids[left]) if inner else -1, "rightChild": int(ids[left + 1]) if inner else -1,
                     "split": {"featureIndex": f, "numCategories": -1,
                               "leftCategoriesOrThreshold": [float(splits[f][tree["last"][i]])] if inner else []}}
    return pa.table([pa.array([number] * len(nodes), pa.int32()), pa.array(nodes, _NODE_TYPE)], ["treeID", "nodeData"])


def _grow(splits: Sequence[np.ndarray], depth: int, choose: int, seed: int):
    sizes = [len(s) + 1 for s in splits]

    def grow(table: pa.Table) -> pa.Table:
        number = table.column("tree")[0].as_py()
        parts = [(np.frombuffer(c.as_py(), dtype=np.int64), np.frombuffer(s.as_py()).reshape(3, -1))
                 for c, s in zip(table.column("cells"), table.column("sums"))]
        # Shares and flushed parts of one cell are summed in the order of their bytes, not of arrival.
        parts.sort(key=lambda p: (p[0].tobytes(), p[1].tobytes()))
        cells, where = np.unique(np.concatenate([c for c, _ in parts]), return_inverse=True)
        held = np.concatenate([s for _, s in parts], axis=1)
        sums = np.stack([np.bincount(where, v, len(cells)) for v in held], axis=1)
        draws = np.random.Generator(np.random.PCG64([seed & 0xFFFFFFFF, 1 << 31, number]))
        return _node_rows(number, grown(bins_of(cells, sizes), sums, sizes, depth, choose, draws), splits)
    return grow


# ---- the model ---------------------------------------------------------------

def _write_metadata(spark, estimator: RandomForestRegressor, path: str, trees: int, features: int) -> None:
    """The metadata MLlib writes beside the nodes, from the estimator's own."""
    estimator.write().overwrite().save(f"{path}/estimator")
    meta = json.loads(spark.read.text(f"{path}/estimator/metadata").first()[0])
    models = "org.apache.spark.ml.regression."
    forest = meta | {"class": f"{models}RandomForestRegressionModel", "numFeatures": features, "numTrees": trees}
    spark.createDataFrame([(json.dumps(forest),)], "value string").coalesce(1).write.text(f"{path}/model/metadata")
    of_forests = ("bootstrap", "featureSubsetStrategy", "numTrees", "subsamplingRate")
    tree = meta | {"class": f"{models}DecisionTreeRegressionModel"}
    for params in ("paramMap", "defaultParamMap"):
        tree[params] = {k: v for k, v in meta[params].items() if k not in of_forests}
    rows = [(t, json.dumps(tree | {"uid": f"dtr_{uuid.uuid4().hex[:12]}"}), 1.0) for t in range(trees)]
    spark.createDataFrame(rows, "_1 int, _2 string, _3 double").write.parquet(f"{path}/model/treesMetadata")


def fit_cells(cells: Cells, estimator: RandomForestRegressor) -> RandomForestRegressionModel:
    """The forest of ``estimator``'s parameters over all rows of ``cells``."""
    spark = cells.counted.sparkSession
    trees, seed, features = estimator.getNumTrees(), estimator.getSeed(), len(cells.splits)
    path = shared_dir(spark, "models", "cells", unique=True)
    bagged = cells.counted.mapInArrow(_sums_mapper(trees, estimator.getBootstrap(), seed), "tree int, cells binary, sums binary")
    grow = _grow(cells.splits, estimator.getMaxDepth(), subset_size(estimator.getFeatureSubsetStrategy(), features), seed)
    bagged.repartition(trees, "tree").groupBy("tree").applyInArrow(grow, _NODES).write.parquet(f"{path}/model/data")
    _write_metadata(spark, estimator, path, trees, features)
    return RandomForestRegressionModel.load(f"{path}/model")
