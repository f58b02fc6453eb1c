"""KMeans of many rows for several k at once (M3-M6).

MLlib fits one k after another, each with passes of its own over the rows.  Here
all k share their passes: the k-means|| start, the rounds and the silhouette.  Rows
equal in all features are one point that carries their count, and the points are
kept in blocks of bytes.  The steps are MLlib's: one random first centre, two
steps that pick 2 k points on average by their cost, weighted k-means++ among the
picked ones, rounds until no centre moves by more than ``TOL`` or ``max_iter`` is
reached, the cost of the last round, and the squared Euclidean silhouette.

A point is picked by a hash of its (unscaled) values and the step, with the probability that
one of its rows is picked; so a fit follows the rows alone, and nothing relies on
rows that repeat: rows that do not are points of one row.
"""

from __future__ import annotations

import json
import math
from collections.abc import Callable, Iterator, Mapping, Sequence
from contextlib import contextmanager
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelspark.session import shared_dir

#: Rows above which a sweep shares its passes; below, every k is a fit of MLlib's.
MANY_ROWS = 1 << 22
TOL, START_STEPS, LOCAL_ROUNDS = 1e-4, 2, 30
#: Points of a block, compared at once.
COMPARED = 1 << 13


# ---- points --------------------------------------------------------------------

def _column_mapper(width: int):
    def columns(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, width)
                if not np.isfinite(x).all():
                    raise ValueError("Vector values MUST NOT be NaN or Infinity")
                yield pa.RecordBatch.from_arrays([*[pa.array(x[:, i]) for i in range(width)], batch.column("m"), batch.column("h")],
                                                 [*[f"x{i}" for i in range(width)], "m", "h"])
    return columns


def _block_mapper(names: Sequence[str]):
    """Points as blocks of bytes: the rows of a matrix are the features, ``m`` and ``h``."""
    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            *x, m, h = (batch.column(c).to_numpy(zero_copy_only=False) for c in (*names, "m", "h"))
            matrix = np.stack([*x, m.astype(float), h.view(np.float64)])
            blocks = [np.ascontiguousarray(matrix[:, at:at + COMPARED]).tobytes() for at in range(0, batch.num_rows, COMPARED)]
            yield pa.RecordBatch.from_arrays([pa.array(blocks, pa.binary())], ["block"])
    return packed


def _unpacked(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Every block's features (by column), counts and hashes."""
    for batch in batches:
        for block in batch.column("block"):
            matrix = np.frombuffer(block.as_buffer()).reshape(width + 2, -1)
            yield matrix[:width], matrix[width], matrix[width + 1].view(np.int64)


@dataclass(frozen=True)
class Points:
    """Different points in persisted blocks of ``COMPARED``, each with its features,
    the count ``m`` of its rows and a hash ``h``."""
    blocks: DataFrame
    width: int


@contextmanager
def points_of(df: DataFrame, features_col: str, seed: int, count_col: str | None = None,
              raw: Sequence[str] = ()) -> Iterator[Points]:
    """The different points of ``df``.  ``count_col``: rows that a row of ``df`` stands
    for; ``raw``: columns to hash instead of features whose last bits may vary."""
    array = vector_to_array(features_col)
    width = len(df.select(array).first()[0])
    names = [f"x{i}" for i in range(width)]
    count = F.lit(1) if count_col is None else F.col(count_col)
    rows = df.select(array.alias("x"), count.cast("long").alias("m"), F.xxhash64(*(raw or [array]), F.lit(seed)).alias("h")) \
        .mapInArrow(_column_mapper(width), ", ".join(f"{c} double" for c in names) + ", m long, h long")
    blocks = rows.groupBy(*names, "h").agg(F.sum("m").alias("m")).select(*names, "m", "h") \
        .mapInArrow(_block_mapper(names), "block binary").persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield Points(blocks, width)
    finally:
        blocks.unpersist()


def _draws(h: np.ndarray, step: int) -> np.ndarray:
    """Uniform numbers in [0, 1) of the hashes for a step (splitmix64's finish)."""
    z = h.astype(np.uint64) + np.uint64((step + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return ((z ^ (z >> np.uint64(31))) >> np.uint64(11)).astype(float) * 2.0 ** -53


def _nearest(x: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each point's nearest centre (ties: the first) and squared distance; ``x`` by column."""
    best, which = None, np.zeros(x.shape[1], dtype=np.int64)
    for i, centre in enumerate(centres):
        cost = np.zeros(x.shape[1])
        for values, at in zip(x, centre):
            apart = values - at
            cost += apart * apart
        if best is None:
            best = cost
        else:
            which[cost < best] = i
            np.minimum(best, cost, out=best)
    return which, best


def _passed(points: Points, over: Callable) -> list:
    """One pass: ``over(x, m, h)`` of every block gives a state (an array) that is
    added up a partition; the states, as lists of doubles."""
    width = points.width

    def mapper(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for block in _unpacked(batches, width):
            found = over(*block)
            total = found if total is None else total + found
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total], pa.list_(pa.float64()))], ["state"])
    return points.blocks.mapInArrow(mapper, "state array<double>").collect()


def _summed(points: Points, over: Callable) -> np.ndarray:
    """The states of a pass added up exactly, whatever their order."""
    rows = _passed(points, over)
    return np.array([math.fsum(v) for v in zip(*[r[0] for r in rows])])


# ---- start ---------------------------------------------------------------------

def _first(points: Points) -> np.ndarray:
    """The first of all rows in random order: a point of m rows has m chances."""
    width = points.width

    def mapper(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        least = None
        for x, m, h in _unpacked(batches, width):
            rank = -np.log(_draws(h, -1) + 2.0 ** -54) / m
            found = min((float(rank[i]), *map(float, x[:, i])) for i in np.flatnonzero(rank == rank.min()))
            least = found if least is None else min(least, found)
        if least is not None:
            yield pa.RecordBatch.from_arrays([pa.array([least], pa.list_(pa.float64()))], ["x"])
    return np.array(min(r[0] for r in points.blocks.mapInArrow(mapper, "x array<double>").collect())[1:])


def _picked(points: Points, found: Mapping[int, np.ndarray], sums: Mapping[int, float], step: int) -> dict[int, np.ndarray]:
    """The points picked for every k, each with probability 2 k cost / sum a row."""
    width = points.width

    def mapper(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x, m, h in _unpacked(batches, width):
            draws = _draws(h, step)
            for k, centres in found.items():
                if sums[k] > 0:
                    chance = np.minimum(2.0 * k * _nearest(x, centres)[1] / sums[k], 1.0)
                    with np.errstate(divide="ignore"):
                        any_row = -np.expm1(m * np.log1p(-chance))
                    took = np.flatnonzero(draws < any_row)
                    if len(took):
                        yield pa.RecordBatch.from_arrays([pa.array([k] * len(took), pa.int32()), pa.array(list(x[:, took].T))], ["k", "x"])
    rows = sorted(tuple(r) for r in points.blocks.mapInArrow(mapper, "k int, x array<double>").collect())
    return {k: np.array([r[1] for r in rows if r[0] == k]).reshape(-1, width) for k in found}


def _local(candidates: np.ndarray, weights: np.ndarray, k: int, seed: int) -> np.ndarray:
    """Weighted k-means++ and rounds among the candidates (on the driver)."""
    draws = np.random.Generator(np.random.PCG64(seed & 0xFFFFFFFF))
    x = candidates.T
    centres = candidates[[draws.choice(len(candidates), p=weights / weights.sum())]]
    while len(centres) < k:
        chance = weights * _nearest(x, centres)[1]
        if not chance.sum() > 0:
            chance = np.ones(len(candidates))
        centres = np.vstack([centres, candidates[draws.choice(len(candidates), p=chance / chance.sum())]])
    before = None
    for _ in range(LOCAL_ROUNDS):
        which, _ = _nearest(x, centres)
        if before is not None and (which == before).all():
            break
        before = which
        held = np.bincount(which, weights, k)
        for j in range(k):
            centres[j] = candidates[draws.integers(len(candidates))] if held[j] == 0 else \
                (candidates[which == j] * weights[which == j, None]).sum(axis=0) / held[j]
    return centres


def first_centres(points: Points, ks: Sequence[int], seed: int) -> dict[int, np.ndarray]:
    """k-means|| for every k, its passes shared."""
    first = _first(points)
    found = {k: first[None] for k in ks}
    for step in range(START_STEPS):
        sums = _summed(points, lambda x, m, h: np.array([(m * _nearest(x, c)[1]).sum() for c in found.values()]))
        new = _picked(points, found, dict(zip(found, sums)), step)
        found = {k: np.vstack([found[k], new[k]]) for k in ks}
    found = {k: np.array(list(dict.fromkeys(map(tuple, c)))) for k, c in found.items()}
    counts = _summed(points, lambda x, m, h: np.concatenate(
        [np.bincount(_nearest(x, c)[0], m, len(c)) for c in found.values()]))
    ends = np.cumsum([len(c) for c in found.values()])
    weights = dict(zip(found, np.split(counts, ends)))
    return {k: c if len(c) <= k else _local(c, weights[k], k, seed) for k, c in found.items()}


# ---- rounds --------------------------------------------------------------------

def _cluster_sums(centres: Mapping[int, np.ndarray]):
    """Per k: the cost, then per cluster the rows, sums and sum of squares."""
    def over(x: np.ndarray, m: np.ndarray, h: np.ndarray) -> np.ndarray:
        squares, state = m * (x * x).sum(axis=0), []
        for c in centres.values():
            which, cost = _nearest(x, c)
            state.append([(m * cost).sum()])
            state += [np.bincount(which, v, len(c)) for v in (m, *(m * x), squares)]
        return np.concatenate(state)
    return over


def _by_k(state: np.ndarray, centres: Mapping[int, np.ndarray], width: int) -> dict[int, tuple[float, np.ndarray]]:
    out, at = {}, 0
    for k, c in centres.items():
        size = len(c) * (width + 2)
        out[k] = (float(state[at]), state[at + 1:at + 1 + size].reshape(width + 2, len(c)))
        at += 1 + size
    return out


def rounds(points: Points, start: Mapping[int, np.ndarray], max_iter: int) -> dict[int, tuple[np.ndarray, float]]:
    """(centres, cost of the last round) of every k; a k that has settled drops out."""
    width, going, done = points.width, dict(start), {}
    for turn in range(max_iter):
        state = _by_k(_summed(points, _cluster_sums(going)), going, width)
        moving = {}
        for k, c in going.items():
            cost, sums = state[k]
            held = sums[0] > 0
            new = np.where(held[:, None], (sums[1:-1] / np.where(held, sums[0], 1.0)).T, c)
            moved = ((new - c) ** 2).sum(axis=1)
            if (moved <= TOL * TOL).all() or turn == max_iter - 1:
                done[k] = (new, cost)
            else:
                moving[k] = new
        going = moving
        if not going:
            break
    return {k: done[k] for k in start}


def silhouettes(points: Points, centres: Mapping[int, np.ndarray]) -> dict[int, float]:
    """The mean squared Euclidean silhouette of every k: two passes for all."""
    width = points.width
    sums = {k: s for k, (_, s) in _by_k(_summed(points, _cluster_sums(centres)), centres, width).items()}
    for s in sums.values():
        if (s[0] > 0).sum() < 2:
            raise ValueError("Number of clusters must be greater than one.")

    def over(x: np.ndarray, m: np.ndarray, h: np.ndarray) -> np.ndarray:
        norm, state = (x * x).sum(axis=0), []
        for k, c in centres.items():
            which, _ = _nearest(x, c)
            rows, totals, squares = sums[k][0], sums[k][1:-1], sums[k][-1]
            held = np.where(rows > 0, rows, 1.0)
            apart = norm[:, None] + squares / held - 2 * sum(v[:, None] * t / held for v, t in zip(x, totals))
            apart[:, rows == 0] = np.inf
            each = np.arange(len(which))
            own = apart[each, which] * held[which] / np.maximum(rows[which] - 1, 1)
            apart[each, which] = np.inf
            other = apart.min(axis=1)
            more = np.maximum(own, other)
            score = np.where(more > 0, (other - own) / np.where(more > 0, more, 1.0), 0.0)
            state.append((m * np.where(rows[which] == 1, 0.0, score)).sum())
        return np.array(state)
    total = _summed(points, over)
    return {k: float(t / sums[k][0].sum()) for k, t in zip(centres, total)}


def as_model(spark, estimator: KMeans, centres: np.ndarray) -> KMeansModel:
    """A ``KMeansModel`` of these centres, written as MLlib does and loaded."""
    path = shared_dir(spark, "models", "kmeans", unique=True)
    estimator.write().overwrite().save(f"{path}/estimator")
    meta = json.loads(spark.read.text(f"{path}/estimator/metadata").first()[0])
    meta["class"] = "org.apache.spark.ml.clustering.KMeansModel"
    spark.createDataFrame([(json.dumps(meta),)], "value string").coalesce(1).write.text(f"{path}/model/metadata")
    rows = [(i, [float(v) for v in c]) for i, c in enumerate(centres)]
    spark.createDataFrame(rows, "clusterIdx int, c array<double>") \
        .select("clusterIdx", array_to_vector("c").alias("clusterCenter")).write.parquet(f"{path}/model/data")
    return KMeansModel.load(f"{path}/model")


def shared_sweep(df: DataFrame, estimators: Mapping[int, KMeans], seed: int,
                 count_col: str | None = None, raw: Sequence[str] = ()) -> dict[int, tuple[KMeansModel, float, float]]:
    """(model, silhouette, cost) of every k, over all rows."""
    any_est = next(iter(estimators.values()))
    with points_of(df, any_est.getFeaturesCol(), seed, count_col, raw) as points:
        fitted = rounds(points, first_centres(points, list(estimators), seed), any_est.getMaxIter())
        scores = silhouettes(points, {k: c for k, (c, _) in fitted.items()})
    return {k: (as_model(df.sparkSession, estimators[k], c), scores[k], cost) for k, (c, cost) in fitted.items()}
