"""Quantiles by group: exact (distributed selection) or approximate (sketch).

``percentile_disc`` in Spark merges one value->count map per group inside a
single task, so a group holding a third of all rows would sit in one task's
memory.  ``exact_quantiles`` instead selects the ranked value without ever
putting a whole group in one task:

1. ``value_counts``: pre-aggregate ``(group, value) -> count`` (map-side
   combine; a value that repeats many times collapses to one row, so no single
   key is hot), range-partitioned on ``(group, value)``: Spark samples the keys,
   so a large group is cut into many contiguous value slices;
2. one small aggregate gives each slice's ``[lo, hi]`` and row count; a running
   sum over that table (at most slices + groups rows) finds, for each group and
   probability, the slice holding rank ``max(1, ceil(p * n))`` and the rank
   inside it;
3. the rows of those slices alone are cut into slices again, and again only the
   one with the rank is kept, so that a slice of any size is split (``REFINE``
   times);
4. the rows that are left are ranked and the value at the local rank is taken.

Without groups there is nothing to join on: the few target ranges come as one
array from a scalar subquery, and rows are matched with it where they are.

The result is the SQL-standard ``percentile_disc`` (equal to DuckDB's
``quantile_disc``).  ``approx_quantiles`` is Spark's Greenwald-Khanna sketch
``percentile_approx`` (bounded memory, partial aggregation), the method to use
when an approximate answer is enough.  ``moments`` reads the same counts, so one
scan of the source serves a whole summary.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _probs_column(probs: Sequence[float]) -> Column:
    return F.explode(F.array(*[F.lit(float(p)) for p in probs]))


#: Times that the slices holding a target rank are sliced again.
REFINE = 1


def value_counts(df: DataFrame, value: str, by: Sequence[str] = (), slices: int | None = None) -> DataFrame:
    """``*by, _x, _c``: how often each value (NULL too) occurs in each group, in
    contiguous ranges of (group, value).

    The one pre-aggregate that counts, moments and quantiles of a column share:
    all read its exchange, so the source is scanned once.  Without an explicit
    ``slices`` AQE may merge neighbouring ranges up to its advisory size; they
    stay contiguous, which is all that is needed."""
    by = list(by)
    counted = df.select(*by, F.col(value).alias("_x")).groupBy(*by, "_x").agg(F.count(F.lit(1)).alias("_c"))
    return counted.repartitionByRange(slices, *by, "_x") if slices else counted.repartitionByRange(*by, "_x")


def _same(left: Sequence[str], right: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(x).eqNullSafe(F.col(y)) for x, y in zip(left, right)], F.lit(True))


def moments(counts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """``*by, rows, n, mean, stddev, min, max`` of ``value_counts``: all rows, those
    with a value, and the values' moments.

    Squares are summed around the group's mean in a second pass over the counts
    (not over the source), so large values do not cancel out.  The means are one
    row a group; AQE broadcasts them by their measured size."""
    by = list(by)
    has = F.col("_x").isNotNull()
    first = (counts.groupBy(*by) if by else counts.groupBy()).agg(
        F.sum("_c").alias("rows"), F.coalesce(F.sum(F.when(has, F.col("_c"))), F.lit(0)).alias("n"),
        F.sum(F.col("_x") * F.col("_c")).alias("_sum"), F.min("_x").alias("min"), F.max("_x").alias("max")) \
        .withColumn("mean", F.try_divide("_sum", "n"))
    if by:
        names = [f"_k{i}" for i in range(len(by))]
        means = first.select(*[F.col(k).alias(n) for k, n in zip(by, names)], F.col("mean").alias("_mean"))
        around = counts.join(means, _same(by, names))
    else:
        around = counts.withColumn("_mean", first.select("mean").scalar())
    off = F.col("_x") - F.col("_mean")
    spread = (around.groupBy(*by) if by else around.groupBy()).agg(F.sum(off * off * F.col("_c")).alias("_ss"))
    whole = (first.unionByName(spread, allowMissingColumns=True).groupBy(*by) if by
             else first.unionByName(spread, allowMissingColumns=True).groupBy())
    kept = whole.agg(*[F.max(c).alias(c) for c in ("rows", "n", "mean", "min", "max", "_ss")])
    return kept.withColumn("stddev", F.sqrt(F.try_divide("_ss", F.nullif(F.col("n") - 1, F.lit(0))))).select(
        *by, "rows", "n", "mean", "stddev", "min", "max")


def _targets(ranged: DataFrame, by: Sequence[str], ranks: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``*by, _p, _lo, _hi, _local``: the slices that hold the ranks ``_r`` which
    ``ranks`` adds to the slices' table, and the ranks inside them."""
    stats = (ranged.withColumn("_slice", F.spark_partition_id()).groupBy(*by, "_slice")
             .agg(F.min("_x").alias("_lo"), F.max("_x").alias("_hi"), F.sum("_c").alias("_cnt"),
                  *([F.max("_local").alias("_r")] if "_local" in ranged.columns else [])))
    in_group = Window.partitionBy(*by)
    running = in_group.orderBy("_lo").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    found = ranks(stats.withColumn("_end", F.sum("_cnt").over(running)).withColumn("_n", F.sum("_cnt").over(in_group)))
    start = F.col("_end") - F.col("_cnt")
    return found.where((start < F.col("_r")) & (F.col("_r") <= F.col("_end"))) \
        .select(*by, "_p", "_lo", "_hi", (F.col("_r") - start).alias("_local"))


def _in_targets(ranged: DataFrame, targets: DataFrame, by: Sequence[str], bound: int | None) -> DataFrame:
    """``*by, _p, _local, _x, _c``: the rows inside the target slices."""
    if not by:
        listed = targets.agg(F.collect_list(F.struct("_p", "_lo", "_hi", "_local")).alias("t")).scalar()
        inside = F.filter("_all", lambda t: (t["_lo"] <= F.col("_x")) & (F.col("_x") <= t["_hi"]))
        return ranged.withColumn("_all", listed).withColumn("_t", F.explode(inside)).select("_t._p", "_t._local", "_x", "_c")
    # Own names for the small side: it is derived from ``ranged`` itself.
    names = [f"_k{i}" for i in range(len(by))]
    small = targets.select(*[F.col(k).alias(n) for k, n in zip(by, names)], F.col("_p").alias("_q"), "_lo", "_hi",
                           F.col("_local").alias("_rank"))
    if bound is not None:
        small = F.broadcast(small)  # the caller's bound; else AQE decides by the measured size
    inside = (F.col("_x") >= F.col("_lo")) & (F.col("_x") <= F.col("_hi"))
    kept = [k for k in by if k != "_p"]
    return ranged.join(small, _same(by, names) & inside).select(
        *kept, F.col("_q").alias("_p"), F.col("_rank").alias("_local"), "_x", "_c")


def quantiles_of(counts: DataFrame, probs: Sequence[float], by: Sequence[str] = (),
                 group_bound: int | None = None, prob_col: str = "prob", out_col: str = "quantile") -> DataFrame:
    """``exact_quantiles`` of ``value_counts`` that the caller has."""
    by = list(by)
    if not probs:
        raise ValueError("probs must not be empty")
    ranged = counts.where(F.col("_x").isNotNull())
    # In decimals: 0.07 * 100 is 7, not the 7.000000000000001 of doubles.
    rank = F.greatest(F.lit(1), F.ceil(F.col("_p").cast("decimal(17,15)") * F.col("_n")).cast("long"))
    bound = group_bound * len(probs) if group_bound is not None else None
    targets = _targets(ranged, by, lambda stats: stats.withColumn("_p", _probs_column(probs)).withColumn("_r", rank))
    rows = _in_targets(ranged, targets, by, bound)
    keys = [*by, "_p"]
    for _ in range(REFINE):
        again = rows.repartitionByRange(*keys, "_x")
        rows = _in_targets(again, _targets(again, keys, lambda stats: stats), keys, bound if by else len(probs))
    within = Window.partitionBy(*keys).orderBy("_x").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (rows.withColumn("_cum", F.sum("_c").over(within))
            .where((F.col("_cum") - F.col("_c") < F.col("_local")) & (F.col("_local") <= F.col("_cum")))
            .select(*by, F.col("_p").alias(prob_col), F.col("_x").alias(out_col)))


def exact_quantiles(df: DataFrame, value: str, probs: Sequence[float],
                    by: Sequence[str] = (), slices: int | None = None,
                    group_bound: int | None = None, prob_col: str = "prob",
                    out_col: str = "quantile") -> DataFrame:
    """Exact discrete quantiles: one row per group and probability.

    Output columns: ``*by, prob_col, out_col``.  NULL values are ignored;
    groups with only NULL values produce no rows.

    ``group_bound`` is an upper bound on the number of groups that the caller
    knows from its parameters (a code dictionary plus the unknown code, a
    list of periods, a list of variables).  With it the tables of targets, at
    most ``group_bound * len(probs)`` rows, are broadcast and the value rows are
    never re-shuffled by group."""
    if not probs:
        raise ValueError("probs must not be empty")
    return quantiles_of(value_counts(df, value, by, slices), probs, by, group_bound, prob_col, out_col)


def approx_quantiles(df: DataFrame, value: str, probs: Sequence[float],
                     by: Sequence[str] = (), accuracy: int = 10000,
                     prob_col: str = "prob", out_col: str = "quantile") -> DataFrame:
    """``percentile_approx`` per group, long form like ``exact_quantiles``."""
    by = list(by)
    arr = F.percentile_approx(F.col(value), [float(p) for p in probs], accuracy)
    agg = (df.groupBy(*by) if by else df.groupBy()).agg(arr.alias("_qs"))
    zipped = F.arrays_zip(F.array(*[F.lit(float(p)) for p in probs]).alias("p"),
                          F.col("_qs").alias("q"))
    return (agg.select(*by, F.explode(zipped).alias("_z"))
            .select(*by, F.col("_z.p").alias(prob_col), F.col("_z.q").alias(out_col)))


def group_quantiles(df: DataFrame, value: str, probs: Sequence[float],
                    by: Sequence[str] = (), method: str = "exact",
                    accuracy: int = 10000, prob_col: str = "prob",
                    out_col: str = "quantile", group_bound: int | None = None) -> DataFrame:
    if method == "exact":
        return exact_quantiles(df, value, probs, by, group_bound=group_bound,
                               prob_col=prob_col, out_col=out_col)
    if method == "approx":
        return approx_quantiles(df, value, probs, by, accuracy, prob_col=prob_col, out_col=out_col)
    raise ValueError(f"unknown quantile method {method!r}")


def quantiles_wide(df: DataFrame, value: str, probs: Sequence[float], names: Sequence[str],
                   by: Sequence[str] = (), method: str = "exact",
                   accuracy: int = 10000, group_bound: int | None = None) -> DataFrame:
    """One row per group with one column per probability (``names``)."""
    if len(names) != len(probs):
        raise ValueError("one name per probability")
    by = list(by)
    return widened(group_quantiles(df, value, probs, by, method, accuracy, group_bound=group_bound), probs, names, by)


def widened(long: DataFrame, probs: Sequence[float], names: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Long quantiles (``*by, prob, quantile``) to one column per probability."""
    by = list(by)
    cols = [F.max(F.when(F.col("prob") == F.lit(float(p)), F.col("quantile"))).alias(n)
            for p, n in zip(probs, names)]
    return (long.groupBy(*by) if by else long.groupBy()).agg(*cols)
