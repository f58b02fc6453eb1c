"""Descriptive statistics and chart data."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelspark.functions.columns import hash_text, is_finite
from panelspark.operators.quantiles import moments, quantiles_of, quantiles_wide, value_counts, widened

SUMMARY_PROBS = (0.25, 0.5, 0.75, 0.95)
SUMMARY_NAMES = ("p25", "median", "p75", "p95")


def _stack(df: DataFrame, columns: Sequence[str], name_col: str, value_col: str,
           keep: Sequence[str] = ()) -> DataFrame:
    """Wide -> long (``unpivot``); a narrow projection, no shuffle."""
    return df.unpivot(list(keep), list(columns), name_col, value_col)


def numeric_summary(df: DataFrame, columns: Sequence[str], method: str = "exact",
                    accuracy: int = 10000) -> DataFrame:
    """Per variable: n, mean, sample stddev, min, max and p25/median/p75/p95.

    The columns are stacked and counted by (variable, value) once; moments and
    quantiles both read those counts, so the source is scanned once.  A variable
    without values (of an empty input too) has ``n`` 0 and NULLs.
    """
    cols = list(columns)
    stacked = _stack(df.select(*[F.col(c).cast("double") for c in cols]), cols, "variable", "value")
    out = ["variable", "n", "mean", "median", "stddev", "min", "p25", "p75", "p95", "max"]
    if method == "exact":
        counts = value_counts(stacked, "value", ["variable"])
        parts = moments(counts, ["variable"])
        qs = widened(quantiles_of(counts, SUMMARY_PROBS, ["variable"], len(cols)), SUMMARY_PROBS, SUMMARY_NAMES, ["variable"])
    else:
        parts = stacked.groupBy("variable").agg(F.count("value").alias("n"), F.avg("value").alias("mean"), F.stddev_samp("value").alias("stddev"),
                                                F.min("value").alias("min"), F.max("value").alias("max"))
        qs = quantiles_wide(stacked, "value", SUMMARY_PROBS, SUMMARY_NAMES, by=["variable"], method=method, accuracy=accuracy)
    named = df.sparkSession.createDataFrame([(c,) for c in cols], "variable string")
    return combine_by_key([named, parts, qs], ["variable"]).withColumn("n", F.coalesce("n", F.lit(0))).select(*out)


def combine_by_key(frames: Sequence[DataFrame], by: Sequence[str]) -> DataFrame:
    """Per-group pieces computed from one source (one row per group each,
    disjoint value columns) put side by side: stacked with ``unionByName``
    and collapsed with one aggregate.  Unlike a join of two plans over the
    same source, a union needs no attribute renaming, so exchanges shared by
    the pieces stay reusable; NULL groups collapse together as in GROUP BY."""
    by = list(by)
    stacked = frames[0]
    for f in frames[1:]:
        stacked = stacked.unionByName(f, allowMissingColumns=True)
    values = [c for c in stacked.columns if c not in by]
    grouped = stacked.groupBy(*by) if by else stacked.groupBy()
    return grouped.agg(*[F.max(c).alias(c) for c in values])


def group_median(df: DataFrame, value: str, by: Sequence[str], method: str = "exact",
                 accuracy: int = 10000, group_bound: int | None = None,
                 median_col: str = "median") -> DataFrame:
    """Rows and median of ``value`` per group, highest median first."""
    by = list(by)
    if method == "exact":  # rows and medians from the same counts: the source runs once
        shared = value_counts(df, value, by)
        counts = shared.groupBy(*by).agg(F.sum("_c").alias("n"))
        med = widened(quantiles_of(shared, [0.5], by, group_bound), [0.5], [median_col], by)
    else:
        counts = df.groupBy(*by).agg(F.count(F.lit(1)).alias("n"))
        med = quantiles_wide(df, value, [0.5], [median_col], by=by, method=method, accuracy=accuracy)
    out = combine_by_key([counts, med], by).select(*by, "n", median_col)
    return out.orderBy(F.desc_nulls_last(median_col), *by)


def category_frequency(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows per value of each categorical column: ``variable, value, n``.

    The columns are stacked (narrow) and counted in one aggregation."""
    cols = list(columns)
    stacked = _stack(df.select(*[F.col(c).cast("string") for c in cols]), cols, "variable", "value")
    return stacked.groupBy("variable", "value").agg(F.count(F.lit(1)).alias("n"))


def histogram(df: DataFrame, value: str, bins: int = 60, log10: bool = False) -> DataFrame:
    """Equal-width histogram over all rows: ``bin, lo, hi, n`` (non-empty bins).

    The bins span the finite values.  Rows without one (NULL, NaN, infinite; on
    the log scale also values that are not positive) are counted in a last row
    whose bin and limits are NULL, so ``n`` adds up to all rows.  The range
    comes from two scalar subqueries (one global aggregate that Spark runs once
    and inlines), so nothing is collected and no join is made.
    ``bin = least(floor((x - lo) * bins / (hi - lo)), bins - 1)``.
    """
    x = F.log10(F.col(value)) if log10 else F.col(value).cast("double")
    base = df.select(F.when(is_finite(x), x).alias("_x"))
    stats = base.agg(F.min("_x").alias("lo"), F.max("_x").alias("hi"))
    lo = stats.select("lo").scalar()
    hi = stats.select("hi").scalar()
    width = hi - lo
    idx = F.when(F.col("_x").isNull(), F.lit(None)).when(width == 0, F.lit(0)).otherwise(
        F.least(F.floor((F.col("_x") - lo) * F.lit(bins) / width), F.lit(bins - 1))).cast("int")
    counted = base.withColumn("bin", idx).groupBy("bin").agg(F.count(F.lit(1)).alias("n"))
    return counted.select(
        "bin",
        (lo + F.col("bin") * width / F.lit(bins)).alias("lo"),
        (lo + (F.col("bin") + 1) * width / F.lit(bins)).alias("hi"),
        "n")


def correlation_long(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pearson r for every ordered pair: ``var_x, var_y, r``.

    One global aggregate; every moment of a pair is over the rows where both
    are present.  r is NULL when either column has zero variance there
    (guarded division instead of an ANSI divide-by-zero).
    """
    cols = list(columns)
    aggs = []
    for i, a in enumerate(cols):
        for j, b in enumerate(cols):
            if j < i:
                continue
            x, y = (F.when(F.col(a).isNotNull() & F.col(b).isNotNull(), F.col(c)) for c in (a, b))
            aggs += [F.covar_samp(a, b).alias(f"_c{i}_{j}"), (F.stddev_samp(x) * F.stddev_samp(y)).alias(f"_s{i}_{j}")]
    moments = df.agg(*aggs)
    rows = []
    for i, a in enumerate(cols):
        for j, b in enumerate(cols):
            lo_, hi_ = min(i, j), max(i, j)
            spread = F.col(f"_s{lo_}_{hi_}")
            r = F.when(spread != 0, F.try_divide(F.col(f"_c{lo_}_{hi_}"), spread))
            rows.append(F.struct(F.lit(a).alias("var_x"), F.lit(b).alias("var_y"),
                                 r.cast("double").alias("r")))
    return moments.select(F.explode(F.array(*rows)).alias("_r")).select("_r.*")


def top_association(corr: DataFrame, target: str, top: int = 1) -> DataFrame:
    """Variables most linearly associated with ``target`` (|r| desc, name asc)."""
    return (corr.where((F.col("var_x") == target) & (F.col("var_y") != target))
            .select(F.col("var_y").alias("variable"), "r", F.abs("r").alias("abs_r"))
            .orderBy(F.desc_nulls_last("abs_r"), "variable")
            .limit(top))


#: Hex digits of the hash that the histogram of a seeded sample counts by.
SAMPLE_DIGITS = 5


def seeded_sample(df: DataFrame, n: int, key: Sequence[str], salt: str = "42",
                  columns: Sequence[str] | None = None) -> DataFrame:
    """At most ``n`` rows chosen by the md5 of ``key||salt``: those with the
    smallest hashes, in that order.

    A hash order instead of ``orderBy(rand(seed))``: the same rows for any
    partitioning and in any engine.  Rows are first counted by the leading
    digits of their hash (at most ``16 ** SAMPLE_DIGITS`` counts), the running
    sum of which gives the last leading part that the sample reaches.  Only
    rows up to there, ``n`` and those of one such part, are then ordered, so
    the merge does not grow with tasks or rows.  The key, then the other
    output columns, break ties, so even rows sharing a key are chosen
    deterministically (rows equal in every output column are interchangeable).
    """
    key = list(key)
    cols = list(columns) if columns is not None else df.columns
    hashed = F.md5(hash_text(key, salt))
    head = F.substring(hashed, 1, SAMPLE_DIGITS)
    parts = df.groupBy(head.alias("_head")).agg(F.count(F.lit(1)).alias("_n"))
    reached = F.sum("_n").over(Window.orderBy("_head").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    last = parts.withColumn("_sum", reached).where(F.col("_sum") >= n).agg(F.min("_head")).scalar()
    near = df.where(head <= F.coalesce(last, F.lit("g"))).withColumn("_h", hashed)
    ties = key + [c for c in cols if c not in key]
    return near.orderBy("_h", *ties).limit(n).select(*cols)


def group_mode(df: DataFrame, by: Sequence[str], column: str, out_col: str | None = None) -> DataFrame:
    """Most frequent value of ``column`` per group; ties -> smallest value.

    Count per (group, value), then ``min(struct(-count, value))`` per group:
    both steps are aggregations with map-side combine, so a hot group is never
    sorted in one task (this is the deterministic row_number()==1 mode).
    NULL values are not candidates.
    """
    by = list(by)
    out = out_col or f"{column}_mode"
    counted = (df.where(F.col(column).isNotNull())
               .groupBy(*by, column).agg(F.count(F.lit(1)).alias("_c")))
    best = counted.groupBy(*by).agg(
        F.min(F.struct((-F.col("_c")).alias("neg"), F.col(column).alias("v"))).alias("_b"))
    return best.select(*by, F.col("_b.v").alias(out))


def group_modes(df: DataFrame, by: Sequence[str], columns: dict[str, str]) -> DataFrame:
    """Modes of several columns per group in one pass: ``column -> output
    name``.  The columns are stacked (narrow), counted per (group, column,
    value), reduced with ``min(struct(-count, value))`` per (group, column)
    and turned wide with a conditional aggregate over the small result."""
    by = list(by)
    cols = list(columns)
    stacked = (df.select(*by, *[F.col(c).cast("string").alias(c) for c in cols])
               .unpivot(by, cols, "_var", "_val").where(F.col("_val").isNotNull()))
    counted = stacked.groupBy(*by, "_var", "_val").agg(F.count(F.lit(1)).alias("_c"))
    best = counted.groupBy(*by, "_var").agg(
        F.min(F.struct((-F.col("_c")).alias("neg"), F.col("_val").alias("v"))).alias("_b"))
    return best.groupBy(*by).agg(*[
        F.max(F.when(F.col("_var") == c, F.col("_b.v"))).alias(out) for c, out in columns.items()])
