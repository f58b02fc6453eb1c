"""Data-quality audits: cross-tabs, missing values, repeated keys (A2, A3,
P17, J1, A7, A8)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelspark.functions.columns import fingerprint, is_missing


def crosstab_counts(df: DataFrame, columns: Sequence[str], count_col: str = "n") -> DataFrame:
    """Rows per combination of ``columns`` (NULL is its own value)."""
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias(count_col))


def missing_audit(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Per column: rows that are NULL or blank, and their share of all rows (%).

    One global aggregate (partial counts on every task) stacked to
    ``variable, missing, pct``; ``pct`` is NULL for an empty input.
    """
    counts = df.agg(F.count(F.lit(1)).alias("_total"),
                    *[F.count_if(is_missing(c)).alias(f"_m{i}") for i, c in enumerate(columns)])
    rows = [F.struct(F.lit(c).alias("variable"), F.col(f"_m{i}").alias("missing"),
                     F.try_divide(F.col(f"_m{i}") * F.lit(100.0), F.col("_total")).alias("pct"))
            for i, c in enumerate(columns)]
    return counts.select(F.explode(F.array(*rows)).alias("_r")).select("_r.*")


def duplicate_keys(df: DataFrame, keys: Sequence[str], count_col: str = "n") -> DataFrame:
    """Keys that occur more than once (NULL keys are grouped, like GROUP BY)."""
    return crosstab_counts(df, keys, count_col).where(F.col(count_col) > 1)


def rows_with_repeated_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key occurs more than once (NULL keys included).

    Key counts come from a partial aggregation; the repeated keys then filter
    the rows through a null-safe left-semi join.  Repeated keys are usually
    few, so AQE broadcasts them by their measured size and the rows are
    filtered where they are; otherwise it is a shuffle join whose skewed
    partitions AQE splits.
    """
    dup = duplicate_keys(df, keys)
    renamed = {k: f"_dk{i}" for i, k in enumerate(keys)}
    small = dup.select(*[F.col(k).alias(v) for k, v in renamed.items()])
    cond = None
    for k, v in renamed.items():
        c = F.col(k).eqNullSafe(F.col(v))
        cond = c if cond is None else cond & c
    return df.join(small, cond, "left_semi")


def duplicate_versions(df: DataFrame, keys: Sequence[str],
                       columns: Sequence[str] | None = None) -> DataFrame:
    """For every repeated key: rows and distinct row versions.

    ``versions == 1`` means exact copies; more means conflicting records.
    Only rows of repeated keys are fingerprinted; the distinct count is
    planned as a ``(key, fingerprint)`` pre-aggregation, so a hot key is
    combined on the map side.
    """
    cols = list(columns) if columns is not None else list(df.columns)
    return (rows_with_repeated_keys(df, keys)
            .withColumn("_fp", fingerprint(cols))
            .groupBy(*keys)
            .agg(F.count(F.lit(1)).alias("n"), F.count_distinct("_fp").alias("versions")))


def version_histogram(versions: DataFrame, versions_col: str = "versions") -> DataFrame:
    """How many repeated keys have 1, 2, ... distinct versions."""
    return versions.groupBy(versions_col).agg(F.count(F.lit(1)).alias("keys"))


def row_count_check(df: DataFrame, expected: DataFrame, by: Sequence[str],
                    expected_col: str = "expected_rows") -> DataFrame:
    """Loaded rows per ``by`` against an expected-count table: ``ok`` flag.

    ``expected`` is a small metadata table (one row per source file) and the
    loaded side is an aggregate with one row per file, so the join is small.
    """
    loaded = df.groupBy(*by).agg(F.count(F.lit(1)).alias("rows"))
    return (expected.join(loaded, list(by), "left")
            .withColumn("rows", F.coalesce(F.col("rows"), F.lit(0).cast("bigint")))
            .withColumn("ok", F.col("rows") == F.col(expected_col)))
