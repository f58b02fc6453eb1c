"""Ordered eligibility rules and the exclusion funnel."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BASE_STEP = "Base"


@dataclass(frozen=True)
class Rule:
    name: str
    condition: Column


def _strict(c: Column) -> Column:
    # ``filter`` drops rows whose condition is NULL; counting must do the same.
    return F.coalesce(c, F.lit(False))


def all_rules(rules: Sequence[Rule]) -> Column:
    return reduce(lambda a, b: a & b, [_strict(r.condition) for r in rules])


def apply_rules(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Rows meeting every rule.  The plain conjunction (``filter`` already
    drops NULL), so Catalyst splits it into conjuncts and pushes the simple
    comparisons to the Parquet scan."""
    if not rules:
        return df
    return df.where(reduce(lambda a, b: a & b, [r.condition for r in rules]))


def funnel(df: DataFrame, rules: Sequence[Rule], base_name: str = BASE_STEP) -> DataFrame:
    """Rows left and rows excluded after each rule, applied in order.

    One pass: ``count_if(r1 & ... & ri)`` for every prefix in a single global
    aggregate (partial aggregation on every task), then a ``stack`` of the
    one-row result.  Output: ``step_no, step, remaining, excluded``.
    """
    prefixes: list[Column] = []
    acc = None
    for r in rules:
        acc = _strict(r.condition) if acc is None else acc & _strict(r.condition)
        prefixes.append(acc)
    counts = df.agg(
        F.count(F.lit(1)).alias("_n0"),
        *[F.count_if(c).alias(f"_n{i + 1}") for i, c in enumerate(prefixes)],
    )
    names = [base_name] + [r.name for r in rules]
    rows = []
    for i, name in enumerate(names):
        excluded = F.lit(0).cast("bigint") if i == 0 else F.col(f"_n{i - 1}") - F.col(f"_n{i}")
        rows.append(F.struct(F.lit(i).alias("step_no"), F.lit(name).alias("step"),
                             F.col(f"_n{i}").alias("remaining"), excluded.alias("excluded")))
    return counts.select(F.explode(F.array(*rows)).alias("_s")).select("_s.*")
