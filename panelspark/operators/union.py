"""Stacking period files by column name, with provenance."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def with_provenance(df: DataFrame, provenance: Mapping[str, object]) -> DataFrame:
    """Literal lineage columns (file name, period, ...): the period
    comes from the file, never from the data's own fields."""
    return df.withColumns({k: F.lit(v) for k, v in provenance.items()})


def union_by_name(frames: Sequence[DataFrame], allow_missing: bool = False) -> DataFrame:
    """Bag union matched by column *name* (positions drift between files).

    Strict by default: a column missing from one file is an error unless
    ``allow_missing`` (then it is NULL there).  A plain ``Union`` of scans:
    no shuffle."""
    if not frames:
        raise ValueError("nothing to union")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=allow_missing), frames)


def union_periods(frames: Mapping[str, DataFrame], provenance: Mapping[str, Mapping[str, object]],
                  columns: Sequence[str] | None = None) -> DataFrame:
    """``period -> frame`` plus ``period -> provenance`` into one frame.

    ``columns`` (optional) selects the shared analytic columns by name first,
    so extra columns in one file do not break the union."""
    parts = []
    for period, frame in frames.items():
        f = frame.select(*columns) if columns is not None else frame
        parts.append(with_provenance(f, provenance[period]))
    return union_by_name(parts)
