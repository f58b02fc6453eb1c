"""Type harmonisation of period files read as text."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelspark.functions.columns import blank_to_null, clean_code_text, to_double


def harmonise(df: DataFrame, measures: Sequence[str] = (), codes: Sequence[str] = (),
              derived: Mapping[str, Column] | None = None,
              strip_float_suffix: bool = False) -> DataFrame:
    """Measures -> double (unparseable -> NULL), codes -> trimmed text
    (blank -> NULL), then derived columns, all in one projection.

    ``strip_float_suffix`` also turns ``'3.0'`` into ``'3'`` in codes (for
    codes that went through a spreadsheet).
    """
    code_expr = clean_code_text if strip_float_suffix else blank_to_null
    out = df.withColumns({m: to_double(m) for m in measures} | {c: code_expr(c) for c in codes})
    if derived:
        out = out.withColumns(dict(derived))
    return out


def tenure(years: str, months: str) -> Column:
    """years + months / 12; NULL in either gives NULL (never imputed)."""
    return F.col(years) + F.col(months) / F.lit(12.0)
