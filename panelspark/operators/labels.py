"""Code dictionaries -> (code, label) columns."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame

from panelspark.functions.columns import UNKNOWN_CODE, UNKNOWN_LABEL, labelled_code


def label_codes(df: DataFrame, dictionaries: Mapping[str, Mapping[str, str]],
                label_suffix: str = "_label", unknown_code: str = UNKNOWN_CODE,
                unknown_label: str = UNKNOWN_LABEL) -> DataFrame:
    """For each ``column -> {code: label}``: codes outside the dictionary (or
    NULL) become ``unknown_code`` and get ``unknown_label``; adds
    ``<column><label_suffix>``.  Small dictionaries become a map literal in
    the projection (no join)."""
    cols = {}
    for column, labels in dictionaries.items():
        code, label = labelled_code(column, labels, unknown_code, unknown_label)
        cols[column] = code
        cols[f"{column}{label_suffix}"] = label
    return df.withColumns(cols)
