"""Column-expression helpers (built-in Spark SQL functions only)."""

from panelspark.functions.columns import (
    FINGERPRINT_NULL,
    FINGERPRINT_SEPARATOR,
    UNKNOWN_CODE,
    UNKNOWN_LABEL,
    blank_to_null,
    clean_code_text,
    fingerprint,
    hash_percent,
    hash_text,
    is_finite,
    is_integer_between,
    is_missing,
    labelled_code,
    map_literal,
    to_double,
    value_band,
)

__all__ = [
    "FINGERPRINT_NULL", "FINGERPRINT_SEPARATOR", "UNKNOWN_CODE", "UNKNOWN_LABEL",
    "blank_to_null", "clean_code_text", "fingerprint", "hash_percent", "hash_text",
    "is_finite", "is_integer_between", "is_missing", "labelled_code", "map_literal", "to_double", "value_band",
]
