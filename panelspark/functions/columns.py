"""Column expressions shared by the operators.

All of them are built-in Spark SQL expressions, so they stay inside
whole-stage codegen; none is a Python UDF.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnLike = Column | str

# --- fixed values ---------------------------------------------------------
# Sentinels for a code that is missing or outside its dictionary, and the
# separator / NULL marker of the row fingerprint.  These are the values the
# labelled tables and audits must carry.
UNKNOWN_CODE = "DESCONOCIDO"
UNKNOWN_LABEL = "Desconocido"
FINGERPRINT_SEPARATOR = "§"
FINGERPRINT_NULL = "<NULL>"
# ---------------------------------------------------------------------------


def col(c: ColumnLike) -> Column:
    return F.col(c) if isinstance(c, str) else c


#: Every character of the basic plane that Unicode counts as white space.
WHITE_SPACE = "".join(c for c in map(chr, range(0x10000)) if c.isspace())


def is_finite(c: ColumnLike) -> Column:
    """not NULL, not NaN and not +/- infinity (false for NULL).

    Written with a single reference to ``c``: NaN sorts above +infinity in
    Spark, so ``abs(c) < inf`` is false for NaN and both infinities.  When
    ``c`` is a derived expression, Catalyst inlines it wherever it is
    referenced, so one reference keeps predicates small.
    """
    return F.coalesce(F.abs(col(c)) < F.lit(float("inf")), F.lit(False))


def is_integer_between(c: ColumnLike, lo: int, hi: int) -> Column:
    """Finite, integer-valued and in ``[lo, hi]`` (false for NULL / NaN / inf).

    NaN compares as the largest value, so the upper bound alone excludes it.
    """
    v = col(c)
    return F.coalesce(v.between(lo, hi) & (v == F.floor(v)), F.lit(False))


def blank_to_null(c: ColumnLike) -> Column:
    """Text without white space at its ends (tabs, line ends and Unicode spaces such
    as the no-break space too), with the empty string turned into NULL."""
    return F.nullif(F.btrim(col(c), F.lit(WHITE_SPACE)), F.lit(""))


def clean_code_text(c: ColumnLike) -> Column:
    """Normalise a code read as text: trim, blank -> NULL, ``'3.0'`` -> ``'3'``.

    Spreadsheet exports write integer codes as floats; the trailing ``.0``
    is dropped so that ``3`` and ``3.0`` are the same code.
    """
    trimmed = blank_to_null(c)
    return F.regexp_replace(trimmed, r"^(-?[0-9]+)\.0+$", "$1")


def to_double(c: ColumnLike) -> Column:
    """Text -> double; unparseable text becomes NULL (ANSI-safe ``try_cast``)."""
    return col(c).try_cast("double")


def is_missing(c: ColumnLike) -> Column:
    """NULL or blank once rendered as text (the missing-value audit rule)."""
    v = col(c)
    return v.isNull() | (F.trim(v.cast("string")) == F.lit(""))


def map_literal(mapping: Mapping[str, str]) -> Column:
    """A constant dictionary column, from the arrays of its keys and of its values."""
    keys, values = (F.array(*map(F.lit, side)).cast("array<string>") for side in (mapping.keys(), mapping.values()))
    return F.map_from_arrays(keys, values)


def labelled_code(c: ColumnLike, labels: Mapping[str, str],
                  unknown_code: str = UNKNOWN_CODE,
                  unknown_label: str = UNKNOWN_LABEL) -> tuple[Column, Column]:
    """(code, label): codes outside ``labels`` (or NULL) become the unknown pair.

    Both come from one dictionary lookup of a ``(code, label)`` struct."""
    entries = [F.struct(F.lit(k).alias("code"), F.lit(text).alias("label")) for k, text in labels.items()]
    unknown = F.struct(F.lit(unknown_code).alias("code"), F.lit(unknown_label).alias("label"))
    if not entries:
        return unknown["code"], unknown["label"]
    dictionary = F.map_from_arrays(F.array(*map(F.lit, labels)), F.array(*entries))
    found = F.coalesce(F.try_element_at(dictionary, col(c)), unknown)
    return found["code"], found["label"]


def fingerprint(columns: Iterable[ColumnLike], length_prefix: bool = True) -> Column:
    """SHA-256 of a row's values in a fixed column order.

    With ``length_prefix`` each value is written as ``<chars>:<value>``, so a
    value that itself contains the separator cannot make two different rows
    collide; NULL is written as the NULL marker.
    """
    parts = []
    for c in columns:
        text = col(c).cast("string")
        if length_prefix:
            text = F.concat(F.length(text).cast("string"), F.lit(":"), text)
        parts.append(F.coalesce(text, F.lit(FINGERPRINT_NULL)))
    return F.sha2(F.concat_ws(FINGERPRINT_SEPARATOR, *parts), 256)


def hash_text(columns: Iterable[ColumnLike], salt: str = "") -> Column:
    """Deterministic text used for hash ordering and hash splits."""
    parts = [col(c).cast("string") for c in columns]
    if salt:
        parts.append(F.lit(salt))
    return F.concat_ws("|", *parts)


def hash_percent(columns: Iterable[ColumnLike], salt: str = "") -> Column:
    """0..99 from the first 28 bits of md5; independent of partitioning.

    The same number is ``('0x' || substr(md5(s), 1, 7))::BIGINT % 100`` in
    DuckDB, which the split oracle uses.
    """
    digest = F.md5(hash_text(columns, salt))
    return F.conv(F.substring(digest, 1, 7), 16, 10).cast("bigint") % F.lit(100)


def value_band(c: ColumnLike, edges: list[Column | float], labels: list[str]) -> Column:
    """``when(c <= e1, l1).when(c <= e2, l2)...otherwise(last label)``."""
    if len(labels) != len(edges) + 1:
        raise ValueError("need one more label than edges")
    v = col(c)
    expr = None
    for edge, label in zip(edges, labels):
        e = edge if isinstance(edge, Column) else F.lit(edge)
        expr = F.when(v <= e, F.lit(label)) if expr is None else expr.when(v <= e, F.lit(label))
    return expr.otherwise(F.lit(labels[-1]))
