"""Scans of wide period files by column *name*.

Files may hold hundreds of columns in any order; only the mapped columns are
read (column pruning reaches the Parquet/CSV scan), and they are matched by
header name, never by position.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelspark.sources.manifest import Listing
from panelspark.operators.union import union_periods

# CSV options for files written by spreadsheet tools: a quote inside a
# quoted field is doubled, not backslash-escaped.
CSV_OPTIONS = {"header": "true", "escape": '"', "mode": "FAILFAST"}


def require_columns(df: DataFrame, names: Sequence[str], source: str = "") -> None:
    """Fail before any action when required source columns are absent."""
    missing = sorted(set(names) - set(df.columns))
    if missing:
        where = f"{source}: " if source else ""
        raise KeyError(f"{where}missing required columns {missing}")


def select_by_name(df: DataFrame, column_map: Mapping[str, str], source: str = "") -> DataFrame:
    """``analytic name -> source name``; checks, then selects and renames."""
    require_columns(df, list(column_map.values()), source)
    return df.select(*[F.col(f"`{src}`").alias(dst) for dst, src in column_map.items()])


def _reader(spark: SparkSession, fmt: str, options: Mapping[str, str] | None):
    reader = spark.read.format(fmt)
    opts = dict(CSV_OPTIONS) if fmt == "csv" else {}
    opts.update(options or {})
    for k, v in opts.items():
        reader = reader.option(k, v)
    return reader


def source_header(spark: SparkSession, path: str, fmt: str = "csv",
                  options: Mapping[str, str] | None = None) -> list[str]:
    """The column names as the source itself lists them, in its order, repeated
    ones included.  Of delimited text only the first line is read (one small job)."""
    if fmt != "csv":
        return _reader(spark, fmt, options).load(path).columns
    first = _reader(spark, fmt, options).option("header", "false").load(path).first()
    return [] if first is None else ["" if name is None else name for name in first]


def first_of_repeated(header: Sequence[str]) -> list[str]:
    """Names under which a header's columns are read: the first of a repeated
    name (as Spark compares names, without case) keeps it, later ones get their
    position, and so does a blank name."""
    seen: set[str] = set()
    names = []
    for position, name in enumerate(header):
        taken = not name.strip() or name.lower() in seen
        names.append(f"{name}#{position}" if taken else name)
        seen.add(name.lower())
    return names


def read_table(spark: SparkSession, path: str, fmt: str = "parquet",
               options: Mapping[str, str] | None = None) -> DataFrame:
    """Header-driven read.  CSV columns are all text (no inference); the
    header gives the names, so a file with its columns in another order
    still maps correctly.  Where a header repeats a name, the first column
    has it."""
    reader = _reader(spark, fmt, options)
    if fmt == "csv":
        header = source_header(spark, path, fmt, options)
        names = first_of_repeated(header)
        if names != header:
            reader = reader.schema(T.StructType([T.StructField(n, T.StringType()) for n in names]))
    return reader.load(path)


def scan_by_name(spark: SparkSession, path: str, column_map: Mapping[str, str],
                 fmt: str = "parquet", options: Mapping[str, str] | None = None) -> DataFrame:
    return select_by_name(read_table(spark, path, fmt, options), column_map, path)


def scan_periods(spark: SparkSession, landing_dir: str, files: Sequence[Listing],
                 column_map: Mapping[str, str], fmt: str = "csv",
                 options: Mapping[str, str] | None = None) -> DataFrame:
    """Every manifest file scanned by name, with provenance, stacked by name."""
    frames = {f.period: scan_by_name(spark, f"{landing_dir.rstrip('/')}/{f.file_name}",
                                     column_map, fmt, options) for f in files}
    return union_periods(frames, {f.period: f.provenance() for f in files})


def column_counts(spark: SparkSession, landing_dir: str, files: Sequence[Listing], fmt: str = "csv",
                  options: Mapping[str, str] | None = None) -> DataFrame:
    """``period, columns, distinct_columns`` of every manifest file, from its own
    header, before any projection (one small job a file; the manifest bounds them)."""
    rows = []
    for f in files:
        header = source_header(spark, f"{landing_dir.rstrip('/')}/{f.file_name}", fmt, options)
        rows.append((f.period, len(header), len({name.lower() for name in header})))
    return spark.createDataFrame(rows, "period string, columns int, distinct_columns int")
