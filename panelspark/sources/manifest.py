"""Period-file manifest, missing-file check and row audit."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_TYPES = {bool: "boolean", int: "int", float: "double", str: "string"}


class Listing(NamedTuple):
    """A file that is expected to land: its name, what holds for all its rows (any
    attributes; ``period`` names it in audits) and how many rows it should have
    (``None``: not known)."""
    file_name: str
    attributes: Mapping[str, object]
    rows: int | None = None

    @property
    def period(self) -> str:
        return str(self.attributes["period"])

    def provenance(self) -> dict[str, object]:
        return {"source_file": self.file_name, **self.attributes}


def manifest_frame(spark: SparkSession, files: Sequence[Listing]) -> DataFrame:
    """The manifest as a small DataFrame, one row a file: ``file_name``,
    ``expected_rows``, ``period``, then every other attribute that some file has
    (NULL where a file lacks it; typed by its first value that is not None)."""
    names = list(dict.fromkeys(["period", *(name for f in files for name in f.attributes)]))
    kinds = {name: next((_TYPES[type(f.attributes[name])] for f in files if f.attributes.get(name) is not None), "string")
             for name in names}
    schema = ", ".join(["file_name string", "expected_rows long", *(f"`{name}` {kind}" for name, kind in kinds.items())])
    return spark.createDataFrame([(f.file_name, f.rows, *map(f.attributes.get, names)) for f in files], schema)


def partition_attributes(manifest: DataFrame) -> list[str]:
    """The columns of a manifest that hold for all rows of a file."""
    return [c for c in manifest.columns if c not in ("file_name", "expected_rows")]


def file_listing(spark: SparkSession, pattern: str) -> DataFrame:
    """``file_name, path, length`` of the files matching ``pattern``.

    ``binaryFile`` with only path/length selected: the content column is
    pruned, so the listing reads no file bodies."""
    return (spark.read.format("binaryFile").load(pattern)
            .select("path", "length")
            .withColumn("file_name", F.element_at(F.split("path", "/"), -1)))


def missing_files(manifest: DataFrame, listing: DataFrame) -> DataFrame:
    """Manifest rows whose file is absent from the landing listing."""
    return manifest.join(listing.select("file_name"), "file_name", "left_anti")


def require_no_missing(missing: DataFrame) -> None:
    """Fail early, naming every absent file (one small action)."""
    names = sorted(r["file_name"] for r in missing.select("file_name").collect())
    if names:
        raise FileNotFoundError("missing input files: " + ", ".join(names))


#: What an audit row says of its period.
MATCHED, DIFFERS, MISSING, UNLISTED, UNCHECKED = "matched", "differs", "missing", "unlisted", "unchecked"


def row_audit(loaded: DataFrame, manifest: DataFrame, column_counts: DataFrame | None = None,
              period_col: str = "period") -> DataFrame:
    """Full accounting of loaded rows and manifest: one row for every period of
    either side, the NULL period included, so no loaded row goes uncounted.

    Output: ``period, file_name, expected_rows, rows, status, ok`` (+ ``columns``
    when a per-file column-count table is given).  ``status``: ``matched``,
    ``differs``, ``missing`` (listed, no row loaded), ``unlisted`` (loaded, not in
    the manifest), ``unchecked`` (listed without a count); ``ok`` is ``matched``.
    Rows are counted before the null-safe outer join of two small tables."""
    rows = loaded.groupBy(F.col(period_col).cast("string").alias("_loaded")).agg(F.count(F.lit(1)).alias("_rows"))
    listed = manifest.select(F.col(period_col).alias("_listed"), "file_name", "expected_rows", F.lit(True).alias("_in"))
    both = listed.join(rows, F.col("_listed").eqNullSafe(F.col("_loaded")), "full_outer")
    count = F.coalesce("_rows", F.lit(0))
    status = (F.when(F.col("_in").isNull(), F.lit(UNLISTED)).when(F.col("expected_rows").isNull(), F.lit(UNCHECKED))
              .when(count == F.col("expected_rows"), F.lit(MATCHED)).when(count == 0, F.lit(MISSING)).otherwise(F.lit(DIFFERS)))
    audit = both.select(F.coalesce("_listed", "_loaded").alias(period_col), "file_name", "expected_rows",
                        count.alias("rows"), status.alias("status")).withColumn("ok", F.col("status") == MATCHED)
    if column_counts is not None:
        audit = audit.join(column_counts, period_col, "left")
    return audit


def assert_row_counts(audit: DataFrame) -> None:
    """Raise when a period's loaded rows differ from the manifest."""
    bad = audit.where(~F.coalesce(F.col("ok"), F.lit(False))).collect()
    if bad:
        raise ValueError("row counts differ from the manifest: " +
                         "; ".join(f"{r['period']}: expected {r['expected_rows']}, read {r['rows']}"
                                   for r in bad))
