"""Incremental ingestion of period files with Structured Streaming.

The batch path (``sources.scan.scan_periods``) reads every file of the
manifest at once.  When period files keep landing (one per quarter), the same
work runs as a file-source stream: Parquet resolves columns by *name*, so files
with their columns in another order read correctly; provenance comes from
each row's source file joined to the (small) manifest; rows are
harmonised and appended to the typed dataset partitioned by period.  The
checkpoint (in the shared folder) records which files were done, so each file
is ingested exactly once; ``trigger(availableNow=True)`` processes what has
landed and stops.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from panelspark.operators.harmonise import harmonise
from panelspark.sources.manifest import partition_attributes


def source_schema(column_map: Mapping[str, str]) -> T.StructType:
    """Text schema of the source columns that are read (all others pruned)."""
    return T.StructType([T.StructField(src, T.StringType(), True) for src in column_map.values()])


def period_stream(spark: SparkSession, landing_dir: str, column_map: Mapping[str, str],
                  manifest: DataFrame, measures: Sequence[str] = (), codes: Sequence[str] = (),
                  schema: T.StructType | None = None, source_col: str | None = None,
                  max_files_per_trigger: int | None = None,
                  max_bytes_per_trigger: int | None = None) -> DataFrame:
    """Streaming frame of harmonised rows with provenance.

    ``schema`` is the source schema (default: the mapped columns as text).
    The manifest's ``file_name`` is matched to each row's file name, or to
    ``source_col`` when the landing folder is partitioned by file (a
    ``source_col=<file>`` directory per period).  Rows of files that are not
    in the manifest stay, with NULL attributes, so that
    ``sources.manifest.row_audit`` counts them as unlisted;
    ``sources.manifest.missing_files`` audits the reverse.  The manifest is
    broadcast (it has a row a file; its size is not measured within a stream, and a
    shuffled join would send all rows of a file to one task).  ``max_files_per_trigger`` or
    ``max_bytes_per_trigger`` (one of them) bounds what one micro-batch reads, and
    so what its tasks sort before they write; a batch has one file at least.
    """
    reader = spark.readStream.schema(schema or source_schema(column_map))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    if max_bytes_per_trigger:
        reader = reader.option("maxBytesPerTrigger", str(max_bytes_per_trigger))
    raw = reader.parquet(landing_dir)
    origin = F.col(source_col) if source_col else F.col("_metadata.file_name")
    named = raw.select(*[F.col(f"`{src}`").alias(dst) for dst, src in column_map.items()],
                       origin.alias("source_file"))
    prov = manifest.select(F.col("file_name").alias("source_file"), *partition_attributes(manifest))
    return harmonise(named.join(F.broadcast(prov), "source_file", "left"), measures=measures, codes=codes)


def ingest_available(stream: DataFrame, out_path: str, checkpoint: str,
                     partition_by: Sequence[str] = ("period",)) -> StreamingQuery:
    """Append everything that has landed to the Parquet dataset, then stop."""
    query = (stream.writeStream.format("parquet").outputMode("append")
             .option("checkpointLocation", checkpoint)
             .partitionBy(*partition_by)
             .trigger(availableNow=True)
             .start(out_path))
    query.awaitTermination()
    return query
