"""Parquet datasets and model persistence."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def write_parquet(df: DataFrame, path: str, partition_by: Sequence[str] = (),
                  mode: str = "overwrite") -> None:
    """Write a dataset; ``partition_by`` (e.g. role or period) gives directory
    partitions that later reads prune (the development/holdout separation)."""
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def write_parquet_counted(df: DataFrame, path: str, partition_by: Sequence[str] = (),
                          expected_rows: int | None = None, mode: str = "overwrite") -> int:
    """Write and count the rows in the same job (``DataFrame.observe``: the
    count is a metric of the write, not a second pass).  Raises when
    ``expected_rows`` is given and differs."""
    obs = Observation("rows_written")
    write_parquet(df.observe(obs, F.count(F.lit(1)).alias("rows")), path, partition_by, mode)
    rows = int(obs.get["rows"])
    if expected_rows is not None and rows != expected_rows:
        raise ValueError(f"{path}: expected {expected_rows} rows, wrote {rows}")
    return rows


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Delimited text with a header, quotes doubled (as ``scan.read_table`` reads it)."""
    df.write.mode(mode).option("header", "true").option("escape", '"').csv(path)


def dataset_exists(spark: SparkSession, path: str) -> bool:
    """True when ``path`` holds a completed write (``_SUCCESS`` marker)."""
    jvm = spark.sparkContext._jvm
    hadoop_path = jvm.org.apache.hadoop.fs.Path(path.rstrip("/") + "/_SUCCESS")
    fs = hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(hadoop_path))


def read_or_build(spark: SparkSession, path: str, builder: Callable[[], DataFrame],
                  partition_by: Sequence[str] = ()) -> DataFrame:
    """Read the dataset at ``path``; build and write it first when absent."""
    if not dataset_exists(spark, path):
        write_parquet(builder(), path, partition_by)
    return spark.read.parquet(path)


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
