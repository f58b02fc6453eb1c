"""The given tables, and written intermediate tables in the cluster's shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from panelspark.session import shared_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """The frame written to the shared folder and read back: later jobs neither
    recompute it nor depend on an executor that may be lost."""
    path = shared_dir(df.sparkSession, "llm", name, unique=True)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
