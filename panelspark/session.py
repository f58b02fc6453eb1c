"""Session helpers.

``get_session`` is for tests and scripts; library functions take the caller's
session and never change global settings.  ``shared_dir`` returns the shared
folder that the cluster names in ``spark.checkpoint.dir``; only when that is
unset (local runs, tests) does it create one and register it.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession


def get_session(master: str = "local[*]", shuffle_partitions: int = 8,
                app_name: str = "panelspark") -> SparkSession:
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("PANELSPARK_DRIVER_MEMORY", "8g"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    shared_dir(spark)
    return spark


def _checkpoint_root(spark: SparkSession) -> str:
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if conf_dir:
        return conf_dir
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    # Unset: only a local run or a test may use a folder of this machine.
    if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
        raise RuntimeError("spark.checkpoint.dir must name a folder that all nodes share")
    local = tempfile.mkdtemp(prefix="panelspark-ckpt-")
    spark.sparkContext.setCheckpointDir(local)
    return spark.sparkContext.getCheckpointDir() or local


def shared_dir(spark: SparkSession, *parts: str, unique: bool = False) -> str:
    """Path under the shared checkpoint folder (``unique`` appends a fresh id)."""
    root = _checkpoint_root(spark).rstrip("/")
    pieces = [root, "panelspark", *parts]
    if unique:
        pieces.append(uuid.uuid4().hex)
    return "/".join(pieces)
