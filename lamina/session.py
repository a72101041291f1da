"""Session defaults and small session helpers."""

from __future__ import annotations

import tempfile
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
}


def local_session(cores: int | str = "*", **conf: str) -> SparkSession:
    """A local session for tests and benchmarks; on a cluster pass your own session instead."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName("lamina")
    for key, value in {
        **DEFAULTS,
        "spark.sql.shuffle.partitions": "8",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "8g",
        **conf,
    }.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder for files that must outlive a task or a lost executor.

    It lies in the folder the cluster names in ``spark.checkpoint.dir``.  A local session that
    names none (tests) uses a temporary folder; any other raises, as its executors would write
    to disks of their own.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared is None:
        if not spark.conf.get("spark.master", "local").startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        return tempfile.mkdtemp(prefix=f"lamina-{name}-")
    return f"{shared.rstrip('/')}/lamina-{name}-{uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """The same rows from a table written to the shared folder.

    Computed once (an eager checkpoint computes twice), and safe against lost executors.
    """
    spark = df.sparkSession
    at = shared_folder(spark, "step")
    df.write.mode("overwrite").parquet(at)
    return spark.read.schema(df.schema).parquet(at)
