"""Intermediate tables in the folder all executors share."""

from __future__ import annotations

import tempfile
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

_local_folders: dict[str, str] = {}


def shared_folder(spark: SparkSession, label: str) -> str:
    """A new folder under `spark.checkpoint.dir`.

    Only a single-machine session may go without the setting; it gets a
    temporary folder. On a cluster such a folder would differ per machine.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        app = spark.sparkContext.applicationId
        if app not in _local_folders:
            _local_folders[app] = tempfile.mkdtemp(prefix="tickerloom-")
        base = _local_folders[app]
    return f"{base.rstrip('/')}/{label}-{uuid4().hex}"


def materialise(df: DataFrame, folder: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write `df` as parquet and read it back: cut lineage that outlives executors.

    Unlike a checkpoint the copy is columnar, so readers still prune and push down.
    """
    writer = df.write.mode("errorifexists")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)
