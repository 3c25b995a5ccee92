"""A fresh folder for queries that write layers before they read them, and the room that finished steps took."""

from __future__ import annotations

import gc
import tempfile
import uuid

from pyspark.sql import SparkSession


def new_scratch(spark: SparkSession) -> str:
    """A new folder on the storage all executors share, or a local one in local mode only."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return f"{shared.rstrip('/')}/sedimenta-{uuid.uuid4().hex}"
    if not spark.conf.get("spark.master", "local").startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    return tempfile.mkdtemp(prefix="run-")


def release_shuffles(spark: SparkSession) -> None:
    """Give up shuffle files that nothing refers to any more.

    Those of finished stages stay on the executors' disks until the driver happens to collect its garbage, which a driver with
    much memory does rarely, so it is asked to. The last query is held by the event of its end until another one ends.
    """
    spark.sql("SELECT 1").collect()
    gc.collect()
    spark.sparkContext._jvm.System.gc()
