"""Session and folders for tests, bench and acceptance queries."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import SparkSession


def local_session(cpus: int | str = 8, name: str = "pagetables") -> SparkSession:
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(name)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", os.environ.get("SPARK_DRIVER_MEMORY", "12g"))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.adaptive.enabled", "true")
        .getOrCreate()
    )


def work_dir(spark: SparkSession) -> str:
    """A new folder below the shared folder the session names; beside the warehouse if it names none."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    base = base or f"{spark.conf.get('spark.sql.warehouse.dir')}-checkpoints"
    return f"{base}/pagetables-{uuid.uuid4().hex}"
