"""Results that several readers share, written once to the folder that driver and executors share."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder the session names in ``spark.checkpoint.dir``; beside the warehouse in local mode, where it names none."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir has to name a folder that driver and executors share")
    return f"{spark.conf.get('spark.sql.warehouse.dir')}-checkpoints"


def staged(df: DataFrame) -> DataFrame:
    """The same rows from a checkpoint: what made them runs once, whoever reads them and whatever is lost later."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint()
