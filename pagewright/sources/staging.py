"""Tables that are written once and read by several branches of a plan."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir, which the driver and all executors share; a local run that names none gets one."""
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not named:
        if not context.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="pagewright-"))
        named = context.getCheckpointDir()
    return named.rstrip("/")


def staged(df: DataFrame) -> DataFrame:
    """The table, written to the shared folder: its branches read it there, and no lineage hangs on an executor."""
    path = f"{shared_folder(df.sparkSession)}/staged-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
