"""Intermediate tables that are stored once and read again."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession


def checkpoint_folder(spark: SparkSession) -> str:
    """The session's checkpoint folder. A local session without one gets a temporary folder; a
    cluster must name a shared folder in ``spark.checkpoint.dir``."""
    context = spark.sparkContext
    folder = context.getCheckpointDir()
    if folder is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None:
            if not context.master.startswith("local"):
                raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
            folder = tempfile.mkdtemp(prefix="linkscore-checkpoint-")
        context.setCheckpointDir(folder)
    return folder


def stored(df: DataFrame) -> DataFrame:
    """``df`` written to the checkpoint folder: computed once, safe against lost executors."""
    checkpoint_folder(df.sparkSession)
    return df.checkpoint(eager=True)
