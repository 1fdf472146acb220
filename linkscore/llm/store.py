"""Intermediate tables in the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTING = "spark.checkpoint.dir"


_OWN: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir. Only a local session may leave it unset."""
    folder = spark.conf.get(SETTING, None)
    if not folder:
        context = spark.sparkContext
        if not context.master.startswith("local["):
            raise ValueError(f"{SETTING} must name a folder that all executors share")
        if context.applicationId not in _OWN:
            _OWN[context.applicationId] = f"file://{tempfile.mkdtemp(prefix='linkscore-')}"
        folder = _OWN[context.applicationId]
    return folder.rstrip("/")


class Scratch:
    """Tables of one query. They stay while its lazy result may read them; those that later steps
    no longer need go at once."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.folder = f"{shared_folder(spark)}/llm-{uuid.uuid4().hex}"
        self.count = 0
        self.paths: dict[int, str] = {}

    def put(self, df: DataFrame, *split: str) -> DataFrame:
        """Writes the frame, in folders by the columns of split, and reads it back."""
        self.count += 1
        path = f"{self.folder}/{self.count}"
        writer = df.write.partitionBy(*split) if split else df.write
        writer.parquet(path)
        back = self.spark.read.schema(df.schema).parquet(path)
        self.paths[id(back)] = path
        return back

    def drop(self, df: DataFrame, part: str = "") -> None:
        """Deletes a table of this query, or one folder of it."""
        path = self.paths.get(id(df))
        if path:
            target = self.spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{part}" if part else path)
            files = target.getFileSystem(self.spark._jsc.hadoopConfiguration())
            files.delete(target, True)
