"""Writing results."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_dates(df: DataFrame, base: str, partitions: Sequence[str] = ("date",)) -> None:
    """Write a partitioned Parquet table, replacing only the partitions that ``df`` contains.

    Rows of a partition are brought together first, a large one in several files.
    """
    df.hint("rebalance", *partitions).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partitions).parquet(base)


def write_hours(df: DataFrame, base: str) -> None:
    write_dates(df, base, ("date", "hr"))


def write_folder(df: DataFrame, path: str) -> None:
    """Write one Parquet folder, replacing it."""
    df.write.mode("overwrite").parquet(path)


def write_files(df: DataFrame, path: str, files: int = 10, mode: str = "overwrite") -> None:
    """Write with a fixed number of files; with mode ``errorifexists`` the folder must be new."""
    df.repartition(files).write.mode(mode).parquet(path)


def write_subset(df: DataFrame, path: str, column: str, values: Sequence[str]) -> None:
    """Write only the rows whose ``column`` is one of ``values``."""
    write_folder(df.where(F.col(column).isin(*values)), path)


def write_and_read(df: DataFrame, path: str) -> DataFrame:
    """Write one folder and continue from the stored rows."""
    write_folder(df, path)
    spark: SparkSession = df.sparkSession
    return spark.read.parquet(path)
