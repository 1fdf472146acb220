"""Reading the inputs: date partitions, CSV and JSON trees, JDBC extracts, optional inputs."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

Schema = str | T.StructType


def read_day(spark: SparkSession, base: str, date: dt.date, hour: int | None = None) -> DataFrame:
    """One ``date=yyyymmdd`` partition (and ``hour=HH``) of a Parquet table.

    The partition's own folder is read, so the other dates are not even listed.
    """
    path = f"{base}/date={date.strftime('%Y%m%d')}" + ("" if hour is None else f"/hour={hour:02d}")
    return spark.read.option("basePath", base).parquet(path)


def read_csv(spark: SparkSession, paths: str | Sequence[str], schema: Schema | None = None) -> DataFrame:
    """CSV with a header, plain or gzip, from one or several paths; all text without a schema.

    Files are matched by their header, so a schema may name a subset of the columns.
    """
    reader = spark.read.option("header", True)
    if schema is not None:
        reader = reader.schema(schema).option("enforceSchema", False)
    return reader.csv(paths if isinstance(paths, str) else list(paths))


def read_csv_tree(spark: SparkSession, base: str) -> DataFrame:
    """Every CSV file below a folder."""
    return spark.read.option("header", True).option("recursiveFileLookup", True).csv(base)


def read_json_tree(spark: SparkSession, base: str, schema: Schema) -> DataFrame:
    """Every JSON file below a folder, with a given schema, so the data is read once."""
    return spark.read.schema(schema).option("recursiveFileLookup", True).json(base)


def read_parquet_tree(spark: SparkSession, base: str) -> DataFrame:
    return spark.read.option("recursiveFileLookup", True).parquet(base)


def dated_paths(base: str, dates: Sequence[dt.date], column: str) -> list[str]:
    return [f"{base}/{column}={d.isoformat()}" for d in dates]


def exists(spark: SparkSession, path: str) -> bool:
    """True when ``path`` holds a readable Parquet table; a folder left empty by a failed write does not."""
    try:
        spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return False
        raise
    return True


def optional_input(spark: SparkSession, read, schema: Schema) -> DataFrame:
    """The frame ``read()`` returns, or an empty one with ``schema`` when its path does not exist."""
    try:
        return read()
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def latest_available(df: DataFrame, date: str, as_of: dt.date, days: int = 3) -> DataFrame:
    """Rows of the newest date among ``as_of`` and the days before it; empty when none has data."""
    window = df.where(F.col(date).between(as_of - dt.timedelta(days=days - 1), as_of))
    # One row, so it may be broadcast; on a partition column it also prunes the scan.
    newest = F.broadcast(window.agg(F.max(date).alias("_newest")))
    return window.join(newest, F.col(date) == F.col("_newest"), "left_semi")


def rows_of_dates(df: DataFrame, date: str, wanted: DataFrame, first: dt.date, last: dt.date) -> DataFrame:
    """Rows whose date is one of those in ``wanted``, found at run time, from ``first`` to ``last``.

    At most one row for each day between the two is broadcast. On a partition column the scan reads
    the folders of these dates only.
    """
    within = F.col(date).between(first, last)
    return df.where(within).join(F.broadcast(wanted.where(within).select(date).distinct()), date, "left_semi")


def multi_date_union(df: DataFrame, date: str, dates: Sequence[dt.date]) -> DataFrame:
    """Rows of the listed dates in one read; a date without data adds nothing."""
    return df.where(F.col(date).isin(list(dates)))


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def newest_folder(read: Callable[[str], DataFrame], base: str, as_of: dt.date, days: int = 3) -> DataFrame:
    """What ``read`` gives for the newest existing date folder among ``as_of`` and the days before it."""
    for back in range(days):
        try:
            return read(f"{base}/{(as_of - dt.timedelta(days=back)).isoformat()}")
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
    raise FileNotFoundError(f"no folder under {base} for {as_of} or {days - 1} days before")


def renamed(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Only the columns in ``names`` (source name to engine name), matched without regard to case."""
    return df.select(*[F.col(f"`{old}`").alias(new) for old, new in names.items()])


def read_dates(spark: SparkSession, base: str, dates: Sequence[dt.date]) -> DataFrame:
    """Union of one folder per date, missing folders skipped; FileNotFoundError if none exists."""
    paths = [f"{base}/{d.isoformat()}" for d in dates]
    found = [p for p in paths if exists(spark, p)]
    if not found:
        raise FileNotFoundError(f"no folder under {base} for any of {len(paths)} dates")
    return union_all([spark.read.parquet(p) for p in found])


# Fixed value: the text format of a speed test's creation time.
CREATED_FORMAT = "MMM dd, yyyy hh:mm:ss a"


def created_at(column: str = "transactioncreatedate", time_format: str = "Mon DD, YYYY hh:mi:ss PM") -> str:
    """The database's expression for the time a test was created."""
    return f"to_timestamp({column}, '{time_format}')"


def extract_query(table: str, day: dt.date, created: str | None = None) -> str:
    """Subquery for the database: finished tests created in the day after ``day`` began."""
    at = created or created_at()
    return (
        f"(select * from {table} where {at} > date '{day.isoformat()}' and {at} <= date '{day.isoformat()}' + interval '1 days'"
        " and status <> 'FAILED') as extract"
    )


def extract_slots(day: dt.date, slots: int = 24, created: str | None = None) -> list[str]:
    """Conditions that cut the day into equal slots, one per parallel connection."""
    at = created or created_at()
    edges = [dt.datetime.combine(day, dt.time()) + dt.timedelta(days=1) * k / slots for k in range(slots + 1)]
    return [
        f"{at} > timestamp '{low.isoformat(' ')}' and {at} <= timestamp '{high.isoformat(' ')}'"
        for low, high in zip(edges, edges[1:])
    ]


def read_jdbc_extract(
    spark: SparkSession,
    url: str,
    table: str,
    day: dt.date,
    options: Mapping[str, str],
    slots: int = 24,
    created: str | None = None,
) -> DataFrame:
    """One day of speed tests, filtered inside the database; the caller supplies the connection."""
    query, conditions = extract_query(table, day, created), extract_slots(day, slots, created)
    return with_numbers(spark.read.jdbc(url=url, table=query, predicates=conditions, properties=dict(options)))


def with_numbers(df: DataFrame) -> DataFrame:
    numbers = {"uploadresult", "downloadresult", "latency", "upload_result", "download_result"}
    return df.withColumns({c: F.col(c).try_cast("double") for c in df.columns if c.lower() in numbers})


def landed_extract(df: DataFrame, start: dt.date, days: int = 1, created: str = "created") -> DataFrame:
    """The same extract from a file copy: not failed, created in ``(start, start + days]``."""
    at = F.to_timestamp_ntz(F.col(created), F.lit(CREATED_FORMAT))
    begin, end = (F.lit(start + dt.timedelta(days=d)).cast("timestamp_ntz") for d in (0, days))
    rows = df.where(F.col("status") != "FAILED").withColumn("created_at", at)
    return with_numbers(rows.where((F.col("created_at") > begin) & (F.col("created_at") <= end)))
