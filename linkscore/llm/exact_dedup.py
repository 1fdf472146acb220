"""Exact deduplication by distributed MSD radix partitioning.

Documents are split by their leading bytes, the groups by the bytes that follow, and so on until a
group holds one row or its texts have ended. A digit is a slice of bytes: 64 at first, then 64 KiB,
then 1 MiB a round. Only groups of two or more go on, so a round moves no more than the texts that
still agree with another. Rows that have agreed on every digit up to their end are equal byte by
byte; no digest takes part.

A hot group is counted by partial aggregates and joined to its one-row summary by a sort-merge join
at every size, which adaptive execution can split.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkscore.llm.store import Scratch

FIRST_DIGIT = 64
GROWTH = 1024
WIDEST_DIGIT = 1 << 20


def normalised(text: Column) -> Column:
    """Every run of ASCII white space as one space; null as the empty text."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " ")


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id_col, keep_id, group_size, kept, text_sha256.

    Rows with equal normalised text form a group; the row with the smallest id stays (null ids come
    last, of rows with the same id one stays). A null text equals the empty text. Texts of any
    length are compared whole. An empty table gives an empty result; other columns are ignored.
    """
    scratch = Scratch(docs.sparkSession)
    text = normalised(F.col(text_col))
    rows = docs.select(
        F.col(id_col).alias("id"),
        F.monotonically_increasing_id().alias("row"),
        F.unhex(F.sha2(text, 256)).alias("sha"),
        F.lit(0).cast("long").alias("group"),
        text.cast("binary").alias("rest"),
    )
    done, previous, width = [], None, FIRST_DIGIT
    while True:
        split = _split(scratch, rows, width)
        if previous is not None:
            scratch.drop(previous, "live=true")
        ended = split.filter("NOT live").drop("rest", "live")
        done.append(ended.withColumn("round", F.lit(len(done))))
        rows = split.filter("live").drop("live", "size")
        if rows.isEmpty():
            break
        previous, width = split, min(width * GROWTH, WIDEST_DIGIT)
    return _decided(scratch, done, id_col)


def _split(scratch: Scratch, rows: DataFrame, width: int) -> DataFrame:
    """One round: rows with the group of their digit, none for a row that stands alone; live ones go on.

    A task writes at most two files: on a local disk Hadoop starts a process for each of them.
    """
    rows = rows.withColumn("digit", F.substring("rest", 1, width))
    groups = scratch.put(
        rows.groupBy("group", "digit")
        .agg(F.min("row").alias("next"), F.count("*").alias("size"))
        .filter("size > 1")
    )
    live = F.col("next").isNotNull() & (F.octet_length("digit") >= width)
    joined = (
        rows.join(groups.hint("merge"), ["group", "digit"], "left")
        .withColumn("live", live)
        .select(
            "id",
            "row",
            "sha",
            F.col("next").alias("group"),
            "size",
            F.when(F.col("live"), F.substring("rest", width + 1, 2147483647)).alias("rest"),
            "live",
        )
    )
    return scratch.put(joined, "live")


def _decided(scratch: Scratch, done: list[DataFrame], id_col: str) -> DataFrame:
    rows = reduce(DataFrame.unionByName, done)
    alone = rows.filter("group IS NULL").select(
        "id",
        F.col("id").alias("keep_id"),
        F.lit(1).cast("long").alias("group_size"),
        F.lit(True).alias("kept"),
        "sha",
    )
    copies = rows.filter("group IS NOT NULL")
    first = F.min(F.struct(F.col("id").isNull().alias("last"), "id", "row"))
    keep = scratch.put(copies.groupBy("round", "group").agg(first.alias("keep")))
    grouped = copies.join(keep.hint("merge"), ["round", "group"]).select(
        "id",
        F.col("keep.id").alias("keep_id"),
        F.col("size").alias("group_size"),
        (F.col("row") == F.col("keep.row")).alias("kept"),
        "sha",
    )
    return alone.unionByName(grouped).select(
        F.col("id").alias(id_col),
        "keep_id",
        "group_size",
        "kept",
        F.lower(F.hex("sha")).alias("text_sha256"),
    )
