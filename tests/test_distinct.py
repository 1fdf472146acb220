"""Distinct counts from daily sketches."""

import datetime as dt

from conftest import rows
from pyspark.sql import functions as F

from linkscore.operators import distinct as D

FIRST = dt.date(2024, 1, 1)


def test_estimates_are_within_their_bound(spark):
    # 60,000 values, each seen on two dates; dates overlap.
    df = spark.range(60_000).select(
        F.col("id").cast("string").alias("sn"), (F.col("id") % 2).alias("g"),
        F.explode(F.array(F.col("id") % 10, (F.col("id") + 3) % 10)).alias("d"),
    ).withColumn("date", F.date_add(F.lit(FIRST), F.col("d").cast("int")))
    sketches = D.daily_distinct(df, "sn", ["g"], "date")
    assert sketches.count() == 20
    both = D.rolling_estimates(sketches, ["g"], "date", 4).join(D.rolling_counts(df, "sn", ["g"], "date", 4), ["g", "end_date"], "full")
    found = both.collect()
    assert len(found) == 2 * 13 and max(r.exact for r in found) >= 15_000
    assert all(abs(r.estimate - r.exact) <= D.error_bound() * r.exact for r in found)
    assert any(r.estimate != r.exact for r in found)


def test_nulls_and_empty(spark):
    schema = "sn string, g int, date date"
    df = spark.createDataFrame([(None, 1, FIRST), ("a", None, FIRST), ("a", None, FIRST)], schema)
    estimates = D.rolling_estimates(D.daily_distinct(df, "sn", ["g"], "date"), ["g"], "date", 1)
    assert rows(estimates) == rows(D.rolling_counts(df, "sn", ["g"], "date", 1).withColumnRenamed("exact", "estimate"))
    assert D.daily_distinct(df.limit(0), "sn", ["g"], "date").collect() == []
