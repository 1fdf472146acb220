"""Landing checks and summaries."""

import datetime as dt

import pytest
from conftest import rows
from pyspark.sql import functions as F

from linkscore.operators import quality as Q

AS_OF = dt.date(2024, 1, 16)  # a Tuesday


@pytest.fixture(scope="module")
def landed(spark):
    data = [("a", dt.date(2024, 1, d)) for d in (8, 9, 11, 12, 15)] + [("b", dt.date(2024, 1, 2))]
    return spark.createDataFrame(data, "dataset string, part_date date")


def days(df, dataset):
    return sorted(r.part_date.day for r in df.where(F.col("dataset") == dataset).collect())


@pytest.fixture(scope="module")
def expected(spark):
    """a lands a day late on every day, w two days late on working days, gone should have landed; b is not listed."""
    data = [("a", 1, False), ("w", 2, True), ("gone", 0, False)]
    return spark.createDataFrame(data, "dataset string, expected_delay int, weekdays_only boolean")


def test_gaps_test_exactly_the_window(landed, expected):
    gaps = Q.partition_gaps(landed, expected, AS_OF, 7)
    assert days(gaps, "a") == [10, 13, 14] and days(gaps, "b") == list(range(9, 16))
    assert days(gaps, "gone") == list(range(10, 17))
    assert days(gaps, "w") == [8, 9, 10, 11, 12]


def test_only_working_day_feeds_know_holidays(landed, expected):
    gaps = Q.partition_gaps(landed, expected, AS_OF, 14, holidays=["2024-01-02", "2024-01-10", "2024-01-12"])
    assert days(gaps, "w") == [1, 3, 4, 5, 8, 9, 11]
    assert 10 in days(gaps, "a") and 2 not in days(gaps, "b") and 12 in days(gaps, "b")


def test_freshness_and_report(landed, expected):
    fresh = Q.partition_freshness(landed, expected, AS_OF)
    assert rows(fresh.select("dataset", "delay_days")) == [("a", 0), ("b", 13), ("gone", None), ("w", None)]
    report = Q.partition_report(fresh, Q.partition_gaps(landed, expected, AS_OF, 5))
    got = {r.dataset: (r.newest and r.newest.day, r.missing_days, r.missing) for r in report.collect()}
    assert got["a"] == (15, 2, "2024-01-13,2024-01-14") and got["b"][1] == 5 and got["gone"][:2] == (None, 5)


def test_a_complete_dataset_reports_nothing_missing(landed, expected):
    report = Q.partition_report(Q.partition_freshness(landed, expected, AS_OF), Q.partition_gaps(landed, expected, AS_OF, 1))
    assert [tuple(r)[3:] for r in report.where("dataset = 'a'").collect()] == [(0, "")]


def test_latest_and_recent(landed):
    assert [tuple(r) for r in Q.latest_partition(landed, "part_date").collect()] == [(dt.date(2024, 1, 15), 1)]
    assert [r.part_date.day for r in Q.recent_partitions(landed, "part_date", 3).collect()] == [15, 12, 11]


def test_missing_dates_oldest_first(spark, landed):
    got = [r.part_date.day for r in Q.missing_dates(spark, landed, AS_OF, 7).collect()]
    assert got == [10, 13, 14, 16]


def test_column_summary(spark):
    df = spark.range(1, 101).select(F.col("id").alias("x"), F.lit(None).cast("double").alias("none"))
    got = {(r.column, r.statistic): r.value for r in Q.column_summary(df, ["x", "none"]).collect()}
    assert got["x", "count"] == 100 and got["x", "mean"] == 50.5 and got["x", "25%"] == 25 and got["x", "max"] == 100
    assert got["x", "stddev"] == pytest.approx(29.011491975882016)
    assert not Q.column_summary(df.limit(0), ["x"]).where("statistic = 'count' and value <> 0").collect()
    assert got["none", "count"] == 0 and got["none", "50%"] is None and len(got) == 20


def test_outages_are_runs_of_expected_days(landed, expected):
    def runs(dataset, window, holidays=()):
        found = Q.partition_outages(landed, expected, AS_OF, window, holidays).where(F.col("dataset") == dataset)
        return sorted((r.first_date.day, r.last_date.day, r.days) for r in found.collect())

    assert runs("a", 7) == [(10, 10, 1), (13, 14, 2)] and runs("b", 7) == [(9, 15, 7)]
    # Working days only: the weekend of the 6th and 7th and a holiday do not end the run.
    assert runs("w", 14) == [(1, 12, 10)] and runs("w", 14, ["2024-01-10"]) == [(1, 12, 9)]
    assert runs("a", 1) == []


def test_landed_days_merge_over_words(spark):
    dates = [dt.date(1969, 12, 30), dt.date(1970, 1, 1), dt.date(2024, 1, 5), dt.date(2024, 1, 5), dt.date(2023, 11, 1), None]
    landed = spark.createDataFrame([("a", d) for d in dates] + [("none", None)], "dataset string, part_date date")
    by = {r.dataset: r for r in Q.landed_days(landed).collect()}
    assert by["a"].newest == dt.date(2024, 1, 5) and sum(bin(x).count("1") for x in by["a"].words.values()) == 4
    assert by["none"].newest is None and by["none"].words == {}
    none = spark.createDataFrame([], "dataset string, expected_delay int, weekdays_only boolean")
    gaps = Q.partition_gaps(landed, none, dt.date(2024, 1, 6), 100)
    assert gaps.where("dataset = 'a'").count() == 98 and gaps.where("dataset = 'none'").count() == 100
