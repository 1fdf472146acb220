"""Landing checks and column summaries."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkscore.operators.percentiles import ACCURACY, percentiles

DEFAULT_DELAY = 1
#: Days of a word of landed days: the bits of a long but its sign.
WORD_DAYS = 63
PERCENTS = (5, 25, 50, 75, 95)


def column_summary(
    df: DataFrame,
    columns: Sequence[str],
    percents: Sequence[int] = PERCENTS,
    sketch: bool = False,
    accuracy: int = ACCURACY,
) -> DataFrame:
    """Count, mean, standard deviation, extremes and percentiles of each column, in long form."""
    values = df.select(*[F.col(c).cast("double").alias(c) for c in columns])
    cuts = {f"p{p}": p / 100 for p in percents}
    plain = {"count": F.count, "mean": F.avg, "stddev": F.stddev_samp, "min": F.min, "max": F.max}
    moments = values.agg(*[f(c).cast("double").alias(f"{c}_{n}") for c in columns for n, f in plain.items()])
    found = percentiles(values, columns, [], cuts, sketch, accuracy)
    names = {**{n: n for n in plain}, **{n: f"{n[1:]}%" for n in cuts}}

    def long_form(one: DataFrame) -> DataFrame:
        none = F.lit(None).cast("double")
        pairs = [
            F.struct(
                F.lit(c).alias("column"),
                F.lit(shown).alias("statistic"),
                (F.col(f"{c}_{n}") if f"{c}_{n}" in one.columns else none).alias("value"),
            )
            for c in columns
            for n, shown in names.items()
        ]
        return one.select(F.explode(F.array(*pairs)).alias("_p")).select("_p.*")

    both = long_form(moments).unionByName(long_form(found))
    return both.groupBy("column", "statistic").agg(F.max("value").alias("value"))


def partition_counts(df: DataFrame, date: str) -> DataFrame:
    return df.groupBy(F.col(date).cast("date").alias("part_date")).agg(F.count("*").alias("rows"))


def latest_partition(df: DataFrame, date: str, n: int = 1) -> DataFrame:
    """Row count of the newest ``n`` dates."""
    return partition_counts(df, date).orderBy(F.desc("part_date")).limit(n)


def recent_partitions(df: DataFrame, date: str, n: int) -> DataFrame:
    """The newest ``n`` dates that hold data."""
    return df.select(F.col(date).cast("date").alias("part_date")).distinct().orderBy(F.desc("part_date")).limit(n)


def _expected(landed: DataFrame, expectations: DataFrame) -> DataFrame:
    """(dataset, expected_delay, weekdays_only, newest): all that landed and all that should have."""
    newest = landed.groupBy("dataset").agg(F.max("part_date").alias("newest"))
    return newest.join(expectations, "dataset", "full").select(
        "dataset",
        F.coalesce("expected_delay", F.lit(DEFAULT_DELAY)).alias("expected_delay"),
        F.coalesce("weekdays_only", F.lit(False)).alias("weekdays_only"),
        "newest",
    )


def partition_freshness(landed: DataFrame, expectations: DataFrame, as_of: dt.date) -> DataFrame:
    """Newest landed date per dataset and its days behind the expected one; null for a dataset that
    never landed.

    ``expectations`` has one row per dataset: its delay in days, and whether it lands on working days
    only. A dataset without a row has the default delay and lands daily.
    """
    expected_date = F.date_sub(F.lit(as_of), F.col("expected_delay"))
    return _expected(landed, expectations).select(
        "dataset", "newest", F.date_diff(expected_date, F.col("newest")).alias("delay_days")
    )


def landed_days(landed: DataFrame) -> DataFrame:
    """One row per dataset: its newest date, and its landed days as bits of words, by the word's number.

    A day is a bit of the word that its number since 1970 falls in, so a dataset's history is a few
    longs, and the words of separate landings merge by a bitwise or.
    """
    words = landed.groupBy("dataset", _word(F.col("part_date")).alias("word")).agg(
        F.bit_or(F.expr(f"shiftleft(1L, CAST(pmod(unix_date(part_date), {WORD_DAYS}) AS INT))")).alias("bits"),
        F.max("part_date").alias("newest"),
    )
    entry = F.when(F.col("word").isNotNull(), F.struct("word", "bits"))
    return words.groupBy("dataset").agg(
        F.max("newest").alias("newest"), F.map_from_entries(F.collect_list(entry)).alias("words")
    )


def _word(day: Column) -> Column:
    return F.floor(F.unix_date(day) / WORD_DAYS)


def _due(landed: DataFrame, expectations: DataFrame, as_of: dt.date, window: int, holidays: Sequence[str]) -> DataFrame:
    """(dataset, due, missing): the days expected of the window in order, and whether each did not land."""
    known = landed_days(landed).join(expectations, "dataset", "full")
    last = F.date_sub(F.lit(as_of), F.coalesce("expected_delay", F.lit(DEFAULT_DELAY)))
    days = F.sequence(F.date_sub(last, window - 1), last, F.expr("interval 1 day"))
    daily = ~F.coalesce("weekdays_only", F.lit(False))

    def working(day: Column) -> Column:
        free = F.weekday(day) >= 5
        return ~(free | day.isin(*[dt.date.fromisoformat(h) for h in holidays]) if holidays else free)

    def missed(day: Column) -> Column:
        bits = F.coalesce(F.try_element_at("words", _word(day)), F.lit(0))
        return F.getbit(bits, F.pmod(F.unix_date(day), F.lit(WORD_DAYS))) == 0

    due = known.select("dataset", "words", F.filter(days, lambda day: daily | working(day)).alias("due"))
    return due.select("dataset", "due", F.transform("due", missed).alias("missing"))


def partition_gaps(
    landed: DataFrame, expectations: DataFrame, as_of: dt.date, window: int, holidays: Sequence[str] = ()
) -> DataFrame:
    """Dates that did not land, per dataset, of the window that ends at the dataset's expected date.

    Datasets of working days are not expected on weekends and holidays. The days are read off the
    landed days' bits; only missing ones become rows.
    """
    due = _due(landed, expectations, as_of, window, holidays)
    missing = F.filter("due", lambda day, at: F.get("missing", at))
    return due.select("dataset", F.explode(missing).alias("part_date"))


def partition_outages(
    landed: DataFrame, expectations: DataFrame, as_of: dt.date, window: int, holidays: Sequence[str] = ()
) -> DataFrame:
    """The same as runs: first and last date and the number of days, all of them expected ones.

    A weekend or holiday does not end the run of a dataset that is expected on working days only.
    """
    due = _due(landed, expectations, as_of, window, holidays)
    days = F.transform("due", lambda day, at: F.struct(day.alias("day"), at.alias("at")))

    def edges(step: int) -> Column:
        beside = lambda x: F.coalesce(F.get("missing", x["at"] + step), F.lit(False))
        return F.filter(days, lambda x: F.get("missing", x["at"]) & ~beside(x))

    runs = due.select("dataset", F.explode(F.arrays_zip(edges(-1).alias("first"), edges(1).alias("last"))).alias("run"))
    return runs.select(
        "dataset",
        F.col("run.first.day").alias("first_date"),
        F.col("run.last.day").alias("last_date"),
        (F.col("run.last.at") - F.col("run.first.at") + 1).alias("days"),
    )


def partition_report(freshness: DataFrame, gaps: DataFrame) -> DataFrame:
    """One row per dataset: newest date, delay, and its missing dates in order as text."""
    # At most `window` dates per dataset, so the list is bounded.
    missing = gaps.groupBy("dataset").agg(
        F.count("*").alias("missing_days"),
        F.array_join(F.array_sort(F.collect_list(F.col("part_date").cast("string"))), ",").alias("missing"),
    )
    return freshness.join(missing, "dataset", "left").fillna({"missing_days": 0, "missing": ""})


def missing_dates(spark, done: DataFrame, as_of: dt.date, n: int) -> DataFrame:
    """The last ``n`` dates up to ``as_of`` that are not in ``done`` yet, oldest first."""
    first = as_of - dt.timedelta(days=n - 1)
    spine = spark.range(n).select(F.date_add(F.lit(first), F.col("id").cast("int")).alias("part_date"))
    return spine.join(done.select("part_date").distinct(), "part_date", "left_anti").orderBy("part_date")
