"""Distinct counts over windows of days, from sketches that are stored once a day."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Logarithm of a sketch's size; each step more halves its area of error and doubles its bytes.
LOG_SIZE = 12


def error_bound(log_size: int = LOG_SIZE) -> float:
    """Three standard deviations of an estimate, relative to the count."""
    return 3 * 1.04 / math.sqrt(1 << log_size)


def _ends(date: str, days: int) -> Column:
    """The last dates of all windows of ``days`` days that contain the date."""
    return F.explode(F.sequence(F.col(date), F.date_add(date, days - 1), F.expr("interval 1 day"))).alias("end_date")


def daily_distinct(df: DataFrame, value: str, by: Sequence[str], date: str, log_size: int = LOG_SIZE) -> DataFrame:
    """One sketch of the values per group and date. Nulls are not counted; a group of nulls only has an empty sketch."""
    return df.groupBy(*by, date).agg(F.hll_sketch_agg(value, log_size).alias("sketch"))


def rolling_estimates(sketches: DataFrame, by: Sequence[str], date: str, days: int, name: str = "estimate") -> DataFrame:
    """Distinct values per group and window, named by the window's last date. Only sketches are moved, a row per group and date."""
    return sketches.select(*by, "sketch", _ends(date, days)).groupBy(*by, "end_date").agg(
        F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias(name)
    )


def rolling_counts(df: DataFrame, value: str, by: Sequence[str], date: str, days: int, name: str = "exact") -> DataFrame:
    """The same, exactly: every value of a day takes part in every window over it."""
    daily = df.select(*by, date, value).distinct()
    return daily.select(*by, value, _ends(date, days)).groupBy(*by, "end_date").agg(F.count_distinct(value).alias(name))
