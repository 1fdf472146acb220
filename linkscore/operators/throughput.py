"""Throughput scores: passive measurements and active speed tests against the plan caps."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkscore import params as P
from linkscore.functions.columns import capped_percent, category, weighted_mean
from linkscore.operators.capacity import plan_cap_table

Caps = Sequence[tuple[str, int, int]]


def measured(speed: str):
    """A value that is a number and not zero; NaN is no measurement."""
    return F.col(speed).isNotNull() & ~F.isnan(speed) & (F.col(speed) != 0)


def passive_mean(passive: DataFrame, as_of: dt.date | None = None, days: int = 3) -> DataFrame:
    """Mean passive speed per imsi; with ``as_of`` over the ``days`` dates before it (pruned)."""
    rows = passive
    if as_of is not None:
        rows = rows.where(F.col("datadate").between(as_of - dt.timedelta(days=days), as_of - dt.timedelta(days=1)))
    return rows.where(measured("dl_speed")).groupBy("imsi").agg(F.avg("dl_speed").alias("dl_speed"))


def passive_throughput(lines: DataFrame, speeds: DataFrame, caps: Caps = P.PLAN_CAPS) -> DataFrame:
    """Lines with plan caps and the passive score; no measurement or unknown plan gives null.

    The speeds are one row per imsi, so the lines are the only side that can repeat a key.
    """
    plans = F.broadcast(plan_cap_table(lines.sparkSession, caps))
    score = capped_percent(F.col("dl_speed") / F.col("dl_cap") * F.lit(2))
    return (
        lines.join(speeds, "imsi", "left").join(plans, "pplan_cd", "left").withColumn("passive_score", score)
    )


def passive_peak(customers: DataFrame, passive: DataFrame, caps: Caps = P.PLAN_CAPS_FIRST) -> DataFrame:
    """First version: the peak speed per imsi and device model, lines without one left out."""
    peaks = (
        passive.where(measured("dl_speed"))
        .groupBy("imsi", "device_model")
        .agg(F.max("dl_speed").alias("dl_speed"))
    )
    plans = F.broadcast(plan_cap_table(customers.sparkSession, caps))
    score = capped_percent(F.col("dl_speed") / F.col("dl_cap") * F.lit(2))
    return peaks.join(customers, "imsi").join(plans, "pplan_cd").withColumn("passive_score", score)


def speedtest_avg(tests: DataFrame) -> DataFrame:
    """Mean of the rounded download and upload results per line, over complete tests."""
    complete = (F.col("progress") == 100) & measured("download_result") & measured("upload_result")
    # Whole numbers, summed as such: the mean does not depend on the row order.
    whole = {c: F.round(F.col(c), 0).try_cast("bigint") for c in ("download_result", "upload_result")}
    return tests.where(complete).groupBy("mdn").agg(
        *[(F.sum(v) / F.count("*").cast("double")).alias(c) for c, v in whole.items()]
    )


def with_speedtest(lines: DataFrame, tests: DataFrame) -> DataFrame:
    """Lines (with caps) and their download and upload scores from :func:`speedtest_avg`."""
    return lines.join(tests, "mdn", "left").withColumns(
        {
            "download_score": capped_percent(F.col("download_result") / F.col("dl_cap")),
            "upload_score": capped_percent(F.col("upload_result") / F.col("ul_cap")),
        }
    )


def with_throughput_score(df: DataFrame, weights: Mapping[str, float] = P.THROUGHPUT_WEIGHTS) -> DataFrame:
    return df.withColumn("throughput_score", F.round(weighted_mean(weights), 2)).withColumn(
        "throughput_category", category(F.col("throughput_score"), P.THROUGHPUT_LADDER)
    )


def throughput(
    lines: DataFrame, speeds: DataFrame, tests: DataFrame | None, caps: Caps = P.PLAN_CAPS
) -> DataFrame:
    """Lines with all component scores; without ``tests`` (hourly run) only the passive one counts."""
    passive = passive_throughput(lines, speeds, caps)
    if tests is None:
        return with_throughput_score(passive, P.HOURLY_THROUGHPUT_WEIGHTS)
    return with_throughput_score(with_speedtest(passive, tests))
