"""Availability score: assumed downtime from counters, state changes and modem crashes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkscore import params as P
from linkscore.functions.columns import category
from linkscore.operators import counters as C


def modem_crashes(events: DataFrame, keys: Sequence[str] = C.DEVICE) -> DataFrame:
    """Number of modem events per key."""
    return events.where(F.col("modem_event").isNotNull()).groupBy(*keys).agg(F.count("*").alias("crashes"))


def availability(
    heartbeats: DataFrame,
    params: P.AvailabilityParams = P.AvailabilityParams(),
    crashes: DataFrame | None = None,
    crash_join: str = "left",
    keys: Sequence[str] = C.DEVICE,
    order: Sequence[str] = C.BY_UPTIME,
) -> DataFrame:
    """One row per key with the downtime estimate, the score and its category.

    ``crashes`` (from :func:`modem_crashes`, same keys) adds crash time; with ``crash_join="inner"``
    a device without a crash is left out instead of counting zero.
    """
    per_device = C.service_time(heartbeats, C.FAILURE_COUNTERS, keys, order)
    downtime = (
        F.col("sum_rrc_connect_failure_count") * F.lit(params.rrc_failure_s)
        + F.col("sum_lte_rach_failure_count") * F.lit(params.rach_failure_s)
        + F.col("downtime_changes") * F.lit(params.downtime_change_s)
    )
    if crashes is not None:
        per_device = per_device.join(crashes, list(keys), crash_join).withColumn(
            "crashes", F.coalesce("crashes", F.lit(0))
        )
        downtime = F.col("crashes") * F.lit(params.crash_s) + downtime
    share = F.col("assumed_downtime") / F.lit(params.period_s) * F.lit(100.0)
    raw = F.lit(100.0) - F.lit(params.penalty) * F.col("not_available_pct")
    return (
        per_device.withColumn("assumed_downtime", downtime)
        .withColumn("not_available_pct", share)
        .withColumn("availability_score", F.when(raw < 0, F.lit(0.0)).otherwise(F.round(raw, params.round_digits)))
        .withColumn("availability_category", category(F.col("availability_score"), P.AVAILABILITY_LADDER))
    )
