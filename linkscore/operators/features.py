"""Per-device features of the heartbeats and the assembly of the per-line feature table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkscore import params as P
from linkscore.functions.columns import capped_percent, db_linear, linear_db
from linkscore.operators import counters as C
from linkscore.operators.ordered import sum_steps

SIGNAL_MEANS = ("db_nr_rsrp", "db_lte_rsrp", "db_nr_snr", "db_lte_snr", "avg_cqi", "avg_memory_free")
SIGNAL_COLUMNS = ("lte_snr", "nr_snr", "lte_rsrp", "nr_rsrp", "cqi", "memory_percent_free", "nr_earfcn_dl")

# Records whose signal measures and memory reading are inside their physical bounds.
PLAUSIBLE_SIGNAL = """
    ((nr_rsrp > -155 and nr_rsrp < -20) or nr_rsrp = 0) and lte_snr < 55 and cqi < 15
    and nr_snr > -23 and nr_snr < 40
    and memory_percent_free is not null and not isnan(memory_percent_free)
"""
NR_CHANNEL = " or ".join(f"nr_earfcn_dl between {low} and {high}" for low, high in P.NR_CHANNEL_RANGES)


def with_signal_values(df: DataFrame) -> DataFrame:
    """Replace the signal columns by what a record adds to the signal features of its device.

    Each value is null where the record does not count: an implausible record, or one of the other
    radio. Decibel values are already in the linear domain.
    """
    radio = df.withColumn("plausible", F.expr(f"coalesce({PLAUSIBLE_SIGNAL}, false)")).withColumn(
        "nr_channel", F.expr(f"case when plausible then {NR_CHANNEL} end")
    )
    nr, lte, ok = F.col("nr_channel"), ~F.col("nr_channel"), F.col("plausible")
    return radio.withColumns(
        {
            "db_nr_rsrp": F.when(nr, db_linear(F.col("nr_rsrp"))),
            "db_lte_rsrp": F.when(lte, db_linear(F.col("lte_rsrp"))),
            "db_nr_snr": F.when(nr, db_linear(F.col("nr_snr"))),
            "db_lte_snr": F.when(lte, db_linear(F.col("lte_snr"))),
            "avg_cqi": F.when(ok, F.col("cqi").cast("double")),
            "avg_memory_free": F.when(ok, F.col("memory_percent_free")),
        }
    ).drop(*SIGNAL_COLUMNS)


def mean_sums(means: Sequence[str]) -> dict[str, Column]:
    """Sum and count of each value column: the parts of a mean that can be added up in any grouping."""
    return {
        **{f"{m}_sum": F.col(m) for m in means},
        **{f"{m}_n": F.col(m).isNotNull().cast("int") for m in means},
    }


def signal_sums() -> dict[str, Column]:
    """Summands of all signal features, over :func:`with_signal_values`."""
    counts = {
        "received": "plausible",
        "channel_records": "nr_channel is not null",
        "nr_records": "coalesce(nr_channel, false)",
        "lte_records": "coalesce(not nr_channel, false)",
    }
    return {**mean_sums(SIGNAL_MEANS), **{name: F.expr(f"int({flag})") for name, flag in counts.items()}}


def with_means(df: DataFrame, means: Sequence[str]) -> DataFrame:
    """Means from :func:`mean_sums`, decibel values back from the linear domain."""

    def mean(m: str) -> Column:
        value = F.try_divide(F.col(f"{m}_sum"), F.col(f"{m}_n").cast("double"))
        return linear_db(value) if m.startswith("db_") else value

    return df.withColumns({m: mean(m) for m in means}).drop(*[f"{m}_{part}" for m in means for part in ("sum", "n")])


def with_shares(df: DataFrame) -> DataFrame:
    """Share of 5G and 4G records in percent and the share of the expected heartbeats received."""

    def share(part: str) -> Column:
        whole = F.col("channel_records").cast("double")
        return F.round(F.try_divide(F.col(part).cast("double"), whole) * F.lit(100.0), 2)

    received = F.col("received") / F.lit(float(P.HEARTBEATS_PER_DAY))
    return df.withColumns(
        {"nr_share": share("nr_records"), "lte_share": share("lte_records"), "received_share": capped_percent(received)}
    )


def signal_average(heartbeats: DataFrame, keys: Sequence[str] = C.DEVICE) -> DataFrame:
    """Signal features per device; nothing needs the row order, so this is one partial aggregate."""
    used = with_signal_values(heartbeats.select(*keys, *SIGNAL_COLUMNS)).where("plausible")
    sums = used.groupBy(*keys).agg(*[F.sum(e).alias(n) for n, e in signal_sums().items()])
    return with_shares(with_means(sums, SIGNAL_MEANS))


def device_features(
    heartbeats: DataFrame, ids: Sequence[str] = ("sn", "imsi")
) -> DataFrame:
    """All features of a device, joined to its distinct id rows.

    Service time, network switches and counters each look at another subset of the rows, yet all
    in time order. One window serves the three, and one aggregate also takes the signal means, so
    the heartbeats move once instead of once per feature group.
    """
    counters = [c for pair in C.FAILURE_PAIRS.values() for c in pair]
    service = ["service_downtime", "service_uptime"]
    used = list(dict.fromkeys(["sn", *C.BY_TIME, *service, "current_network", *counters, *SIGNAL_COLUMNS]))
    per_device = sum_steps(
        with_signal_values(heartbeats.select(*used)),
        C.DEVICE,
        C.BY_TIME,
        {
            "service": (service, C.known_service_time()),
            "network": (["current_network"], C.attached()),
            "counter": (counters, None),
        },
        {
            "downtime_changes": C.changes_of("service_downtime", "service"),
            "uptime_changes": C.changes_of("service_uptime", "service"),
            "network_switches": C.changes_of("current_network", "network"),
            **C.increments_of(counters, "counter"),
        },
        signal_sums(),
    )
    # A device without a plausible record has no signal row at all, so its shares are null.
    per_device = per_device.withColumn("received", F.when(F.col("received") > 0, F.col("received")))
    features = with_shares(with_means(per_device, SIGNAL_MEANS)).withColumns(
        {"downtime_share": C.downtime_share(), **C.failure_ratio_columns()}
    )
    return heartbeats.select(*ids).distinct().join(features, "sn", "left")


def second_source_features(
    heartbeats: DataFrame,
    first_ids: DataFrame,
    ids: Sequence[str] = ("imei", "imsi"),
    order: Sequence[str] = C.BY_TIME,
) -> DataFrame:
    """Features of devices that only the second source knows.

    Aggregating first and then dropping the known devices gives the same rows as dropping their
    heartbeats, but the anti join sees one row per device instead of the whole source.
    """
    bounded = F.expr(
        """nr_snr <> 0 and lte_snr <> 0 and nr_rsrp > -155 and nr_rsrp < 0
           and lte_snr < 55 and lte_snr > -50 and nr_snr > -50"""
    )
    values = {"db_nr_rsrp": "nr_rsrp", "db_nr_snr": "nr_snr", "db_lte_snr": "lte_snr"}
    used = heartbeats.select(
        *dict.fromkeys([*ids, *order, "current_network"]),
        *[F.when(bounded, db_linear(F.col(c))).alias(m) for m, c in values.items()],
    )
    devices = sum_steps(
        used,
        ids,
        order,
        {"network": (["current_network"], C.attached())},
        {"network_switches": C.changes_of("current_network", "network")},
        {"heartbeats": F.lit(1), **mean_sums(list(values))},
    )
    new = devices.join(first_ids.select(*ids).distinct(), list(ids), "left_anti")
    return with_means(new, list(values))


def align_union(first: DataFrame, second: DataFrame) -> DataFrame:
    """Rows of both frames with the columns of the first, null where the second lacks one."""
    shared = [c for c in first.columns if c in second.columns]
    return first.unionByName(second.select(*shared), allowMissingColumns=True).distinct()


def usage_features(usage: DataFrame) -> DataFrame:
    total = F.col("lte_total_mb") + F.col("nr_total_mb")
    return (
        usage.distinct().withColumn("data_usage", total).withColumn("sqrt_data_usage", F.sqrt(F.col("data_usage")))
    )


def speedtest_rows(tests: DataFrame) -> DataFrame:
    """Distinct complete tests with whole-number results."""
    return (
        tests.where(F.col("progress") == 100)
        .select(
            "mdn",
            "imei",
            "status",
            *[F.round(F.col(c), 0).alias(c) for c in ("download_result", "upload_result", "latency")],
        )
        .distinct()
        .drop("imei", "status")
    )


def reset_counts(resets: DataFrame) -> DataFrame:
    return resets.groupBy("sn").agg(F.count("*").alias("reset_count"))


def with_reset_counts(df: DataFrame, resets: DataFrame) -> DataFrame:
    """Add the resets per device, 0 when the log has none."""
    return df.join(reset_counts(resets), "sn", "left").fillna({"reset_count": 0})


FIRST_SOURCE_COLUMNS = (
    "imei", "imsi", "downtime_share", "network_switches", "received_share", "avg_cqi", "avg_memory_free",
    "db_nr_rsrp", "db_lte_rsrp", "db_lte_snr", "db_nr_snr", "lte_rach_failure_ratio",
    "lte_handover_failure_ratio", "nr_scg_change_failure_ratio",
)
NR_TIME_COLUMNS = ("hb_total", "hb_5g")
_AS_IS = ("imei", "imsi", "downtime_share", "network_switches", "received_share")


def first_source_features(features: DataFrame, nr_time: DataFrame) -> DataFrame:
    """Rounded device features with the 5G time share and its counts; devices without a share are left out."""
    rounded = features.select(
        *[c if c in _AS_IS else F.round(F.col(c), 2).alias(c) for c in FIRST_SOURCE_COLUMNS]
    )
    share = nr_time.select("imsi", *NR_TIME_COLUMNS, (F.col("percentage") * F.lit(100.0)).alias("nr_uptime"))
    return rounded.join(share, "imsi").distinct()


def feature_join(
    lines: DataFrame,
    usage: DataFrame,
    tests: DataFrame,
    features: DataFrame,
    router_map: DataFrame,
    resets: DataFrame,
) -> DataFrame:
    """The feature table: one row per line, serial number and distinct speed test."""
    routers = router_map.where(F.col("sn").isNotNull()).select("imei", "sn").distinct()
    usage_cols = ["imsi", "mdn", "lte_total_mb", "nr_total_mb", "nr_usage_percentage", "data_usage", "sqrt_data_usage"]
    used = lines.join(usage.select(*usage_cols), ["imsi", "mdn"], "left")
    joined = (
        used.join(speedtest_rows(tests), "mdn", "left")
        .join(features, ["imei", "imsi"])
        .distinct()
        .join(routers, "imei", "left")
    )
    return with_reset_counts(joined, resets)


def plan_signal(df: DataFrame) -> DataFrame:
    """RSRP and SNR of the radio the plan is sold on; both radios' mean for any other plan."""
    plan = F.col("pplan_cd")

    def pick(nr: str, lte: str) -> Column:
        return (
            F.when(plan.isin(*P.NR_PLANS), F.col(nr))
            .when(plan.isin(*P.LTE_PLANS), F.col(lte))
            .otherwise((F.col(nr) + F.col(lte)) / F.lit(2.0))
        )

    return df.withColumns({"rsrp": pick("db_nr_rsrp", "db_lte_rsrp"), "snr": pick("db_nr_snr", "db_lte_snr")})
