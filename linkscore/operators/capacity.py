"""Link capacity: bandwidth from the bands in use, scaled by signal quality and the plan."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkscore import params as P
from linkscore.functions.columns import category, hundredths, round2
from linkscore.operators import sieve
from linkscore.operators.customers import alias_model

LTE_BANDS = ("lte_pcc_band", "lte_scc1_band", "lte_scc2_band", "lte_scc3_band")
NR_BANDS = ("nr_pcc_band", "nr_scc1_band")
PARTS = ("lte_capacity", "nw_capacity", "cband_capacity")


def _sum(columns) -> Column:
    return reduce(Column.__add__, columns)


def valid_snr(snr: Column, params: P.CapacityParams, nonzero: bool = True) -> Column:
    inside = snr.between(params.min_snr, params.max_snr)
    return inside & (snr != 0) if nonzero else inside


def with_bandwidths(df: DataFrame, params: P.CapacityParams = P.CapacityParams()) -> DataFrame:
    """Add the LTE, nationwide 5G and C-band bandwidth of each record, in MHz."""
    mhz, cband = F.lit(params.carrier_mhz), F.lit(params.cband)
    pcc, scc = F.col("nr_pcc_band"), F.col("nr_scc1_band")
    wide = F.col("nr_earfcn_dl").between(*params.cband_wide_channels)
    return df.withColumns(
        {
            "lte_mhz": _sum(F.when(F.col(b) > 0, mhz).otherwise(0) for b in LTE_BANDS),
            "nw_mhz": _sum(
                F.when((F.col(b) > 0) & (F.col(b) != cband), mhz).otherwise(0) for b in NR_BANDS
            ),
            "cband_mhz": F.when((pcc == cband) & (scc == cband), params.cband_both_mhz)
            .when((pcc == cband) & wide, params.cband_wide_mhz)
            .when((pcc == cband) & ~wide, params.cband_narrow_mhz)
            .when((pcc != cband) & (scc == cband), params.cband_secondary_mhz)
            .otherwise(0),
        }
    )


def with_capacities(
    df: DataFrame, params: P.CapacityParams = P.CapacityParams(), rounded: bool = True
) -> DataFrame:
    """Add the capacity of each record per radio: bandwidth x SNR quality, none for SNR 0."""

    def quality(snr: Column, offset: float) -> Column:
        share = F.least(F.lit(1.0), (snr + F.lit(offset)) / F.lit(params.snr_span))
        return F.when(snr.isNull(), F.lit(0.0)).otherwise(share) if params.null_snr == "zero" else share

    def capacity(mhz: Column, snr: Column, offset: float) -> Column:
        value = F.when(snr == 0, F.lit(0.0)).otherwise(mhz * quality(snr, offset))
        return round2(value) if rounded else value

    lte, nr = F.col("lte_snr"), F.col("nr_snr")
    return df.withColumns(
        {
            "lte_capacity": capacity(F.col("lte_mhz"), lte, params.snr_offset),
            "nw_capacity": capacity(F.col("nw_mhz"), nr, params.snr_offset),
            "cband_capacity": capacity(
                F.col("cband_mhz") * F.lit(params.cband_factor), nr, params.cband_snr_offset
            ),
        }
    )


def record_capacity(
    heartbeats: DataFrame,
    keys: Sequence[str],
    params: P.CapacityParams,
    require: str,
) -> DataFrame:
    """Usable records with their three capacities; ``require`` any or all radios to have a valid SNR."""
    lte, nr = valid_snr(F.col("lte_snr"), params), valid_snr(F.col("nr_snr"), params)
    used = ["lte_snr", "nr_snr", "nr_earfcn_dl", *LTE_BANDS, *NR_BANDS]
    records = heartbeats.select(*keys, *used).where(lte | nr if require == "any" else lte & nr)
    records = with_bandwidths(records, params).where(F.col("lte_mhz") + F.col("nw_mhz") + F.col("cband_mhz") > 0)
    return with_capacities(records, params).select(*keys, *PARTS)


def _adjustment(dl_cap: float, params: P.CapacityParams) -> float:
    return min(dl_cap / params.full_plan_mbps, 1.0)


def _percent(adjustment: Column, params: P.CapacityParams) -> Column:
    total = F.col("lte_capacity") + F.col("nw_capacity") + F.col("cband_capacity")
    return round2(F.lit(100.0) * (total / (F.lit(params.best_mhz) * adjustment)))


def link_capacity(
    heartbeats: DataFrame,
    lines: DataFrame,
    caps: Sequence[tuple[str, int, int]] = P.PLAN_CAPS,
    params: P.CapacityParams = P.CapacityParams(),
    known_only: bool = False,
) -> DataFrame:
    """Mean capacities and the plan-adjusted capacity score per (sn, mdn).

    A record's percentage depends on its line only through the plan's adjustment, and a plan table
    has few distinct adjustments. So each (sn, imsi) is aggregated once per adjustment before any
    join: the join with the lines moves one row per device instead of every heartbeat, and a
    device with a third of all rows costs no more than any other. With ``known_only`` records of
    devices that no line knows leave before that aggregation, by a filter made of the lines (which
    are then read twice); the result is the same.
    """
    if known_only:
        heartbeats = sieve.passing(heartbeats, sieve.known_keys(lines, ["sn", "imsi"]), ["sn", "imsi"])
    adjustments = sorted({_adjustment(dl, params) for _, dl, _ in caps})
    records = record_capacity(heartbeats, ["sn", "imsi"], params, "any")
    parts = {f"_sum_{p}": hundredths(F.col(p)) for p in PARTS}

    def capped(adjustment: Column) -> Column:
        return hundredths(F.least(_percent(adjustment, params), F.lit(100.0)))

    # A constant of one row per plan, so it may be broadcast.
    plans = lines.sparkSession.createDataFrame(
        [(code, a, adjustments.index(a) + 1) for code, dl, _ in caps for a in [_adjustment(dl, params)]],
        "pplan_cd string, adjustment double, _step int",
    )
    adjusted = lines.select("sn", "imsi", "mdn", "pplan_cd").join(F.broadcast(plans), "pplan_cd")
    steps = {f"_pct_{i}": capped(F.lit(a)) for i, a in enumerate(adjustments)}
    sums = [F.sum(e).alias(n) for n, e in {**parts, **steps}.items()]
    per_device = records.groupBy("sn", "imsi").agg(F.count("*").alias("_n"), *sums)
    joined = per_device.join(adjusted, ["sn", "imsi"]).withColumn("_pct", F.element_at(F.array(*steps), F.col("_step")))

    def mean(total: str) -> Column:
        return F.round(F.sum(total) / F.lit(100.0) / F.sum("_n"), 2)

    adjustment = F.round(F.sum(F.col("adjustment") * F.col("_n")) / F.sum("_n"), 2)
    return (
        joined.groupBy("sn", "mdn")
        .agg(
            *[mean(f"_sum_{p}").alias(p) for p in PARTS],
            adjustment.alias("plan_adjustment"),
            mean("_pct").alias("capacity_score"),
        )
        .withColumn("capacity_category", category(F.col("capacity_score"), P.CAPACITY_LADDER))
    )


def link_capacity_strict(
    heartbeats: DataFrame,
    keys: Sequence[str] = ("sn", "imsi"),
    params: P.CapacityParams = P.CapacityParams(),
) -> DataFrame:
    """Mean capacities per device over records where both radios are valid, without plan adjustment."""
    records = record_capacity(heartbeats, list(keys), params, "all").withColumn("_pct", _percent(F.lit(1.0), params))
    columns = {**{p: p for p in PARTS}, "capacity_score": "_pct"}
    return records.groupBy(*keys).agg(
        *[
            F.round(F.sum(hundredths(F.col(c))) / F.lit(100.0) / F.count("*"), 2).alias(name)
            for name, c in columns.items()
        ]
    )


def plan_cap_table(spark, caps: Sequence[tuple[str, int, int]] = P.PLAN_CAPS) -> DataFrame:
    """The plan table as a frame; a constant, so it may be broadcast."""
    return spark.createDataFrame(list(caps), "pplan_cd string, dl_cap bigint, ul_cap bigint")


def capacity_by_model(
    heartbeats: DataFrame,
    models: Sequence[str] = P.DISTRIBUTION_MODELS,
    aliases: Mapping[str, str] = P.MODEL_ALIASES,
    params: P.CapacityParams = P.CapacityParams(),
    accuracy: int = 10000,
) -> DataFrame:
    """Distribution of the device capacity share per model.

    The records are placed by (sn, ts) once; distinct rows, the sum and the join of the two sides
    then need no further shuffle of heartbeat-sized data.
    """
    used = ["sn", "ts", "model_name", "lte_snr", "nr_snr", "nr_earfcn_dl", *LTE_BANDS, *NR_BANDS]
    named = heartbeats.where(F.col("model_name").isin(*models)).select(*used).repartition("sn", "ts")
    lte, nr = F.col("lte_snr"), F.col("nr_snr")
    valid = valid_snr(lte, params, False) & valid_snr(nr, params, False)
    signals = named.where(valid).select("sn", "ts", "lte_snr", "nr_snr").distinct()
    name = alias_model(F.col("model_name"), aliases)
    bandwidths = (
        with_bandwidths(named, params)
        .select("sn", "ts", name.alias("model"), "lte_mhz", "nw_mhz", "cband_mhz")
        .distinct()
        .groupBy("sn", "ts", "model")
        .agg(*[F.sum(c).alias(c) for c in ("lte_mhz", "nw_mhz", "cband_mhz")])
    )
    usable = ((lte != 0) & (F.col("lte_mhz") > 0)) | ((nr != 0) & (F.col("nw_mhz") + F.col("cband_mhz") > 0))
    records = with_capacities(bandwidths.join(signals, ["sn", "ts"]).where(usable), params, rounded=False)
    share = (F.col("lte_capacity") + F.col("nw_capacity") + F.col("cband_capacity")) / F.lit(params.best_mhz)
    per_device = records.groupBy("sn", "model").agg(F.avg(share).alias("share"))

    percents = (10, 25, 50, 75, 99)
    spread = per_device.groupBy("model").agg(
        F.avg("share").alias("avg_share"),
        F.min("share").alias("min_share"),
        F.max("share").alias("max_share"),
        F.percentile_approx("share", [p / 100 for p in percents], accuracy).alias("_cuts"),
        # (sn, model) is unique here, so the distinct count is a plain count.
        F.count("sn").alias("devices"),
    )
    return spread.withColumns({f"p{p}": F.col("_cuts")[k] for k, p in enumerate(percents)}).drop("_cuts")
