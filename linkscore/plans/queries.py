"""The registered queries: each builds a frame from the tables of one folder."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkscore import params as P
from linkscore.functions import columns as E
from linkscore.operators import availability as A
from linkscore.operators import capacity as K
from linkscore.operators import counters as C
from linkscore.operators import customers as L
from linkscore.operators import distinct as D
from linkscore.operators import features as X
from linkscore.operators import overall as O
from linkscore.operators import quality as Q
from linkscore.operators import scaling as S
from linkscore.operators import throughput as T
from linkscore.plans import replays as Y
from linkscore.plans.inputs import Inputs
from linkscore.sources import heartbeat as H
from linkscore.sources import readers as R
from linkscore.sources.stored import stored

AS_OF = dt.date(2024, 2, 1)
PASSIVE_DATE = dt.date(2024, 1, 11)
SECOND_LABEL = "second"
WEEK = 7

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(build: Callable[[Inputs], DataFrame]) -> Callable[[Inputs], DataFrame]:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return build(Inputs(spark, folder))

    QUERIES[build.__name__] = run
    return build


def rounded(df: DataFrame, digits: int, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c), digits) for c in columns})


# --- ingest ---------------------------------------------------------------------------------


@query
def ingest_heartbeat(i: Inputs) -> DataFrame:
    return H.ingest_heartbeats(i.raw).withColumn("ts_ms", F.unix_millis("ts")).drop("ts")


@query
def json_extract(i: Inputs) -> DataFrame:
    # One parse of a payload gives all its fields.
    fields = F.json_tuple("payload", "SNR", "5GSNR", "CurrentNetwork").alias("snr", "nr_snr", "network")
    found = i.raw.where(F.col("payload").isNotNull()).select("event_id", F.substring("rowkey", 6, 12).alias("sn"), fields)
    return found.withColumns({c: F.col(c).try_cast("double") for c in ("snr", "nr_snr")})


@query
def json_extract_variant(i: Inputs) -> DataFrame:
    rows = i.raw.select("event_id", F.substring("rowkey", 6, 12).alias("sn"), "payload")
    found = H.payload_texts(rows, {"snr": "SNR", "nr_snr": "5GSNR", "network": "CurrentNetwork"})
    return found.withColumns({c: F.col(c).try_cast("double") for c in ("snr", "nr_snr")})


@query
def payload_fields(i: Inputs) -> DataFrame:
    return H.payload_fields(i.raw)


@query
def cast_columns(i: Inputs) -> DataFrame:
    return H.cast_columns(i.flat, {"snr": "double", "memory": "double"})


@query
def dedup(i: Inputs) -> DataFrame:
    return i.hb.select("sn", "lte_pcc_band", "lte_scc1_band", "nr_pcc_band", "nr_scc1_band").distinct()


@query
def plan_caps(i: Inputs) -> DataFrame:
    return L.lines_per_plan(i.cust, K.plan_cap_table(i.spark))


@query
def customer_line(i: Inputs) -> DataFrame:
    return L.customer_line(i.cust, i.sn_map)


@query
def customer_union(i: Inputs) -> DataFrame:
    return L.customer_union(L.feature_line(i.cust), L.second_source_line(i.cust2, SECOND_LABEL))


@query
def model_bucket(i: Inputs) -> DataFrame:
    return L.feature_line(i.cust).groupBy("model").agg(F.count("*").alias("lines"))


@query
def latest_available(i: Inputs) -> DataFrame:
    return R.latest_available(i.passive, "datadate", PASSIVE_DATE)


@query
def multi_date_union(i: Inputs) -> DataFrame:
    dates = [PASSIVE_DATE - dt.timedelta(days=d) for d in range(12)]
    return R.multi_date_union(i.passive, "datadate", dates)


@query
def date_fold(i: Inputs) -> DataFrame:
    return R.union_all([R.multi_date_union(i.passive, "datadate", [dt.date(2024, 1, d)]) for d in range(3, 7)])


@query
def optional_input(i: Inputs) -> DataFrame:
    absent = R.optional_input(
        i.spark, lambda: i.table("no_such_input"), "imsi string, datadate date, dl_speed double"
    )
    return T.passive_throughput(L.customer_line(i.cust, i.sn_map), T.passive_mean(absent)).select(
        "sn", "mdn", "pplan_cd", "dl_cap", "dl_speed", "passive_score"
    )


def _first_source(i: Inputs) -> DataFrame:
    known = i.hb.join(i.first_ids, ["imei", "imsi"], "left_semi")
    return X.first_source_features(X.device_features(known, ["sn", "imei", "imsi"]), i.nr_time)


def _both_sources(i: Inputs) -> DataFrame:
    return X.align_union(_first_source(i), X.second_source_features(i.hb, i.first_ids))


@query
def align_union(i: Inputs) -> DataFrame:
    return rounded(_both_sources(i), 4, *X.FIRST_SOURCE_COLUMNS[2:], "nr_uptime")


@query
def second_source_only(i: Inputs) -> DataFrame:
    new = X.second_source_features(i.hb, i.first_ids)
    return rounded(new, 6, "db_nr_rsrp", "db_nr_snr", "db_lte_snr")


@query
def landed_extract(i: Inputs) -> DataFrame:
    return R.landed_extract(i.speedtest, dt.date(2024, 1, 1), days=10).select(
        "o_orderkey", "mdn", "created_at", "download_result", "upload_result", "latency"
    )


# --- counters -------------------------------------------------------------------------------


@query
def counter_increments(i: Inputs) -> DataFrame:
    return C.counter_increments(i.hb)


@query
def counter_resets(i: Inputs) -> DataFrame:
    return C.counter_resets(i.hb, top=20)


@query
def network_switches(i: Inputs) -> DataFrame:
    return C.network_switches(i.hb)


@query
def uptime_stalls(i: Inputs) -> DataFrame:
    return C.uptime_stalls(i.hb)


@query
def running_changes(i: Inputs) -> DataFrame:
    return C.running_changes(i.hb_timed)


@query
def failure_ratios(i: Inputs) -> DataFrame:
    return rounded(C.failure_ratios(i.hb), 8, *C.FAILURE_PAIRS)


@query
def device_timeline(i: Inputs) -> DataFrame:
    return C.device_timeline(i.hb, ["service_downtime", "service_uptime", "current_network"])


@query
def one_device_timeline(i: Inputs) -> DataFrame:
    return C.device_timeline(i.hb, ["service_downtime"], "SN0000000007")


# --- scores ---------------------------------------------------------------------------------

AVAILABILITY_COLUMNS = [
    *[f"sum_{c}" for c in C.FAILURE_COUNTERS], "downtime_changes", "uptime_changes", "downtime_share",
    "assumed_downtime", "not_available_pct", "availability_score", "availability_category",
]


@query
def availability(i: Inputs) -> DataFrame:
    scored = A.availability(i.hb).select("sn", *AVAILABILITY_COLUMNS)
    return rounded(scored, 6, "downtime_share", "assumed_downtime", "not_available_pct")


def _by_hour(df: DataFrame) -> DataFrame:
    return df.withColumn("date", F.to_date("ts")).withColumn("hr", F.hour("ts"))


@query
def modem_crashes(i: Inputs) -> DataFrame:
    return A.modem_crashes(_by_hour(i.modem_event), ["sn", "date", "hr"])


@query
def hourly_availability(i: Inputs) -> DataFrame:
    keys = ["sn", "date", "hr"]
    crashes = A.modem_crashes(_by_hour(i.modem_event), keys)
    scored = A.availability(_by_hour(i.hb), crashes=crashes, keys=keys)
    return rounded(
        scored.select(*keys, "crashes", *AVAILABILITY_COLUMNS), 6, "downtime_share", "assumed_downtime", "not_available_pct"
    )


@query
def crash_inner(i: Inputs) -> DataFrame:
    keys = ["sn", "date", "hr"]
    crashes = A.modem_crashes(_by_hour(i.modem_event), keys)
    scored = A.availability(_by_hour(i.hb), crashes=crashes, crash_join="inner", keys=keys)
    return rounded(
        scored.select(*keys, "crashes", *AVAILABILITY_COLUMNS), 6, "downtime_share", "assumed_downtime", "not_available_pct"
    )


def _lines(i: Inputs) -> DataFrame:
    return L.customer_line(i.cust, i.sn_map)


@query
def link_capacity(i: Inputs) -> DataFrame:
    return K.link_capacity(i.hb, _lines(i))


@query
def link_capacity_known(i: Inputs) -> DataFrame:
    return K.link_capacity(i.hb, _lines(i), known_only=True)


@query
def link_capacity_strict(i: Inputs) -> DataFrame:
    return K.link_capacity_strict(i.hb)


@query
def passive_throughput(i: Inputs) -> DataFrame:
    scored = T.passive_throughput(_lines(i), T.passive_mean(i.passive, PASSIVE_DATE))
    return rounded(scored.select("sn", "mdn", "dl_cap", "dl_speed", "passive_score"), 6, "dl_speed")


@query
def passive_peak(i: Inputs) -> DataFrame:
    peak = T.passive_peak(L.feature_line(i.cust, P.KEPT_MODELS_FIRST), i.passive)
    return peak.select("imsi", "mdn", "model", "device_model", "pplan_cd", "dl_cap", "ul_cap", "dl_speed", "passive_score")


@query
def speedtest_avg(i: Inputs) -> DataFrame:
    return rounded(T.speedtest_avg(i.speedtest_odd), 6, "download_result", "upload_result")


def _throughput(i: Inputs) -> DataFrame:
    return T.throughput(_lines(i), T.passive_mean(i.passive, PASSIVE_DATE), T.speedtest_avg(i.speedtest))


@query
def throughput_score(i: Inputs) -> DataFrame:
    return _throughput(i).select(
        "sn", "mdn", "passive_score", "download_score", "upload_score", "throughput_score", "throughput_category"
    )


@query
def hourly_throughput(i: Inputs) -> DataFrame:
    return T.throughput(_lines(i), T.passive_mean(i.passive, PASSIVE_DATE), None).select(
        "sn", "mdn", "passive_score", "throughput_score", "throughput_category"
    )


@query
def weighted_mean(i: Inputs) -> DataFrame:
    mean = E.weighted_mean({"passive_score": 1, "download_score": 2, "upload_score": 5})
    return _throughput(i).select("sn", "mdn", F.round(mean, 4).alias("mean"))


@query
def score_categories(i: Inputs) -> DataFrame:
    scores = T.with_speedtest(
        T.passive_throughput(_lines(i), T.passive_mean(i.passive, PASSIVE_DATE)), T.speedtest_avg(i.speedtest)
    )
    download, passive = F.col("download_score"), F.col("passive_score")
    named = scores.select(
        "sn",
        "mdn",
        E.category(download, P.THROUGHPUT_LADDER).alias("as_throughput"),
        E.category(passive, P.CAPACITY_LADDER).alias("as_capacity"),
        E.category(passive, P.AVAILABILITY_LADDER).alias("as_availability"),
    )
    mean = (E.category_number(F.col("as_throughput")) + E.category_number(F.col("as_capacity"))) / F.lit(2.0)
    return named.withColumn("number", E.category_number(F.col("as_availability"))).withColumn(
        "of_mean", E.number_category(mean)
    )


def _overall(i: Inputs) -> DataFrame:
    return O.overall_score(_throughput(i), K.link_capacity(i.hb, _lines(i)), A.availability(i.hb))


OVERALL_COLUMNS = [
    "sn", "mdn", "model", "throughput_score", "capacity_score", "availability_score", "throughput_number",
    "capacity_number", "availability_number", "score", "score_category",
]


@query
def overall_score(i: Inputs) -> DataFrame:
    return _overall(i).select(*OVERALL_COLUMNS)


@query
def overall_score_raw(i: Inputs) -> DataFrame:
    peak = T.passive_peak(L.feature_line(i.cust, P.KEPT_MODELS_FIRST), i.passive)
    scored = T.with_throughput_score(T.with_speedtest(peak, T.speedtest_avg(i.speedtest)))
    raw = O.overall_score_raw(scored, K.link_capacity_strict(i.hb), A.availability(i.hb))
    return raw.select("sn", "imsi", "mdn", "model", "device_model", *[f"{p}_score" for p in O.PARTS], "score")


@query
def model_subset(i: Inputs) -> DataFrame:
    return O.model_subset(_overall(i)).select(*OVERALL_COLUMNS)


@query
def enrich_location(i: Inputs) -> DataFrame:
    scores = _overall(i).select("sn", "mdn", "score", "score_category")
    return O.enrich_location(scores, i.location, i.firmware)


@query
def newest_firmware(i: Inputs) -> DataFrame:
    return O.enrich_location(_lines(i).select("sn", "mdn"), i.location, i.firmware, newest_only=True)


# --- features -------------------------------------------------------------------------------

SIGNAL_MEANS = X.SIGNAL_MEANS


@query
def signal_average(i: Inputs) -> DataFrame:
    return rounded(X.signal_average(i.hb).select("sn", *SIGNAL_MEANS, "received"), 6, *SIGNAL_MEANS)


@query
def network_share(i: Inputs) -> DataFrame:
    return X.signal_average(i.hb).select(
        "sn", "channel_records", "nr_records", "lte_records", "nr_share", "lte_share"
    )


@query
def received_share(i: Inputs) -> DataFrame:
    return X.signal_average(i.hb).select("sn", "received", "received_share")


DEVICE_FEATURES = [
    "downtime_changes", "uptime_changes", "downtime_share", "network_switches", *C.FAILURE_PAIRS, *SIGNAL_MEANS,
    "nr_share", "lte_share", "received_share",
]


@query
def device_features(i: Inputs) -> DataFrame:
    features = X.device_features(i.hb).select("sn", "imsi", *DEVICE_FEATURES)
    return rounded(features, 6, "downtime_share", *C.FAILURE_PAIRS, *SIGNAL_MEANS)


@query
def usage_features(i: Inputs) -> DataFrame:
    return rounded(X.usage_features(i.usage), 6, "data_usage", "sqrt_data_usage")


@query
def reset_counts(i: Inputs) -> DataFrame:
    return X.with_reset_counts(i.sn_map, i.reset_log)


def _router_map(i: Inputs) -> DataFrame:
    return L.feature_line(i.cust).select("imei", "mdn").join(i.sn_map, "mdn").select("imei", "sn")


def _feature_table(i: Inputs) -> DataFrame:
    lines = L.customer_union(L.feature_line(i.cust), L.second_source_line(i.cust2, SECOND_LABEL))
    table = X.feature_join(
        lines, X.usage_features(i.usage), i.speedtest, _both_sources(i), _router_map(i), i.reset_log
    )
    return X.plan_signal(table)


FEATURE_COLUMNS = [
    "sn", "mdn", "model", "pplan_cd", "data_usage", "sqrt_data_usage", "nr_usage_percentage", "download_result",
    "upload_result", "latency", "downtime_share", "network_switches", "received_share", "avg_cqi",
    "avg_memory_free", "nr_uptime", *C.FAILURE_PAIRS, "reset_count", "rsrp", "snr", *X.NR_TIME_COLUMNS, "cust_id",
    "ecpd_profile_id",
]


@query
def feature_join(i: Inputs) -> DataFrame:
    table = _feature_table(i).select(*FEATURE_COLUMNS)
    return rounded(table, 4, "data_usage", "sqrt_data_usage", "downtime_share", "nr_uptime", "rsrp", "snr")


@query
def plan_signal(i: Inputs) -> DataFrame:
    signals = X.signal_average(i.hb).join(_lines(i), "sn")
    return rounded(X.plan_signal(signals).select("sn", "mdn", "pplan_cd", "rsrp", "snr"), 6, "rsrp", "snr")


# --- scaling --------------------------------------------------------------------------------


def _line_tests(i: Inputs) -> DataFrame:
    return i.speedtest.join(L.feature_line(i.cust).select("mdn", "model", "pplan_cd"), "mdn").select(
        "o_orderkey", "mdn", "model", "pplan_cd", "download_result", "upload_result", "latency"
    )


@query
def percentile_by_group(i: Inputs) -> DataFrame:
    return S.percentile_by_group(_line_tests(i), ["download_result", "latency"], ["model"])


@query
def scale_percentile(i: Inputs) -> DataFrame:
    by = P.MODEL_AND_PLAN
    specs = [
        P.ScaleSpec("download_result"),
        P.ScaleSpec("upload_result", by=by),
        P.ScaleSpec("latency", by=by, reverse=True),
    ]
    return S.scale(_line_tests(i), specs).select(
        "o_orderkey", "scaled_download_result", "scaled_upload_result", "scaled_latency"
    )


@query
def scale_percentile_hist(i: Inputs) -> DataFrame:
    last_days = [PASSIVE_DATE - dt.timedelta(days=d) for d in range(1, 6)]
    history = R.multi_date_union(i.passive, "datadate", last_days)
    specs = [P.ScaleSpec("dl_speed", by=("device_model",), middle=60.0)]
    return S.scale(i.passive, specs, history).select("o_orderkey", "datadate", "scaled_dl_speed")


@query
def scale_percentile_stored(i: Inputs) -> DataFrame:
    last_days = [PASSIVE_DATE - dt.timedelta(days=d) for d in range(1, 6)]
    history = R.multi_date_union(i.passive, "datadate", last_days)
    sketches = Y.stored_sketches(i.passive, ["dl_speed"], ["device_model"], "datadate", last_days)
    specs = [P.ScaleSpec("dl_speed", by=("device_model",), middle=60.0)]
    scaled = S.scale(i.passive, specs, history, history_sketches=sketches)
    return scaled.select("o_orderkey", "datadate", "scaled_dl_speed")


@query
def scale_manual(i: Inputs) -> DataFrame:
    specs = [
        P.ScaleSpec("download_result", how="manual", thresholds=P.DOWNLOAD_THRESHOLDS),
        P.ScaleSpec("upload_result", how="manual", thresholds=P.UPLOAD_THRESHOLDS),
    ]
    return S.scale(_line_tests(i), specs).select("o_orderkey", "scaled_download_result", "scaled_upload_result")


@query
def scale_shift(i: Inputs) -> DataFrame:
    specs = [P.ScaleSpec("latency", how="shift"), P.ScaleSpec("download_result", how="shift", reverse=True)]
    return S.scale(_line_tests(i), specs).select("o_orderkey", "scaled_latency", "scaled_download_result")


@query
def scale_raw(i: Inputs) -> DataFrame:
    specs = [P.ScaleSpec("upload_result", how="raw"), P.ScaleSpec("latency", how="raw", reverse=True, factor=1.5)]
    return S.scale(_line_tests(i), specs).select("o_orderkey", "scaled_upload_result", "scaled_latency")


@query
def group_scores(i: Inputs) -> DataFrame:
    scaled = S.scale(stored(_feature_table(i)), P.SCALE_SPECS)
    return S.group_scores(scaled).select(
        "sn", "mdn", "pplan_cd", "download_result", "upload_result", "latency", *P.GROUP_WEIGHTS, "final_score"
    )


# --- analysis and quality -------------------------------------------------------------------

SUMMARY_COLUMNS = ("lte_handover_attempt_count", "lte_handover_failure_count", "nr_scg_change_count", "memory_percent_free")


@query
def capacity_by_model(i: Inputs) -> DataFrame:
    shares = ["avg_share", "min_share", "max_share", "p10", "p25", "p50", "p75", "p99"]
    return rounded(K.capacity_by_model(i.hb), 6, *shares)


@query
def rolling_devices(i: Inputs) -> DataFrame:
    """Devices per model in each week, exactly, and whether the stored sketches' estimate is within its bound."""
    by = ["model_name"]
    days = i.hb.select("sn", "model_name", F.to_date("ts").alias("date"))
    estimates = D.rolling_estimates(Y.stored_distinct(days, "sn", by, "date"), by, "date", WEEK)
    both = D.rolling_counts(days, "sn", by, "date", WEEK).join(estimates, [*by, "end_date"], "full")
    near = F.abs(F.col("estimate") - F.col("exact")) <= D.error_bound() * F.col("exact")
    return both.select(*by, "end_date", F.col("exact").alias("devices"), near.alias("estimate_within_bound"))


@query
def column_summary(i: Inputs) -> DataFrame:
    return rounded(Q.column_summary(i.hb, SUMMARY_COLUMNS), 6, "value")


@query
def switch_summary(i: Inputs) -> DataFrame:
    return rounded(Q.column_summary(C.network_switches(i.hb), ["network_switches"]), 6, "value")


@query
def reset_summary(i: Inputs) -> DataFrame:
    return rounded(Q.column_summary(C.counter_resets(i.hb), ["resets"]), 6, "value")


@query
def latest_partition(i: Inputs) -> DataFrame:
    return Q.latest_partition(i.hb, "ts")


@query
def recent_partitions(i: Inputs) -> DataFrame:
    return Q.recent_partitions(i.hb, "ts", 7)


@query
def partition_freshness(i: Inputs) -> DataFrame:
    return Q.partition_freshness(i.landed, i.expected, AS_OF)


@query
def partition_gaps(i: Inputs) -> DataFrame:
    return Q.partition_gaps(i.landed, i.expected, AS_OF, 31, P.HOLIDAYS)


@query
def partition_outages(i: Inputs) -> DataFrame:
    return Q.partition_outages(i.landed, i.expected, AS_OF, 31, P.HOLIDAYS)


@query
def partition_report(i: Inputs) -> DataFrame:
    gaps = Q.partition_gaps(i.landed, i.expected, AS_OF, 31, P.HOLIDAYS)
    return Q.partition_report(Q.partition_freshness(i.landed, i.expected, AS_OF), gaps)


@query
def backfill_dates(i: Inputs) -> DataFrame:
    done = i.hb.select(F.to_date("ts").alias("part_date"))
    return Q.missing_dates(i.spark, done, AS_OF, 7)


# --- files and streams ----------------------------------------------------------------------


@query
def source_files(i: Inputs) -> DataFrame:
    return Y.source_files(i)


@query
def rows_of_landed_dates(i: Inputs) -> DataFrame:
    return Y.rows_of_landed_dates(i)


@query
def latest_partitioned(i: Inputs) -> DataFrame:
    return Y.latest_partitioned(i)


@query
def sink_roundtrip(i: Inputs) -> DataFrame:
    return Y.sink_roundtrip(i)


@query
def backfill_replay(i: Inputs) -> DataFrame:
    return Y.backfill_replay(i)


@query
def stream_increments(i: Inputs) -> DataFrame:
    return Y.stream_increments(i)


@query
def stream_hourly_availability(i: Inputs) -> DataFrame:
    scored = Y.stream_hourly_availability(i).select("sn", "date", "hr", "crashes", "lines", *AVAILABILITY_COLUMNS)
    return rounded(scored, 6, "downtime_share", "assumed_downtime", "not_available_pct")
