"""The daily, hourly and feature jobs: read the inputs of a date, score, write, and backfill.

The caller names every location and, where a source uses other column names, the mapping. Dates are
arguments; nothing depends on the clock. Each job stores its typed heartbeats or feature table once
and lets the later steps read the stored columns they need.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkscore import params as P
from linkscore.operators import availability as A
from linkscore.operators import capacity as K
from linkscore.operators import customers as L
from linkscore.operators import features as X
from linkscore.operators import overall as O
from linkscore.operators import scaling as S
from linkscore.operators import throughput as T
from linkscore.sources import heartbeat as H
from linkscore.sources import readers as R
from linkscore.sources import sinks as W
from linkscore.sources.manifests import Publication, Slot

BY_UPTIME = ("service_uptime", "ts", "event_id")


@dataclass(frozen=True)
class Locations:
    """Where the inputs are. An optional input may be missing on a date or as a whole."""

    heartbeats: str  # Parquet, date=yyyymmdd[/hour=HH]: row key, time in ms, payload, modem event
    customers: str  # CSV tree in one folder per date
    serials: str  # CSV: mdn, sn
    passive: str  # CSV, datadate=yyyy-mm-dd
    output: str
    speedtests: str | None = None  # Parquet, one folder per date
    places: str | None = None  # Parquet tree: sn, state, county, latitude, longitude
    device_groups: str | None = None  # Parquet, date=yyyymmdd: row key, firmware
    flat_heartbeats: str | None = None  # CSV, date=yyyy-mm-dd, payload fields as columns
    second_heartbeats: str | None = None  # JSON tree, dt=yyyy-mm-dd
    second_customers: str | None = None  # CSV
    usage: str | None = None  # CSV, one folder per date
    nr_time: str | None = None  # gzip CSV, dt=yyyy-mm-dd
    resets: str | None = None  # CSV, date=yyyy-mm-dd
    routers: str | None = None  # CSV, one folder per date
    second_label: str = "second"
    # Input name -> {source column: engine column}; an input without an entry has engine names.
    columns: Mapping[str, Mapping[str, str]] = field(default_factory=dict)

    def named(self, source: str, df: DataFrame) -> DataFrame:
        return R.renamed(df, self.columns[source]) if source in self.columns else df

    def day(self, kind: str, date: dt.date) -> str:
        return f"{self.output}/{kind}/{date.isoformat()}"

    def slot(self, job: str, date: dt.date, kinds: Sequence[str], required: Sequence[str] = ()) -> Slot:
        """The tables of a job's run over a date."""
        return Slot(self.output, job, date.isoformat(), {k: self.day(k, date) for k in kinds}, tuple(required))


def _lines(spark: SparkSession, at: Locations, as_of: dt.date) -> DataFrame:
    customers = R.newest_folder(lambda p: R.read_csv_tree(spark, p), at.customers, as_of)
    serials = R.read_csv(spark, at.serials)
    return L.customer_line(at.named("customers", customers), at.named("serials", serials))


def _speeds(spark: SparkSession, at: Locations, date: dt.date, days: int = 3) -> DataFrame:
    """Mean passive speed over the ``days`` dates before ``date``; a missing date adds nothing."""
    schema = "imsi string, dl_speed double"

    def one(path: str) -> DataFrame:
        rows = at.named("passive", R.read_csv(spark, path)).select("imsi", "dl_speed")
        return H.cast_columns(rows, {"dl_speed": "double"})

    before = [date - dt.timedelta(days=d) for d in range(1, days + 1)]
    paths = R.dated_paths(at.passive, before, "datadate")
    return T.passive_mean(R.union_all([R.optional_input(spark, lambda p=p: one(p), schema) for p in paths]))


def _tests(spark: SparkSession, at: Locations, date: dt.date) -> DataFrame:
    schema = "mdn string, download_result double, upload_result double, latency double, progress int"
    if at.speedtests is None:
        return spark.createDataFrame([], schema)
    path = f"{at.speedtests}/{date.isoformat()}"
    return R.optional_input(spark, lambda: at.named("speedtests", spark.read.parquet(path)), schema)


def _typed(
    spark: SparkSession, at: Locations, date: dt.date, hour: int | None, run: Publication, kind: str
) -> tuple[DataFrame, DataFrame]:
    """Typed heartbeats, staged as a table of the run and read back, and the raw rows they come from."""
    raw = at.named("heartbeats", R.read_day(spark, at.heartbeats, date, hour))
    return run.write(H.with_event_id(H.ingest_heartbeats(raw)), kind), raw


def run_day(spark: SparkSession, at: Locations, date: dt.date) -> None:
    """All scores of one date, the scores of the listed models, and the scores with location.

    The date's tables are published together once the last one is written.
    """
    with Publication(spark, day_outputs(at, date)) as run:
        heartbeats, _ = _typed(spark, at, date, None, run, "heartbeats")
        lines = run.write(_lines(spark, at, date), "lines")
        capacity = run.write(K.link_capacity(heartbeats, lines), "capacity")
        available = run.write(A.availability(heartbeats, order=BY_UPTIME), "availability")
        tests = T.speedtest_avg(_tests(spark, at, date))
        scores = O.overall_score(T.throughput(lines, _speeds(spark, at, date), tests), capacity, available)
        stored = run.write(scores, "all_score")
        run.write(stored, "model_score", lambda df, path: W.write_subset(df, path, "model", P.SUBSET_MODELS))
        if "score_location" in run.slot.places:
            next_day = date + dt.timedelta(days=1)
            groups = at.named("device_groups", R.read_day(spark, at.device_groups, next_day))
            firmware = groups.select(H.serial_number(F.col("rowkey")).alias("sn"), "firmware")
            places = at.named("places", R.read_parquet_tree(spark, at.places))
            known = places.select("sn", "state", "county", "latitude", "longitude")
            placed = O.enrich_location(stored.drop("imsi"), known, firmware)
            run.write(placed.withColumn("date", F.lit(date)), "score_location")


def day_outputs(at: Locations, date: dt.date) -> Slot:
    """The tables of :func:`run_day`; those for its users must be there for the date to be complete."""
    users = ["all_score", "model_score"]
    if at.places is not None and at.device_groups is not None:
        users.append("score_location")
    return at.slot("day", date, ["heartbeats", "lines", "capacity", "availability", *users], users)


def run_hour(spark: SparkSession, at: Locations, date: dt.date, hour: int, crash_join: str = "left") -> None:
    """Scores of one hour: passive throughput only, and modem crashes count as downtime."""
    with Publication(spark, hour_outputs(at, date, hour)) as run:
        heartbeats, raw = _typed(spark, at, date, hour, run, "hourly_heartbeats")
        lines = run.write(_lines(spark, at, date - dt.timedelta(days=1)), "hourly_lines")
        crashes = A.modem_crashes(H.modem_events(raw))
        available = A.availability(heartbeats, crashes=crashes, crash_join=crash_join, order=BY_UPTIME)
        scores = O.overall_score(
            T.throughput(lines, _speeds(spark, at, date), None),
            run.write(K.link_capacity(heartbeats, lines), "hourly_capacity"),
            run.write(available, "hourly_availability"),
        )
        run.write(scores, "hourly_score")


def hour_outputs(at: Locations, date: dt.date, hour: int) -> Slot:
    """The tables of :func:`run_hour`; the scores are a partition of one table of all hours."""
    name = f"{date.isoformat()}/{hour:02d}"
    places = {f"hourly_{k}": f"{at.output}/hourly_{k}/{name}" for k in ("heartbeats", "lines", "capacity", "availability")}
    places["hourly_score"] = f"{at.output}/hourly_score/date={date.isoformat()}/hr={hour:02d}"
    return Slot(at.output, "hour", name, places, ("hourly_score",))


def run_first_score(spark: SparkSession, at: Locations, date: dt.date) -> None:
    """The first cellular score of a date: flat heartbeats, peak speeds of the same day, older plan
    caps, no plan adjustment, and a mean of raw scores over lines that have all three parts."""
    day = date.isoformat()
    flat = R.read_csv(spark, f"{at.flat_heartbeats}/date={day}")
    typed = W.write_and_read(H.with_event_id(H.flat_heartbeats(flat)), at.day("first_heartbeats", date))
    customers = at.named("customers", R.read_csv_tree(spark, f"{at.customers}/{day}"))
    passive = at.named("passive", R.read_csv(spark, f"{at.passive}/datadate={day}"))
    peaks = T.passive_peak(
        L.feature_line(customers, P.KEPT_MODELS_FIRST), H.cast_columns(passive, {"dl_speed": "double"})
    )
    tests = T.speedtest_avg(_tests(spark, at, date))
    scores = O.overall_score_raw(
        T.with_throughput_score(T.with_speedtest(peaks, tests)),
        K.link_capacity_strict(typed),
        A.availability(typed, order=BY_UPTIME),
    )
    stored = W.write_and_read(scores, at.day("first_score", date))
    W.write_subset(stored, at.day("first_model_score", date), "model", P.SUBSET_MODELS)


def run_device_features(spark: SparkSession, at: Locations, date: dt.date, files: int = 10) -> None:
    """Features of every device of the first heartbeat source, in so many files; the folder must be new."""
    flat = R.read_csv(spark, f"{at.flat_heartbeats}/date={date.isoformat()}")
    typed = W.write_and_read(H.with_event_id(H.flat_heartbeats(flat)), at.day("flat_heartbeats", date))
    ids = ["sn", "imei", "mdn", "imsi", "model_name"]
    W.write_files(X.device_features(typed, ids), at.day("device_features", date), files, "errorifexists")


SECOND_FIELDS = {
    "imei": "string", "imsi": "string", "currentnetwork": "string", "brsrp": "string", "snr": "string",
    "cpe_5gsnr": "string", "time": "string",
}


def run_second_features(spark: SparkSession, at: Locations, date: dt.date, files: int = 10) -> None:
    """Features of the devices that only the second heartbeat source knows."""
    schema = ", ".join(f"`{n}` {t}" for n, t in SECOND_FIELDS.items())
    rows = R.read_json_tree(spark, f"{at.second_heartbeats}/dt={date.isoformat()}", schema)
    typed = H.with_event_id(
        rows.select(
            "imei",
            "imsi",
            F.col("time").alias("ts"),
            F.col("currentnetwork").alias("current_network"),
            H.typed(F.col("brsrp"), "double").alias("nr_rsrp"),
            H.typed(F.col("snr"), "double").alias("lte_snr"),
            H.typed(F.col("cpe_5gsnr"), "double").alias("nr_snr"),
        )
    )
    first = R.read_csv(spark, f"{at.flat_heartbeats}/date={date.isoformat()}")
    known = first.select(L.without_check_digit(F.col("IMEI")).alias("imei"), F.col("IMSI").alias("imsi"))
    W.write_files(X.second_source_features(typed, known), at.day("second_features", date), files)


def run_extract(
    spark: SparkSession, url: str, table: str, date: dt.date, options: Mapping[str, str], output: str
) -> None:
    """Land one day of speed tests from a database."""
    W.write_folder(R.read_jdbc_extract(spark, url, table, date, options), f"{output}/{date.isoformat()}")


def run_feature_table(spark: SparkSession, at: Locations, date: dt.date) -> None:
    """Join lines, usage, speed tests, device features and resets of one date."""
    day = date.isoformat()
    customers = at.named("customers", R.read_csv_tree(spark, f"{at.customers}/{day}"))
    lines = L.feature_line(customers)
    if at.second_customers is not None:
        second = at.named("second_customers", R.read_csv(spark, at.second_customers))
        lines = L.customer_union(lines, L.second_source_line(second, at.second_label))
    numbers = {"lte_total_mb": "double", "nr_total_mb": "double", "nr_usage_percentage": "double"}
    usage = X.usage_features(H.cast_columns(at.named("usage", R.read_csv(spark, f"{at.usage}/{day}")), numbers))
    nr_time = H.cast_columns(
        at.named("nr_time", R.read_csv(spark, f"{at.nr_time}/dt={day}")),
        {"percentage": "double", "hb_total": "bigint", "hb_5g": "bigint"},
    )
    first = spark.read.parquet(at.day("device_features", date))
    first = first.withColumn("imei", L.without_check_digit(F.col("imei")))
    both = X.align_union(X.first_source_features(first, nr_time), spark.read.parquet(at.day("second_features", date)))
    tests = at.named("speedtests", spark.read.parquet(f"{at.speedtests}/{day}"))
    routers = at.named("routers", R.read_csv(spark, f"{at.routers}/{day}"))
    resets = at.named("resets", R.read_csv(spark, f"{at.resets}/date={day}"))
    table = X.feature_join(lines, usage, tests, both, routers, resets)
    W.write_folder(X.plan_signal(table), at.day("features", date))


def run_feature_scores(
    spark: SparkSession,
    at: Locations,
    date: dt.date,
    history_days: int = 0,
    specs: Sequence[P.ScaleSpec] = P.SCALE_SPECS,
    files: int = 10,
) -> None:
    """Scale the stored features and score the groups.

    Percentiles come from the date itself, or from the last ``history_days`` stored dates.
    """
    features = spark.read.parquet(at.day("features", date))
    past = [date - dt.timedelta(days=d) for d in range(history_days)]
    history = R.read_dates(spark, f"{at.output}/features", past) if past else None
    scored = S.group_scores(S.scale(features, specs, history)).distinct()
    W.write_files(scored, at.day("final_score", date), files)


def backfill(
    spark: SparkSession,
    job: Callable[[dt.date], None],
    outputs: Callable[[dt.date], Slot | Sequence[str]],
    as_of: dt.date,
    n: int,
    workers: int = 1,
    retries: int = 0,
) -> DataFrame:
    """Run ``job`` for the last ``n`` dates up to ``as_of`` whose outputs are not complete.

    ``outputs`` gives a date's slot, which its manifest makes complete, or plain paths, which must
    exist. Dates are started oldest first, ``workers`` at a time, each in a scheduler pool of its own. A
    date that fails is tried again up to ``retries`` times, then reported, and the others run; the
    result has one row per date.
    """

    def complete(date: dt.date) -> bool:
        wanted = outputs(date)
        return wanted.complete(spark) if isinstance(wanted, Slot) else all(R.exists(spark, p) for p in wanted)

    def run(date: dt.date) -> tuple[dt.date, str, str | None]:
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", f"backfill-{date.isoformat()}")
        try:
            if complete(date):
                return date, "present", None
            for left in reversed(range(retries + 1)):
                try:
                    job(date)
                    return date, "written", None
                except Exception as e:  # any failure belongs to its date only
                    if not left:
                        return date, "failed", f"{type(e).__name__}: {e}"
        finally:
            spark.sparkContext.setLocalProperty("spark.scheduler.pool", None)

    dates = [as_of - dt.timedelta(days=back) for back in reversed(range(n))]
    with ThreadPoolExecutor(max_workers=workers) as pool:
        # A target of its own per date: the local properties of one are shared by all its calls.
        report = [f.result() for f in [pool.submit(inheritable_thread_target(spark)(run), d) for d in dates]]
    return spark.createDataFrame(report, "date date, status string, error string")
