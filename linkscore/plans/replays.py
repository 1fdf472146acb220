"""Work that goes through files: sources, sinks, backfill and streams, over the derived inputs.

Every run takes a new folder below the session's checkpoint folder, which all executors share; the
returned frames read from it, so it stays.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from linkscore.operators import availability as A
from linkscore.operators import counters as C
from linkscore.operators import customers as L
from linkscore.operators import distinct as D
from linkscore.operators.percentiles import daily_sketches
from linkscore.plans import jobs as J
from linkscore.plans.inputs import Inputs
from linkscore.sources import readers as R
from linkscore.sources import sinks as W
from linkscore.sources.manifests import Publication, Slot
from linkscore.sources.stored import checkpoint_folder
from linkscore.streaming import availability as SA
from linkscore.streaming import increments as SI

LANDED_DAY, LANDED_HOUR = dt.date(2024, 1, 10), 5
LANDED_WINDOW = dt.date(2024, 1, 4), dt.date(2024, 1, 28)
REWRITTEN_FROM = dt.date(2024, 1, 20)
BACKFILL_END, BACKFILL_DAYS = dt.date(2024, 1, 30), 5
#: A fault on the first run of a date: while its tables are staged, while they are published, or after.
STAGED_FAULT, PUBLISHED_FAULT, LOST_FILE = dt.date(2024, 1, 27), dt.date(2024, 1, 28), dt.date(2024, 1, 29)


def new_folder(spark: SparkSession) -> str:
    return f"{checkpoint_folder(spark)}/run-{uuid.uuid4().hex}"


# --- sources --------------------------------------------------------------------------------


def source_files(i: Inputs) -> DataFrame:
    """Rows of files in every layout the jobs read, with the source they came through."""
    base = new_folder(i.spark)
    fields = ["event_id", "sn", "snr", "memory", "network"]
    landed = i.flat.join(i.hb.select("event_id", "ts"), "event_id")
    day, hour = F.date_format("ts", "yyyyMMdd").alias("date"), F.date_format("ts", "HH").alias("hour")
    W.write_dates(landed.select(*fields, day), f"{base}/days")
    # Dates that land by the hour are read one at a time, so one of them does.
    by_hour = landed.where(F.to_date("ts") == F.lit(LANDED_DAY))
    W.write_dates(by_hour.select(*fields, day, hour), f"{base}/hours", ("date", "hour"))
    views = i.flat.where(F.col("network") == "view")
    rest = i.flat.where(F.coalesce(F.col("network") != "view", F.lit(True)))
    for df, place in ((views, "a"), (rest, "b/c")):
        df.write.option("header", True).csv(f"{base}/csv/{place}")
        df.write.option("header", True).option("compression", "gzip").csv(f"{base}/gzip/{place}")
        df.write.json(f"{base}/json/{place}")
    both = [f"{base}/csv/a", f"{base}/csv/b/c"]
    frames = {
        "day": R.read_day(i.spark, f"{base}/days", LANDED_DAY),
        "hour": R.read_day(i.spark, f"{base}/hours", LANDED_DAY, LANDED_HOUR),
        "csv": R.read_csv(i.spark, both[0]),
        "csv_tree": R.read_csv_tree(i.spark, f"{base}/csv"),
        "csv_paths": R.read_csv(i.spark, both, "event_id string, sn string, snr string, memory string, network string"),
        "gzip_tree": R.read_csv_tree(i.spark, f"{base}/gzip"),
        "json_tree": R.read_json_tree(i.spark, f"{base}/json", "event_id long, sn string, snr string, memory string, network string"),
    }
    named = [df.select(F.lit(n).alias("source"), F.col("event_id").cast("long"), *fields[1:]) for n, df in frames.items()]
    return R.union_all(named)


def rows_of_landed_dates(i: Inputs) -> DataFrame:
    """Heartbeats of the dates on which one feed landed, from a table with a folder per date."""
    base = new_folder(i.spark)
    W.write_dates(i.hb.select("event_id", "sn", "memory_percent_free", F.to_date("ts").alias("date")), base)
    feed = i.landed.join(i.landed.agg(F.min("dataset").alias("dataset")), "dataset", "left_semi")
    wanted = feed.select(F.col("part_date").alias("date"))
    return R.rows_of_dates(i.spark.read.parquet(base), "date", wanted, *LANDED_WINDOW)


def latest_partitioned(i: Inputs) -> DataFrame:
    """The newest date of passive measurements, from a table with a folder per date."""
    base = new_folder(i.spark)
    W.write_dates(i.passive, base, ("datadate",))
    return R.latest_available(i.spark.read.parquet(base), "datadate", LANDED_DAY).select(i.passive.columns)


# --- sinks ----------------------------------------------------------------------------------


def _crashes_by_hour(i: Inputs) -> DataFrame:
    events = i.modem_event.withColumns({"date": F.to_date("ts"), "hr": F.hour("ts")})
    return A.modem_crashes(events, ["sn", "date", "hr"])


def sink_roundtrip(i: Inputs) -> DataFrame:
    """Rows read back from every kind of write, after a second write over the first."""
    base, crashes = new_folder(i.spark), _crashes_by_hour(i)
    # The first write of the later dates is wrong; the second replaces their partitions only.
    late = F.col("date") >= F.lit(REWRITTEN_FROM)
    W.write_hours(crashes.withColumn("crashes", F.when(late, F.lit(-1)).otherwise(F.col("crashes"))), f"{base}/hours")
    W.write_hours(crashes.where(late), f"{base}/hours")
    speeds = i.passive.select("imsi", "device_model", "datadate", "o_orderkey")
    W.write_folder(speeds.limit(10), f"{base}/folder")
    again = W.write_and_read(speeds, f"{base}/folder")
    W.write_files(again, f"{base}/files", 3, "errorifexists")
    try:
        W.write_files(again, f"{base}/files", 3, "errorifexists")
        refused = False
    except AnalysisException as e:
        refused = e.getCondition() == "PATH_ALREADY_EXISTS"
    W.write_subset(again, f"{base}/subset", "device_model", ["M1"])

    def read(sink: str, sn: str, date: str, hr: Column, n: str) -> DataFrame:
        df = i.spark.read.parquet(f"{base}/{sink}")
        return df.select(
            F.lit(sink).alias("sink"), F.col(sn).alias("id"), F.col(date).cast("date").alias("date"), hr.cast("int").alias("hr"),
            F.col(n).cast("long").alias("n"), F.lit(len(df.inputFiles()) if sink == "files" else None).cast("int").alias("files"),
            F.lit(refused if sink == "files" else None).cast("boolean").alias("refused"),
        )

    none = F.lit(None)
    parts = [read(sink, "imsi", "datadate", none, "o_orderkey") for sink in ("folder", "files", "subset")]
    return R.union_all([read("hours", "sn", "date", F.col("hr"), "crashes"), *parts])


# --- backfill -------------------------------------------------------------------------------


class _Stopped(Publication):
    """A run that is stopped while its tables move to their places."""

    def _place(self, staged: str, folder: str) -> None:
        super()._place(staged, folder)
        raise RuntimeError("stopped")


def _replay_slot(base: str, date: dt.date) -> Slot:
    kinds = ("crashes", "switches")
    return Slot(base, "replay", date.isoformat(), {k: f"{base}/{k}/{date.isoformat()}" for k in kinds})


def backfill_replay(i: Inputs) -> DataFrame:
    """Two tables per date by a backfill that is stopped in three ways, run again, and run once more."""
    spark, base, broken = i.spark, new_folder(i.spark), set()

    def of(df: DataFrame, date: dt.date) -> DataFrame:
        return df.where(F.to_date("ts") == F.lit(date))

    def job(date: dt.date) -> None:
        fault, first = date not in broken, _Stopped if date == PUBLISHED_FAULT and date not in broken else Publication
        broken.add(date)
        with first(spark, _replay_slot(base, date)) as run:
            run.write(A.modem_crashes(of(i.modem_event, date)), "crashes")
            if fault and date == STAGED_FAULT:
                raise RuntimeError("stopped")
            run.write(C.network_switches(of(i.hb, date)), "switches")

    def run(workers: int) -> DataFrame:
        return J.backfill(spark, job, lambda d: _replay_slot(base, d), BACKFILL_END, BACKFILL_DAYS, workers)

    first = run(workers=2)
    lost = _replay_slot(base, LOST_FILE)
    files = Publication(spark, lost).files
    folder = lost.places["switches"]
    files.delete(f"{folder}/{min(files.sizes(folder))}")
    second, third = run(workers=1), run(workers=3)

    statuses = first.select("date", F.col("status").alias("first"))
    for name, df in (("second", second), ("third", third)):
        statuses = statuses.join(df.select("date", F.col("status").alias(name)), "date")
    dates = [BACKFILL_END - dt.timedelta(days=d) for d in range(BACKFILL_DAYS)]

    def published(kind: str) -> DataFrame:
        return R.union_all([_replay_slot(base, d).read(spark, kind).withColumn("date", F.lit(d)) for d in dates])

    both = published("crashes").join(published("switches"), ["sn", "date"], "full")
    return statuses.join(both, "date", "left").select("date", "sn", "crashes", "network_switches", "first", "second", "third")


# --- stored sketches ------------------------------------------------------------------------


def stored_sketches(df: DataFrame, columns: list[str], by: list[str], date: str, dates: list[dt.date]) -> DataFrame:
    """The daily sketches of some dates, read back from a table that holds those of all dates."""
    path = f"{new_folder(df.sparkSession)}/sketches"
    W.write_dates(daily_sketches(df, columns, by, date), path, (date,))
    return R.multi_date_union(df.sparkSession.read.parquet(path), date, dates)


def stored_distinct(df: DataFrame, value: str, by: list[str], date: str) -> DataFrame:
    """The daily distinct sketches, read back from the table that holds them."""
    path = f"{new_folder(df.sparkSession)}/distinct"
    W.write_dates(D.daily_distinct(df, value, by, date), path, (date,))
    return df.sparkSession.read.parquet(path)


# --- streams --------------------------------------------------------------------------------


def _arrivals(df: DataFrame, days: int, last: int, late: Column) -> DataFrame:
    """Rows with the number of the landing they come in: ``days`` at a time, late ones with the next."""
    number = F.least(F.floor((F.dayofmonth("ts") - 1) / days) + F.when(late, 1).otherwise(0), F.lit(last))
    return df.withColumn("arrival", number.cast("int"))


def stream_increments(i: Inputs) -> DataFrame:
    """Increments by time from a stream that gets the heartbeats in three landings, shuffled and some
    late, and is started anew from its checkpoint for each."""
    base, spark = new_folder(i.spark), i.spark
    hb = i.hb.select("sn", F.col("ts").cast("timestamp").alias("ts"), "event_id", *C.FAILURE_COUNTERS)
    landings = _arrivals(hb, 11, 2, F.pmod(F.xxhash64("event_id"), F.lit(3)) == 0).repartition(2, F.xxhash64("event_id", "sn"))
    W.write_dates(landings, f"{base}/landings", ("arrival",))
    for number in range(3):
        one = spark.read.parquet(f"{base}/landings").where(F.col("arrival") == number).drop("arrival")
        one.write.mode("append").parquet(f"{base}/in")
        totals = SI.counter_totals(spark.readStream.schema(hb.schema).parquet(f"{base}/in"), lateness="12 days")
        SI.write_totals(totals, f"{base}/out", f"{base}/checkpoint").awaitTermination()
    newest = SI.latest_totals(spark, f"{base}/out", totals.schema)
    return newest.drop("waiting").withColumnRenamed("rows", "heartbeats")


def stream_hourly_availability(i: Inputs) -> DataFrame:
    """Hourly availability with the lines of each device, kept by micro-batches; the last is run twice."""
    base, spark = new_folder(i.spark), i.spark
    events = i.modem_event.where(F.col("modem_event").isNotNull()).select("sn", "ts", "event_id", "modem_event")
    wanted = ["sn", "ts", "event_id", "service_uptime", "service_downtime", *C.FAILURE_COUNTERS]
    rows = i.hb.select(*wanted, F.lit(None).cast("string").alias("modem_event")).unionByName(events, allowMissingColumns=True)
    lines = L.customer_line(i.cust, i.sn_map).groupBy("sn").agg(F.count("*").alias("lines"))
    landings = _arrivals(rows, 11, 2, F.pmod(F.xxhash64("event_id"), F.lit(10)) == 0)
    W.write_dates(landings, f"{base}/landings", ("arrival",))
    for number in range(3):
        one = spark.read.parquet(f"{base}/landings").where(F.col("arrival") == number).drop("arrival")
        one.write.mode("append").parquet(f"{base}/in")
        stream = spark.readStream.schema(rows.schema).parquet(f"{base}/in")
        SA.write_scores(stream, base, f"{base}/checkpoint", lines).awaitTermination()
    SA.batch_writer(base, lines)(one, 2)
    return spark.read.parquet(f"{base}/scores")
