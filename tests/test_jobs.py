"""The jobs end to end, on files written from the derived inputs."""

import datetime as dt
import pathlib

import pytest
from conftest import rows
from pyspark.sql import functions as F

from linkscore import params as P
from linkscore.operators import availability as A
from linkscore.operators import capacity as K
from linkscore.operators import customers as L
from linkscore.operators import features as X
from linkscore.operators import overall as O
from linkscore.operators import scaling as S
from linkscore.operators import throughput as T
from linkscore.plans import jobs as J
from linkscore.sources import heartbeat as H

DAY = dt.date(2024, 1, 10)
TEXT = {"5GEARFCN_DL", "SNR", "ServiceUptime", "ServiceDowntime"}


def millis():
    return F.unix_millis(F.col("ts").cast("timestamp"))


def payload(hb):
    """Heartbeats as raw rows: the typed columns back under their payload names."""
    fields = [
        (F.col(new).cast("string") if old in TEXT else F.col(new)).alias(old)
        for old, (new, _) in H.USED_FIELDS.items()
        if new in hb.columns
    ]
    # Count and band fields are whole numbers in the payload.
    whole = {"CQI", "4GRSRP"}
    fields = [F.col(H.USED_FIELDS[old][0]).cast("int").alias(old) if old in whole else f for old, f in
              zip([o for o, (n, _) in H.USED_FIELDS.items() if n in hb.columns], fields)]
    return hb.select(
        F.concat(F.lit("6223-"), "sn", F.lit("_MAC")).alias("rowkey"), millis().alias("ts"), F.to_json(F.struct(*fields)).alias("payload")
    )


@pytest.fixture(scope="module")
def world(spark, inputs, tmp_path_factory):
    base = str(tmp_path_factory.mktemp("world"))
    hb = inputs.hb
    events = inputs.modem_event.select(
        F.concat(F.lit("6223-"), "sn", F.lit("_MAC")).alias("rowkey"), millis().alias("ts"), F.lit(None).cast("string").alias("payload"), "modem_event"
    )
    raw = payload(hb).withColumn("modem_event", F.lit(None).cast("string"))
    raw = raw.unionByName(raw.limit(200)).unionByName(events)  # copies of some rows
    raw.write.parquet(f"{base}/hb/date=20240110/hour=05")
    csv = lambda df, path: df.coalesce(1).write.option("header", True).csv(f"{base}/{path}")
    csv(inputs.cust, "customers/2024-01-09/part")  # a day late, one folder deeper
    csv(inputs.sn_map, "serials")
    for day in (7, 8, 9):
        if day != 8:  # one date is missing
            csv(inputs.passive.where(F.dayofmonth("datadate") == day).select("imsi", "dl_speed"), f"passive/datadate=2024-01-{day:02d}")
    csv(inputs.passive.where(F.dayofmonth("datadate") == 10).select("imsi", "device_model", "dl_speed"), "passive/datadate=2024-01-10")
    inputs.speedtest.write.parquet(f"{base}/tests/2024-01-10")
    inputs.location.withColumns({"latitude": F.lit(1.0), "longitude": F.lit(2.0)}).write.parquet(f"{base}/places/x")
    inputs.firmware.select(F.concat(F.lit("6223-"), "sn", F.lit("_mac")).alias("rowkey"), "firmware").write.parquet(
        f"{base}/groups/date=20240111"
    )
    # First version: flat text heartbeats of the first source, JSON of the second.
    first = hb.join(inputs.first_ids, ["imei", "imsi"], "left_semi").withColumn("imei", F.concat("imei", F.lit("0")))
    names = {new: old for old, (new, _) in H.USED_FIELDS.items()}
    text = [F.col(c).cast("string").alias(names[c]) for c in first.columns if c in names]
    csv(first.select("sn", millis().cast("string").alias("ts"), *text), "flat/date=2024-01-10")
    hb.select(
        "imei", "imsi", F.col("current_network").alias("currentnetwork"), F.col("nr_rsrp").cast("string").alias("brsrp"),
        F.col("lte_snr").cast("string").alias("snr"), F.col("nr_snr").cast("string").alias("cpe_5gsnr"),
        F.col("ts").cast("string").alias("time"),
    ).write.json(f"{base}/second/dt=2024-01-10/deep")
    csv(inputs.cust, "customers/2024-01-10/part")
    csv(inputs.cust2, "second_customers")
    csv(inputs.usage, "usage/2024-01-10")
    inputs.nr_time.coalesce(1).write.option("header", True).option("compression", "gzip").csv(f"{base}/nr/dt=2024-01-10")
    csv(inputs.reset_log.select("sn"), "resets/date=2024-01-10")
    routers = L.feature_line(inputs.cust).select("imei", "mdn").join(inputs.sn_map, "mdn").select("imei", "sn")
    csv(routers, "routers/2024-01-10")
    return J.Locations(
        heartbeats=f"{base}/hb", customers=f"{base}/customers", serials=f"{base}/serials", passive=f"{base}/passive",
        output=f"{base}/out", speedtests=f"{base}/tests", places=f"{base}/places", device_groups=f"{base}/groups",
        flat_heartbeats=f"{base}/flat", second_heartbeats=f"{base}/second", second_customers=f"{base}/second_customers",
        usage=f"{base}/usage", nr_time=f"{base}/nr", resets=f"{base}/resets", routers=f"{base}/routers",
    )


def expected_scores(inputs, tests, crashes=None):
    lines = L.customer_line(inputs.cust, inputs.sn_map)
    speeds = T.passive_mean(inputs.passive.where(F.dayofmonth("datadate").isin(7, 9)))
    return O.overall_score(
        T.throughput(lines, speeds, tests), K.link_capacity(inputs.hb, lines), A.availability(inputs.hb, crashes=crashes)
    )


COLUMNS = ["sn", "mdn", "throughput_score", "capacity_score", "availability_score", "score", "score_category"]


def test_backfill_runs_the_day_once_and_isolates_failures(spark, inputs, world):
    run = lambda: J.backfill(spark, lambda d: J.run_day(spark, world, d), lambda d: J.day_outputs(world, d), DAY, 3)
    first = [tuple(r) for r in run().collect()]
    assert [(d.day, s) for d, s, _ in first] == [(8, "failed"), (9, "failed"), (10, "written")]
    assert "PATH_NOT_FOUND" in first[0][2] and first[2][2] is None

    got = spark.read.parquet(world.day("all_score", DAY))
    assert rows(got.select(COLUMNS)) == rows(expected_scores(inputs, T.speedtest_avg(inputs.speedtest)).select(COLUMNS))
    files = sorted(got.inputFiles())
    again = [r.status for r in run().collect()]
    assert again == ["failed", "failed", "present"]
    assert sorted(spark.read.parquet(world.day("all_score", DAY)).inputFiles()) == files

    # A date counts as present only when all its outputs exist.
    scores = pathlib.Path(world.day("model_score", DAY))
    scores.rename(scores.with_name("aside"))
    assert [r.status for r in run().collect()] == ["failed", "failed", "written"]

    got = spark.read.parquet(world.day("all_score", DAY))
    subset = spark.read.parquet(world.day("model_score", DAY))
    assert rows(subset.select(COLUMNS)) == rows(got.where(F.col("model").isin(*P.SUBSET_MODELS)).select(COLUMNS))
    placed = spark.read.parquet(world.day("score_location", DAY))
    versions = inputs.firmware.distinct()
    assert placed.count() == got.join(versions, "sn", "left").count() and {"state", "latitude", "firmware", "date"} <= set(placed.columns)
    assert placed.where("firmware is not null and state is not null").count() > 0


def test_hour(spark, inputs, world):
    J.run_hour(spark, world, DAY, 5)
    got = spark.read.parquet(f"{world.output}/hourly_score")
    crashes = A.modem_crashes(inputs.modem_event)
    assert rows(got.select(COLUMNS)) == rows(expected_scores(inputs, None, crashes).select(COLUMNS))
    assert {(r.date, r.hr) for r in got.select("date", "hr").distinct().collect()} == {(DAY, 5)}


def test_first_score(spark, inputs, world):
    J.run_first_score(spark, world, DAY)
    got = spark.read.parquet(world.day("first_score", DAY))
    known = inputs.hb.join(inputs.first_ids, ["imei", "imsi"], "left_semi")
    peaks = T.passive_peak(
        L.feature_line(inputs.cust, P.KEPT_MODELS_FIRST), inputs.passive.where(F.dayofmonth("datadate") == 10)
    )
    throughput = T.with_throughput_score(T.with_speedtest(peaks, T.speedtest_avg(inputs.speedtest)))
    expected = O.overall_score_raw(throughput, K.link_capacity_strict(known), A.availability(known))
    columns = ["sn", "imsi", "mdn", "model", "device_model", *[f"{p}_score" for p in O.PARTS], "score"]
    assert got.count() > 0 and rows(got.select(columns)) == rows(expected.select(columns))
    subset = spark.read.parquet(world.day("first_model_score", DAY))
    assert subset.count() == got.where(F.col("model").isin(*P.SUBSET_MODELS)).count()


def test_feature_pipeline(spark, inputs, world):
    J.run_device_features(spark, world, DAY)
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        J.run_device_features(spark, world, DAY)
    J.run_second_features(spark, world, DAY)
    J.run_feature_table(spark, world, DAY)
    J.run_feature_scores(spark, world, DAY)

    fixed = lambda df: df.select(*[F.round(c, 6).alias(c) if t == "double" else c for c, t in df.dtypes])
    known = inputs.hb.join(inputs.first_ids, ["imei", "imsi"], "left_semi")
    first = X.device_features(known, ["sn", "imei", "imsi"])
    devices = spark.read.parquet(world.day("device_features", DAY))
    keep = [c for c in first.columns if c != "imei"]
    assert rows(fixed(devices.select(keep))) == rows(fixed(first.select(keep)))
    second = X.second_source_features(inputs.hb, inputs.first_ids)
    assert rows(fixed(spark.read.parquet(world.day("second_features", DAY)))) == rows(fixed(second))

    both = X.align_union(X.first_source_features(first, inputs.nr_time), second)
    routers = L.feature_line(inputs.cust).select("imei", "mdn").join(inputs.sn_map, "mdn").select("imei", "sn")
    lines = L.customer_union(L.feature_line(inputs.cust), L.second_source_line(inputs.cust2, "second"))
    table = X.plan_signal(
        X.feature_join(lines, X.usage_features(inputs.usage), inputs.speedtest, both, routers, inputs.reset_log)
    )
    stored = spark.read.parquet(world.day("features", DAY))
    assert rows(fixed(stored)) == rows(fixed(table))
    scores = spark.read.parquet(world.day("final_score", DAY))
    expected = S.group_scores(S.scale(stored, P.SCALE_SPECS)).distinct()
    assert rows(fixed(scores)) == rows(fixed(expected))
    assert len(scores.inputFiles()) == 10
    assert scores.where("final_score between 0 and 100").count() == scores.count()

    # Percentiles of stored history: one date of history equals the date itself.
    J.run_feature_scores(spark, world, DAY, history_days=5)
    assert rows(fixed(spark.read.parquet(world.day("final_score", DAY)))) == rows(fixed(expected))
