"""Hand-computed cases of the score operators."""

import pytest
from conftest import rows
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from linkscore import params as P
from linkscore.functions import columns as E
from linkscore.operators import availability as A
from linkscore.operators import capacity as K
from linkscore.operators import customers as L
from linkscore.operators import features as X
from linkscore.operators import overall as O
from linkscore.operators import throughput as T

HB = (
    "sn string, imsi string, event_id bigint, lte_snr double, nr_snr double, nr_earfcn_dl bigint, lte_pcc_band int, "
    "lte_scc1_band int, lte_scc2_band int, lte_scc3_band int, nr_pcc_band int, nr_scc1_band int"
)


def one(df):
    return df.collect()[0]


def test_weighted_mean_drops_nulls(spark):
    df = spark.createDataFrame([(80.0, 70.0, 90.0), (80.0, 70.0, None), (None, None, None)], "a double, c double, t double")
    got = [r[0] for r in df.select(E.weighted_mean({"a": 5, "c": 2, "t": 1})).collect()]
    assert got == [78.75, pytest.approx(540 / 7), None]


@settings(max_examples=10, deadline=None)
@given(st.lists(st.tuples(*[st.one_of(st.none(), st.floats(0, 100))] * 3), min_size=1, max_size=30))
def test_weighted_mean_lies_between_its_inputs(spark, data):
    df = spark.createDataFrame(data, "a double, b double, c double")
    for r in df.withColumn("m", E.weighted_mean({"a": 5, "b": 2, "c": 1})).collect():
        known = [v for v in (r.a, r.b, r.c) if v is not None]
        assert (r.m is None) == (not known)
        assert not known or min(known) - 1e-9 <= r.m <= max(known) + 1e-9


def test_category_edges(spark):
    df = spark.createDataFrame([(x,) for x in (100.0, 99.999, 99.77, 97.22, 97.21, None)], "x double")
    got = [r[0] for r in df.select(E.category(F.col("x"), P.AVAILABILITY_LADDER)).collect()]
    assert got == ["Excellent", "Good", "Good", "Fair", "Poor", None]
    df = spark.createDataFrame([(x,) for x in (1.49, 1.5, 2.5, 3.5, None)], "x double")
    got = [r[0] for r in df.select(E.number_category(F.col("x"))).collect()]
    assert got == ["Poor", "Fair", "Good", "Excellent", None]
    df = spark.createDataFrame([(x,) for x in ("Poor", "Fair", "Good", "Excellent", "?", None)], "x string")
    assert [r[0] for r in df.select(E.category_number(F.col("x"))).collect()] == [1, 2, 3, 4, None, None]


def test_round2_equals_round(spark):
    # Every thousandth has a half in its third digit somewhere; noise moves some of them off it.
    df = spark.range(-200_000, 200_000).select((F.col("id") / 1000).alias("x")).unionByName(
        spark.range(200_000).select((F.rand(3) * 400 - 100).alias("x"))
    ).unionByName(spark.range(100_000).select((F.col("id") * 0.005 + F.lit(1e-9)).alias("x")))
    assert df.where(E.round2(F.col("x")) != F.round("x", 2)).count() == 0
    assert spark.range(1).select(E.round2(F.lit(None).cast("double"))).first()[0] is None


def test_cband_branches(spark):
    cases = [
        (77, 77, 1, 160), (77, 77, None, 160), (77, 0, 646667, 100), (77, None, 653329, 100), (77, 0, 653330, 60),
        (77, 0, None, 0), (5, 77, 1, 80), (None, 77, 1, 0), (0, 0, 1, 0), (None, None, None, 0),
    ]
    data = [("s", "i", n, 1.0, 1.0, ch, 0, 0, 0, 0, p, s) for n, (p, s, ch, _) in enumerate(cases)]
    got = K.with_bandwidths(spark.createDataFrame(data, HB)).orderBy("event_id").collect()
    assert [r.cband_mhz for r in got] == [c[3] for c in cases]
    assert [r.nw_mhz for r in got][6:8] == [20, 0]


def test_record_capacity(spark):
    data = [
        ("s", "i", 1, 30.0, None, 640000, 13, 0, 5, 0, 77, 0),  # both carriers full; a null SNR counts as the best
        ("s", "i", 2, 0.0, 9.5, None, 13, 0, 0, 0, 5, 0),  # SNR 0 gives nothing
        ("s", "i", 3, -12.0, 10.0, None, 13, 0, 0, 0, 5, 0),  # one valid radio keeps the record
        ("s", "i", 4, 0.0, 0.0, None, 13, 0, 0, 0, 5, 0),  # no valid radio
        ("s", "i", 5, 10.0, 10.0, None, 0, 0, 0, 0, 0, 0),  # no bandwidth
    ]
    hb = spark.createDataFrame(data, HB)
    got = K.record_capacity(hb, ["event_id"], P.CapacityParams(), "any").orderBy("event_id").collect()
    assert [tuple(r) for r in got] == [
        (1, 40.0, 0.0, 48.0),
        (2, 0.0, 10.0, 0.0),
        (3, -0.49, 10.24, 0.0),
    ]
    strict = K.record_capacity(hb, ["event_id"], P.CapacityParams(null_snr="zero"), "all")
    assert strict.count() == 0
    zero = K.record_capacity(hb, ["event_id"], P.CapacityParams(null_snr="zero"), "any").where("event_id = 1")
    assert one(zero).cband_capacity == 0.0


def test_link_capacity_equals_the_record_level_join(inputs, spark):
    """Aggregating per adjustment before the join gives what joining every record would give."""
    lines = L.customer_line(inputs.cust, inputs.sn_map)
    # One device that serves two lines, one line with two devices, one plan outside the table.
    extra = lines.limit(3).withColumn("mdn", F.concat("mdn", F.lit("x"))).withColumn("pplan_cd", F.lit("46798"))
    lines = lines.unionByName(extra)
    records = K.record_capacity(inputs.hb, ["sn", "imsi"], P.CapacityParams(), "any")
    caps = K.plan_cap_table(spark).withColumn("a", F.least(F.col("dl_cap") / 150, F.lit(1.0)))
    total = F.col("lte_capacity") + F.col("nw_capacity") + F.col("cband_capacity")
    slow = (
        records.join(lines, ["sn", "imsi"])
        .join(caps, "pplan_cd")
        .withColumn("p", F.least(F.round(100 * (total / (218 * F.col("a"))), 2), F.lit(100.0)))
        .groupBy("sn", "mdn")
        .agg(F.round(F.avg(F.col("p").cast("decimal(9,2)")), 2).cast("double").alias("capacity_score"))
    )
    got = K.link_capacity(inputs.hb, lines)
    assert rows(got.select("sn", "mdn", "capacity_score")) == rows(slow)
    # A plan table with many distinct adjustments takes the same way.
    many = [(code, dl, ul) for code, dl, ul in P.PLAN_CAPS] + [(f"x{k}", 3 + k, 1) for k in range(40)]
    assert rows(K.link_capacity(inputs.hb, lines, many)) == rows(got)


def heartbeat_rows(spark, data):
    return spark.createDataFrame(
        data,
        "sn string, service_uptime bigint, event_id bigint, service_downtime bigint, lte_rach_failure_count bigint, "
        "lte_handover_failure_count bigint, nr_scg_change_failure_count bigint, rrc_connect_failure_count bigint",
    )


def test_availability(spark):
    data = [
        ("a", 1, 1, 0, 100, 0, 0, 0),
        ("a", 2, 2, 0, 150, 0, 0, 2),  # +50 and +2
        ("a", 3, 3, 1, 20, 0, 0, None),  # reset adds 20; one downtime change
        ("a", 4, 4, P.COUNTER_SENTINEL, 900, 0, 0, 9),  # left out
        ("b", 1, 1, 0, 0, 0, 0, 0),
        ("c", 1, 1, 0, 0, 0, 0, 90_000),
    ]
    got = {r.sn: r for r in A.availability(heartbeat_rows(spark, data)).collect()}
    a = got["a"]
    assert (a.sum_lte_rach_failure_count, a.sum_rrc_connect_failure_count, a.downtime_changes) == (170, 2, 1)
    assert a.assumed_downtime == pytest.approx(2 + 1.7 + 300)
    assert a.availability_score == round(100 - 20 * (303.7 / 864), 2) and a.availability_category == "Poor"
    assert a.downtime_share == pytest.approx(100 / 3)
    assert (got["b"].availability_score, got["b"].availability_category, got["b"].downtime_share) == (100.0, "Excellent", None)
    assert got["c"].availability_score == 0.0


def test_crash_joins(spark):
    hb = heartbeat_rows(spark, [("a", 1, 1, 0, 0, 0, 0, 0), ("b", 1, 1, 0, 0, 0, 0, 0)])
    events = spark.createDataFrame([("a", "x"), ("a", "y"), ("b", None)], "sn string, modem_event string")
    crashes = A.modem_crashes(events)
    left = {r.sn: r for r in A.availability(hb, crashes=crashes).collect()}
    assert left["a"].assumed_downtime == 180.0 and left["b"].crashes == 0
    assert [r.sn for r in A.availability(hb, crashes=crashes, crash_join="inner").collect()] == ["a"]


def test_throughput(spark):
    lines = spark.createDataFrame(
        [("s1", "1", "m1", "38365", "X"), ("s2", "2", "m2", "00000", "X"), ("s3", "3", "m3", "38365", "X")],
        "sn string, imsi string, mdn string, pplan_cd string, model string",
    )
    speeds = spark.createDataFrame([("1", 10.0), ("2", 10.0)], "imsi string, dl_speed double")
    tests = T.speedtest_avg(
        spark.createDataFrame(
            [("m1", 24.6, 3.2, 100), ("m1", 26.0, 2.9, 100), ("m1", 99.0, 9.0, 50), ("m1", 0.0, 9.0, 100), ("m1", None, 9.0, 100)],
            "mdn string, download_result double, upload_result double, progress int",
        )
    )
    got = {r.sn: r for r in T.throughput(lines, speeds, tests).collect()}
    s1 = got["s1"]
    assert (s1.passive_score, s1.download_score, s1.upload_score) == (40.0, 51.0, 50.0)
    assert s1.throughput_score == round((28 * 40 + 4 * 51 + 50) / 33, 2) and s1.throughput_category == "Fair"
    assert got["s2"].throughput_score is None and got["s2"].throughput_category is None
    assert got["s3"].throughput_score is None
    hourly = {r.sn: r for r in T.throughput(lines, speeds, None).collect()}
    assert hourly["s1"].throughput_score == 40.0


def test_overall_weights_category_numbers_of_existing_parts(spark):
    thr = spark.createDataFrame([("a", "m", "M", 85.0, "Excellent")], "sn string, mdn string, model string, throughput_score double, throughput_category string")
    cap = spark.createDataFrame([("a", "m", 55.0, "Good"), ("b", "n", 10.0, "Poor")], "sn string, mdn string, capacity_score double, capacity_category string")
    ava = spark.createDataFrame([("a", 98.0, "Fair"), ("c", 100.0, "Excellent")], "sn string, availability_score double, availability_category string")
    got = {r.sn: r for r in O.overall_score(thr, cap, ava).collect()}
    assert got["a"].score == 2.5 and got["a"].score_category == "Good"  # (5*2 + 2*3 + 1*4) / 8
    assert (got["b"].score, got["b"].score_category, got["b"].mdn) == (1.0, "Poor", "n")
    assert (got["c"].score, got["c"].score_category, got["c"].mdn) == (4.0, "Excellent", None)


def test_customer_line(spark):
    cust = spark.createDataFrame(
        [
            ("1", "m", "38365", "Home", " 5G Router WNC-CR200A ", "123456", "c", "e"),
            ("1", "m", "38365", "Home", "WNC-CR200A", "123456", "c", "e"),
            ("2", "n", "1", None, "ZZ9", "99", "d", None),
        ],
        "imsi string, mdn string, pplan_cd string, pplan_desc string, device_prod_nm string, imei_raw string, cust_id string, "
        "ecpd_profile_id string",
    )
    serials = spark.createDataFrame([("m", "s1"), ("m", "s2"), ("m", "s2"), ("x", "s3")], "mdn string, sn string")
    got = L.customer_line(cust, serials)
    assert rows(got.select("sn", "model")) == [("WNC-CR200A", "s1"), ("WNC-CR200A", "s2")]
    other = cust.withColumn("pplan_desc", F.col("device_prod_nm"))  # lines that differ in the description stay
    assert L.customer_line(other, serials).count() == 4
    feature = L.feature_line(cust)
    assert rows(feature.select("imei", "model")) == [("12345", "WNC-CR200A"), ("9", "Others")]


def test_align_union_keeps_the_first_schema(spark):
    first = spark.createDataFrame([("1", 2.0, "x")], "id string, a double, b string")
    second = spark.createDataFrame([("2", "y", 9), ("2", "y", 8)], "id string, b string, extra int")
    got = X.align_union(first, second)
    assert got.columns == ["id", "a", "b"]
    assert rows(got) == [(2.0, "x", "1"), (None, "y", "2")]


def test_reset_counts_fill_zero(spark):
    lines = spark.createDataFrame([("a",), ("b",), (None,)], "sn string")
    log = spark.createDataFrame([("a",), ("a",), ("z",)], "sn string")
    assert rows(X.with_reset_counts(lines, log)) == [(0, "b"), (0, None), (2, "a")]


def test_plan_signal(spark):
    df = spark.createDataFrame(
        [("50044", -80.0, -100.0, 10.0, 5.0), ("38365", -80.0, -100.0, 10.0, 5.0), ("99999", -80.0, -100.0, 10.0, None)],
        "pplan_cd string, db_nr_rsrp double, db_lte_rsrp double, db_nr_snr double, db_lte_snr double",
    )
    assert rows(X.plan_signal(df).select("rsrp", "snr")) == [(-100.0, 5.0), (-80.0, 10.0), (-90.0, None)]


def test_plans_are_consistent():
    codes = [c for c, _, _ in P.PLAN_CAPS]
    assert len(codes) == len(set(codes)) == 31 and len(P.PLAN_CAPS_FIRST) == 20
    assert set(P.DOWNLOAD_THRESHOLDS) == set(P.UPLOAD_THRESHOLDS) and len(P.DOWNLOAD_THRESHOLDS) == 28
    assert not set(P.NR_PLANS) & set(P.LTE_PLANS)
    for weights in P.GROUP_WEIGHTS.values():
        assert sum(weights.values()) == pytest.approx(1.0)


def test_nan_is_no_speed(spark):
    nan = float("nan")
    data = [("m", nan, 5.0, 100), ("m", 4.4, 2.0, 100), ("m", 5.0, nan, 100), ("n", nan, nan, 100), ("o", None, 1.0, 100)]
    tests = spark.createDataFrame(data, "mdn string, download_result double, upload_result double, progress int")
    assert rows(T.speedtest_avg(tests)) == [(4.0, "m", 2.0)]
    assert one(spark.sql("select double('NaN') as x").select(E.hundredths(F.col("x"))))[0] is None


def test_all_versions_or_the_newest(spark):
    scores = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3)], "sn string, score int")
    firmware = spark.createDataFrame([("a", "fw-9"), ("a", "fw-10"), ("a", "fw-9"), ("b", "1.2.10"), ("b", "1.10.2"), ("b", "none")], "sn string, firmware string")
    places = spark.createDataFrame([("a", "x"), ("a", "x")], "sn string, state string")
    every = O.enrich_location(scores, places, firmware)
    assert [r.firmware for r in every.orderBy("sn", "firmware").collect()] == ["fw-10", "fw-9", "1.10.2", "1.2.10", "none", None]
    newest = O.enrich_location(scores, places, firmware, newest_only=True)
    assert [r.firmware for r in newest.orderBy("sn").collect()] == ["fw-10", "1.10.2", None]
