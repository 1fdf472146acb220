"""Sums over consecutive rows: the same result however many slices a key is cut into."""

import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from linkscore import params as P
from linkscore.operators import availability as A
from linkscore.operators import counters as C
from linkscore.operators import features as X
from linkscore.operators import ordered as W
from linkscore.operators.ordered import SLICE, slice_of, sum_steps

SPANS = [1, 2, 3600]


def looped_increments(values):
    total, previous = 0, None
    for v in values:
        if previous is not None and v is not None and previous <= v:
            total += v - previous
        else:
            total += v or 0
        previous = v
    return total


@pytest.fixture(scope="module")
def skewed(spark):
    """One key with a third of the rows, a null key, nulls, resets and ties in the first order column."""
    rng = random.Random(7)
    data = []
    for event in range(1500):
        sn = rng.choices(["hot", "a", "b", "c", None], [5, 3, 3, 3, 1])[0]
        counter = None if rng.random() < 0.1 else rng.randrange(50)
        data.append((sn, rng.choice([0, 0, 0, 1, 2, 9]), event, counter, rng.choice("xyz-")))
    return data, spark.createDataFrame(data, "sn string, up bigint, event_id bigint, n bigint, net string")


@pytest.mark.parametrize("span", SPANS)
def test_increments_match_a_loop(skewed, span, monkeypatch):
    monkeypatch.setattr(W, "SLICE_SPAN", span)
    data, df = skewed
    groups = {"all": (["n"], None), "named": (["net"], F.col("net") != "-")}
    steps = {**C.increments_of(["n"], "all"), "changes": C.changes_of("net", "named")}
    sums = {"rows": F.lit(1)}
    got = sum_steps(df, ["sn"], ["up", "event_id"], groups, steps, sums).collect()
    assert len(got) == 5
    for r in got:
        mine = sorted((d for d in data if d[0] == r.sn), key=lambda d: (d[1], d[2]))
        nets = [d[4] for d in mine if d[4] != "-"]
        assert r.sum_n == looped_increments([d[3] for d in mine])
        assert r.changes == sum(a != b for a, b in zip(nets, nets[1:]))
        assert r.rows == len(mine)


def test_step_is_null_without_a_valid_row(spark):
    df = spark.createDataFrame([("a", 1, "-"), ("a", 2, "-"), ("b", 1, "x")], "sn string, t int, net string")
    got = sum_steps(df, ["sn"], ["t"], {"g": (["net"], F.col("net") != "-")}, {"n": C.changes_of("net", "g")})
    assert rows(got) == [(0, "b"), (None, "a")]


def test_slices_follow_the_order_and_cut_a_hot_key(spark, monkeypatch):
    monkeypatch.setattr(W, "SLICE_SPAN", 2)
    # Times, a null time and the sentinel many times over; the last column is a hash.
    events = [(k, (k * 0x9E3779B97F4A7C15) % 2**64 - 2**63) for k in range(300)]
    data = [(None if k % 3 == 0 else P.COUNTER_SENTINEL if k % 3 == 1 else k % 7, f"2024-01-0{k % 4 + 1} 0{k % 3}:00:00", h) for k, h in events]
    df = spark.createDataFrame(data, "up bigint, at string, event_id bigint")
    for order in (["up", "event_id"], ["up", "at", "event_id"], ["at", "event_id"], ["event_id"]):
        ordered = df.withColumn(SLICE, slice_of(df, order)).orderBy(*order)
        slices = [tuple(r[SLICE]) for r in ordered.collect()]
        seen = list(dict.fromkeys(slices))
        assert [s for k, s in enumerate(slices) if not k or s != slices[k - 1]] == seen  # contiguous
        assert [tuple(r[SLICE]) for r in ordered.select(SLICE).orderBy(SLICE).collect()] == slices  # growing
        assert max(slices.count(s) for s in seen) < 100


@pytest.mark.parametrize(
    "operator",
    [
        C.counter_increments, C.service_time, C.uptime_stalls, C.network_switches, C.failure_ratios, C.counter_resets,
        A.availability, X.device_features,
    ],
)
def test_slices_do_not_change_results(inputs, operator, monkeypatch):
    whole = operator(inputs.hb)
    floats = [c for c, t in whole.dtypes if t == "double"]
    fixed = lambda df: rows(df.withColumns({c: F.round(c, 8) for c in floats}))
    expected = fixed(whole)
    monkeypatch.setattr(W, "SLICE_SPAN", 3)
    assert fixed(operator(inputs.hb)) == expected


def test_row_order_of_the_input_does_not_matter(inputs):
    shuffled = inputs.hb.orderBy(F.xxhash64("event_id")).repartition(5)
    assert rows(C.service_time(shuffled)) == rows(C.service_time(inputs.hb))


@pytest.mark.parametrize("period", ["hour", "day", "month"])
def test_running_changes_for_any_period(inputs, period):
    got = C.running_changes(inputs.hb_timed, period=F.date_trunc(period, "ts")).collect()
    by_device = {}
    for r in sorted(got, key=lambda r: (r.sn, str(r.ts or ""), r.event_id)):
        previous, total = by_device.get(r.sn, (None, 0))
        change = int(previous is not None and previous != r.service_downtime)
        assert (r.change, r.changes_so_far) == (change, total + change)
        by_device[r.sn] = (r.service_downtime, total + change)
    assert len(got) == inputs.hb.count() and any(r.ts is None for r in got)


def test_running_changes_of_a_null_key_and_null_values(spark):
    data = [(None, 1, 1, 5), (None, 2, 2, 6), ("a", None, 3, 1), ("a", 4000, 4, None), ("a", 9000, 5, 2), ("a", 9001, 6, 3)]
    df = spark.createDataFrame(data, "sn string, ts bigint, event_id bigint, service_downtime bigint")
    got = {r.event_id: (r.change, r.changes_so_far) for r in C.running_changes(df).collect()}
    assert got == {1: (0, 0), 2: (1, 1), 3: (0, 0), 4: (0, 0), 5: (0, 0), 6: (1, 1)}
