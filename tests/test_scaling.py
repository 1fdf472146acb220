"""Scaling families and group scores."""

import datetime as dt
import math
import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from linkscore import params as P
from linkscore.operators import percentiles as Q
from linkscore.operators import scaling as S


@pytest.fixture(scope="module")
def table(spark):
    data = [("m" if i % 3 else "k", "38365" if i % 2 else "00000", i, float(i % 101)) for i in range(600)]
    data += [(None, "38365", 1000, 5.0), (None, "38365", 1001, 7.0), ("m", "38365", 1002, None)]
    return spark.createDataFrame(data, "model string, pplan_cd string, id int, x double")


def scaled(df, spec, **kw):
    return {r.id: r.scaled_x for r in S.scale(df, [spec], **kw).collect()}


def test_percentile_scaling_is_monotone_and_bounded(table):
    up = scaled(table, P.ScaleSpec("x"))
    down = scaled(table, P.ScaleSpec("x", reverse=True))
    x = {r.id: (r.model, r.x) for r in table.collect()}
    for model in ("m", "k"):
        ids = sorted((i for i in up if x[i][0] == model and x[i][1] is not None), key=lambda i: x[i][1])
        values = [up[i] for i in ids]
        assert values == sorted(values) and min(values) == 0.0 and max(values) == 100.0
        assert [down[i] for i in ids] == sorted((down[i] for i in ids), reverse=True)
    assert up[1002] is None
    assert len(up) == table.count()


def test_a_null_group_is_a_group(table):
    cuts = S.percentile_by_group(table, ["x"], ["model"]).where("model is null").first()
    assert (cuts.x_low, cuts.x_mid, cuts.x_high) == (5.0, 5.0, 7.0)
    got = scaled(table, P.ScaleSpec("x"))
    assert (got[1000], got[1001]) == (None, 100.0)  # no width below the median


def test_history_gives_the_percentiles(table, spark):
    history = spark.range(101).select(F.lit("m").alias("model"), F.col("id").cast("double").alias("x"))
    got = scaled(table.where("model = 'm'"), P.ScaleSpec("x", middle=60.0), history=history)
    x = {r.id: r.x for r in table.collect()}
    for i, value in got.items():
        if x[i] == 50.0:
            assert value == 60.0
        if x[i] == 1.0:
            assert value == 0.0


def test_manual_thresholds(table):
    got = scaled(table, P.ScaleSpec("x", how="manual", thresholds=P.DOWNLOAD_THRESHOLDS))
    rows_ = {r.id: r for r in table.collect()}
    for i, value in got.items():
        r = rows_[i]
        if r.pplan_cd == "00000" or r.x is None:
            assert value is None
        elif r.x <= 50:
            assert value == pytest.approx(r.x, abs=0.01)
        else:
            assert value == pytest.approx(min(100, 50 + (r.x - 50) * 2), abs=0.01)


def test_shift_and_raw(table):
    median = {r.model: r.x_mid for r in S.percentile_by_group(table, ["x"], ["model"]).collect()}
    x = {r.id: r for r in table.where("x is not null").collect()}
    for reverse, sign in ((False, 1), (True, -1)):
        got = scaled(table, P.ScaleSpec("x", how="shift", reverse=reverse))
        for i, r in x.items():
            assert got[i] == pytest.approx(min(100, max(0, 50 + sign * (r.x - median[r.model]))))
    raw = scaled(table, P.ScaleSpec("x", how="raw", reverse=True, factor=2.0))
    assert all(raw[i] == max(0.0, 100 - 2 * r.x) for i, r in x.items())


def test_group_scores(spark):
    names = sorted({c for w in P.GROUP_WEIGHTS.values() for c in w})
    full = {n: 80.0 for n in names}
    data = [tuple(full[n] for n in names), tuple(None for _ in names)]
    df = spark.createDataFrame(data, ", ".join(f"{n} double" for n in names)).withColumn("id", F.monotonically_increasing_id())
    first, second = S.group_scores(df).orderBy("id").collect()
    # Usage and uptime count half: .25 * 40 + .25 * 40 + .5 * 80.
    assert first.data_score == 60.0 and first.speed_score == 80.0 and first.final_score == 76.0
    # A missing memory score counts 50; nothing else exists.
    assert second.device_score == 50.0 and second.data_score is None and second.final_score == 50.0


def test_shared_groups_use_one_table(table):
    specs = [P.ScaleSpec("x"), P.ScaleSpec("id", how="shift"), P.ScaleSpec("id2", by=P.MODEL_AND_PLAN, reverse=True)]
    out = S.scale(table.withColumn("id2", F.col("id")), specs)
    assert set(out.columns) == {"model", "pplan_cd", "id", "x", "id2", "scaled_x", "scaled_id", "scaled_id2"}
    assert rows(out.select("id")) == rows(table.select("id"))


@pytest.mark.parametrize("accuracy", [5, 50, 10_000])
def test_percentiles_are_exact_whatever_the_sketch(spark, accuracy):
    rng = random.Random(6)
    data = []
    for k in range(4000):
        group = rng.choice(["a", "a", "b", None])
        data.append((group, rng.gauss(0, 1) if rng.random() > 0.1 else None, rng.choice([1, 1, 1, 2, 7]), None))
    data += [("empty", None, None, None), ("one", 3.5, 4, None)]
    df = spark.createDataFrame(data, "g string, x double, n int, none double")
    cuts = {"low": 0.01, "mid": 0.5, "p75": 0.75, "high": 0.99}
    for by in (["g"], []):
        got = Q.percentiles(df, ["x", "n", "none"], by, cuts, accuracy=accuracy).collect()
        assert len(got) == (5 if by else 1)
        for r in got:
            for k, c in ((1, "x"), (2, "n")):
                values = sorted(d[k] for d in data if d[k] is not None and (not by or d[0] == r["g"]))
                for name, p in cuts.items():
                    assert r[f"{c}_{name}"] == (values[max(1, math.ceil(p * len(values))) - 1] if values else None)
            assert r["none_mid"] is None
    assert dict(Q.percentiles(df, ["n"], ["g"], cuts).dtypes)["n_low"] == "int"


def test_a_sketch_is_close(table):
    exact, sketched = (S.percentile_by_group(table, ["x"], ["model"], sketch=s) for s in (False, True))
    assert rows(exact) == rows(sketched)


def _grouped(spark):
    rng = random.Random(4)
    data = [(None if k % 7 == 0 else f"g{k % 3}", dt.date(2024, 1, 1 + k % 4), rng.choice([None, rng.gauss(0, 9), 5.0]), float(k % 11)) for k in range(6000)]
    data += [("empty", dt.date(2024, 1, 1), None, 1.0), ("one", dt.date(2024, 1, 2), 3.5, None)]
    return spark.createDataFrame(data, "g string, day date, x double, y double")


@pytest.mark.parametrize("k, safety", [(200, 2.0), (8, 2.0), (8, 0.0)])
def test_percentiles_from_daily_sketches_are_exact(spark, monkeypatch, k, safety):
    df = _grouped(spark)
    monkeypatch.setattr(Q, "SAFETY", safety)  # without room most enclosures are missed, and counted anew
    sketches = Q.daily_sketches(df, ["x", "y"], ["g"], "day", k)
    assert sketches.count() == df.select("g", "day").distinct().count()
    got = Q.percentiles_of_sketches(sketches, df, ["x", "y"], ["g"], S.CUTS, k)
    want = {}
    for r in df.collect():
        want.setdefault(r.g, {"x": [], "y": []})
        for c in ("x", "y"):
            if r[c] is not None:
                want[r.g][c].append(r[c])
    for r in got.collect():
        for c in ("x", "y"):
            values = sorted(want[r.g][c])
            for name, share in S.CUTS.items():
                exact = values[max(math.ceil(share * len(values)), 1) - 1] if values else None
                assert r[f"{c}_{name}"] == exact, (r.g, c, name)
    assert got.count() == len(want)


def test_history_is_enclosed_by_its_sketches(spark, inputs):
    """With stored sketches the history's rows are read once, not twice."""
    specs = [P.ScaleSpec("dl_speed", by=("device_model",))]
    sketches = Q.daily_sketches(inputs.passive, ["dl_speed"], ["device_model"], "datadate")
    plain = S.scale(inputs.passive, specs, inputs.passive)
    stored = S.scale(inputs.passive, specs, inputs.passive, history_sketches=sketches)
    assert rows(stored) == rows(plain)
    reads = lambda df: df._jdf.queryExecution().optimizedPlan().toString().count("Relation")
    assert reads(stored) < reads(plain)
