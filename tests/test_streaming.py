"""Streams end with the batch results."""

import datetime as dt

from conftest import rows
from pyspark.sql import functions as F

from linkscore.operators import counters as C
from linkscore.streaming.availability import batch_writer, score_hours
from linkscore.streaming.crashes import crashes_per_hour, write_crashes
from linkscore.streaming.increments import counter_totals, latest_totals, write_totals


def test_stream_equals_batch(spark, inputs, tmp_path):
    events = inputs.modem_event.select("sn", F.col("ts").cast("timestamp").alias("ts"), "modem_event")
    source, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "checkpoint"))
    events.where("ts < timestamp'2024-01-15'").orderBy("ts").coalesce(1).write.parquet(source)
    stream = lambda: crashes_per_hour(spark.readStream.schema(events.schema).parquet(source))
    write_crashes(stream(), out, checkpoint).awaitTermination()
    events.where("ts >= timestamp'2024-01-15'").coalesce(1).write.mode("append").parquet(source)
    write_crashes(stream(), out, checkpoint).awaitTermination()
    got = spark.read.parquet(out)
    # Hours are appended once the watermark has passed them; the last ones stay open.
    end = events.where("modem_event is not null").agg(F.max("ts")).first()[0]
    closed = crashes_per_hour(events).where(F.col("hour") + F.expr("interval 1 hour") <= F.lit(end) - F.expr("interval 10 minutes"))
    assert rows(got) == rows(closed)


COUNTERS = ["a", "b"]
HEARTBEAT = "sn string, ts timestamp, event_id long, a long, b long"


def land(spark, path, day_rows):
    at = lambda minutes: dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc) + dt.timedelta(minutes=minutes)
    data = [(sn, at(minutes), k, a, b) for sn, minutes, k, a, b in day_rows]
    spark.createDataFrame(data, HEARTBEAT).coalesce(1).write.mode("append").parquet(path)


def totals_after(spark, tmp_path, landings, **options):
    """Newest totals after each landing; every landing is a new start from the checkpoint."""
    source, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "checkpoint"))
    found = []
    for landing in landings:
        land(spark, source, landing)
        stream = counter_totals(spark.readStream.schema(HEARTBEAT).parquet(source), COUNTERS, **options)
        write_totals(stream, out, checkpoint).awaitTermination()
        newest = latest_totals(spark, out, stream.schema)
        found.append({r.sn: (r.sum_a, r.sum_b, r.rows, r.waiting) for r in newest.collect()})
    return found


def test_totals_follow_rows_in_any_order_and_restarts(spark, tmp_path):
    first = [("x", 50, 1, 10, None), ("x", 10, 2, 4, 1), ("y", 20, 3, 7, 7), (None, 5, 4, 1, 1)]
    second = [("x", 30, 5, 6, 5), ("x", 50, 0, 2, 9), ("y", 25, 6, 3, None)]
    got = totals_after(spark, tmp_path, [first, second], lateness="1 hour")
    assert {sn: t[:2] for sn, t in got[0].items()} == {"x": (10, 1), "y": (7, 7), None: (1, 1)}
    # In order x is 4, 6, 2 (a reset), 10 and 1, 5, 9, none.
    assert got[1]["x"][:3] == (4 + 2 + 2 + 8, 1 + 4 + 4, 4) and got[1]["y"][:2] == (7 + 3, 7)
    whole = spark.createDataFrame([(r[0], r[1], r[2], r[3], r[4]) for r in first + second], "sn string, ts long, event_id long, a long, b long")
    batch = C.counter_increments(whole, COUNTERS, order=("ts", "event_id")).collect()
    assert {r.sn: (r.sum_a, r.sum_b) for r in batch} == {sn: t[:2] for sn, t in got[1].items()}


def test_rows_behind_the_watermark_are_left_out_and_final_rows_do_not_wait(spark, tmp_path):
    landings = [
        [("x", 0, 1, 1, 1), ("x", 300, 2, 5, 5)],
        [("x", 310, 4, 6, 6), ("x", 10, 3, 100, 100)],  # minute 10 lies behind 300 - 30
    ]
    got = totals_after(spark, tmp_path, landings, lateness="30 minutes")
    assert got[1]["x"][:3] == (6, 6, 3)


def test_an_idle_device_is_forgotten(spark, tmp_path):
    landings = [
        [("x", 0, 1, 9, 9), ("y", 0, 2, 1, 1)],
        [("y", 500, 3, 2, 2)],
        [("y", 900, 4, 3, 3)],
        [("x", 1000, 5, 10, 10), ("y", 1000, 6, 4, 4)],
    ]
    got = totals_after(spark, tmp_path, landings, lateness="1 minute", idle_ms=60 * 60_000)
    # x comes back as a new device, y was never idle in between its own rows' updates.
    assert got[1]["x"][:2] == (9, 9) and got[3]["x"][:2] == (10, 10)


def test_a_batch_that_runs_again_changes_nothing(spark, tmp_path):
    row = "sn string, ts timestamp, event_id long, service_uptime long, service_downtime long, modem_event string"
    counters = {c: "CAST(event_id AS long)" for c in C.FAILURE_COUNTERS}
    at = lambda day, hour: dt.datetime(2024, 1, day, hour, tzinfo=dt.timezone.utc)
    data = [("x", at(d, h), 100 * d + h, d, 1, "crash" if h == 3 else None) for d in (1, 2, 3) for h in (1, 2, 3)]
    data += [("x", at(d, 1), 1000 + d, d + 1, 2, None) for d in (1, 2, 3)]
    every = spark.createDataFrame(data, row).selectExpr("*", *[f"{e} AS {c}" for c, e in counters.items()])
    put = batch_writer(str(tmp_path), spark.createDataFrame([("x", 5)], "sn string, lines int"))
    read = lambda: rows(spark.read.parquet(f"{tmp_path}/scores"))
    one, two = every.where("day(ts) < 3 AND event_id < 1000"), every.where("day(ts) = 3 OR event_id >= 1000")
    put(one, 0)
    put(two, 1)
    scored = read()
    for batch, number in ((two, 1), (one, 0), (two, 1)):
        put(batch, number)
        assert read() == scored
    placed = every.selectExpr("*", "to_date(ts) AS date", "hour(ts) AS hr")
    want = score_hours(placed).selectExpr("*", "5 AS lines")
    assert scored == rows(want.select(spark.read.parquet(f"{tmp_path}/scores").columns))
