"""Counter increments per device as keyed state of a stream.

A device's state holds its totals, the counters of its last final row, and the rows that the watermark
has not passed. Rows come in any order; those that can still be preceded by a late one wait, sorted, and
become final when the watermark passes them. Each update counts the waiting rows too, so the newest
update of a device equals the batch result over all rows that have come, and a restart goes on from
the checkpoint. Rows older than the watermark are left out, as on any stream.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from linkscore.operators.counters import FAILURE_COUNTERS

STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def _increment(value: int | None, previous: int | None) -> int:
    """What a cumulative counter added, as :func:`linkscore.operators.counters.increment` has it."""
    if value is None:
        return 0
    return value - previous if previous is not None and previous <= value else value


class CounterTotals(StatefulProcessor):
    """Totals per device; a device idle for ``idle_ms`` of event time is forgotten, if that is set."""

    def __init__(self, counters: Sequence[str], idle_ms: int | None = None):
        self.counters = list(counters)
        self.idle_ms = idle_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.update = Row("sn", *[f"sum_{c}" for c in self.counters], "rows", "waiting")
        last, total = (", ".join(f"{p}_{c} long" for c in self.counters) for p in ("last", "total"))
        self.done = handle.getValueState("done", f"rows long, at long, {last}, {total}")
        self.waiting = handle.getListState("waiting", f"at long, event_id long, {', '.join(f'{c} long' for c in self.counters)}")

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        kept = list(self.waiting.get()) if self.waiting.exists() else []
        held = [tuple(r) for r in kept] + [(r["at"], r["event_id"], *(r[c] for c in self.counters)) for r in rows]
        done, held = self._settled(sorted(held, key=lambda r: r[:2]), timerValues)
        final, total = self._added(done, held)[:2]
        yield self.update(*key, *total, final, len(held))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        kept = [tuple(r) for r in self.waiting.get()] if self.waiting.exists() else []
        done, held = self._settled(sorted(kept, key=lambda r: r[:2]), timerValues)
        if self.idle_ms is not None and not held and done[1] // 1000 + self.idle_ms <= timerValues.getCurrentWatermarkInMs():
            self.done.clear()
        return iter(())

    def _settled(self, held: list[tuple], timerValues) -> tuple[tuple, list[tuple]]:
        """Makes rows final that the watermark has passed and stores the rest; both as they are then."""
        passed = timerValues.getCurrentWatermarkInMs() * 1000
        ready = [r for r in held if r[0] <= passed]
        n = len(self.counters)
        done = tuple(self.done.get()) if self.done.exists() else (0, 0, *[None] * n, *[0] * n)
        if ready:
            rows, total, last = self._added(done, ready)
            done = (rows, ready[-1][0], *last, *total)
            self.done.update(done)
            held = held[len(ready) :]
        if held:
            self.waiting.put(held)
        else:
            self.waiting.clear()
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        if held:
            self.handle.registerTimer(held[-1][0] // 1000 + 1)
        elif self.idle_ms is not None:
            self.handle.registerTimer(done[1] // 1000 + self.idle_ms)
        return done, held

    def _added(self, done: tuple, rows: list[tuple]) -> tuple[int, list[int], list[int | None]]:
        """Rows, totals and last counters after more rows in order."""
        n = len(self.counters)
        last, total = list(done[2 : 2 + n]), list(done[2 + n :])
        for row in rows:
            total = [t + _increment(now, was) for t, now, was in zip(total, row[2:], last)]
            last = list(row[2:])
        return done[0] + len(rows), total, last


def counter_totals(
    heartbeats: DataFrame, counters: Sequence[str] = FAILURE_COUNTERS, lateness: str = "1 day", idle_ms: int | None = None
) -> DataFrame:
    """Updates (sn, sum_<counter>, rows, waiting) of a stream of heartbeats (sn, ts, event_id, counters).

    Rows of a device follow each other by time and event id.
    """
    rows = heartbeats.select("sn", F.col("ts").cast("timestamp").alias("ts"), "event_id", *[F.col(c).cast("long") for c in counters])
    rows = rows.withColumn("at", F.unix_micros("ts")).withWatermark("ts", lateness)
    fields = ["rows", "waiting"]
    schema = T.StructType([heartbeats.schema["sn"], *[T.StructField(f"sum_{c}", T.LongType()) for c in counters]])
    schema = T.StructType([*schema.fields, *[T.StructField(f, T.LongType()) for f in fields]])
    return rows.groupBy("sn").transformWithState(CounterTotals(counters, idle_ms), schema, "update", "EventTime")


@contextmanager
def _state_store(spark: SparkSession):
    """Streams started within keep their state in RocksDB, which keyed state needs."""
    before = spark.conf.get(STORE, None)
    spark.conf.set(STORE, ROCKS)
    try:
        yield
    finally:
        spark.conf.unset(STORE) if before is None else spark.conf.set(STORE, before)


def write_totals(totals: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Writes the updates of each micro-batch to a folder of its own, then stops; run again to go on.

    A batch that is run again replaces its folder.
    """

    def put(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={number}")

    with _state_store(totals.sparkSession):
        writer = totals.writeStream.outputMode("update").option("checkpointLocation", checkpoint)
        return writer.foreachBatch(put).trigger(availableNow=True).start()


def latest_totals(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The newest update of each device."""
    updates = spark.read.schema(T.StructType([*schema.fields, T.StructField("batch", T.LongType())])).parquet(path)
    values = F.struct(*[c for c in schema.names if c != "sn"])
    newest = updates.groupBy("sn").agg(F.max_by(values, "batch").alias("newest"))
    return newest.select("sn", "newest.*")
