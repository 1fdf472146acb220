"""Hourly availability kept up to date by micro-batches.

Each micro-batch adds its rows to a stored table, under its own number, and the dates it touches
are scored anew from all their rows. Both writes replace what the same batch wrote before, so a batch
that is run again, after a failure between the two or after both, leaves the same tables. Static tables,
such as the lines of the devices, are joined to the scores as they are when the batch runs.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from linkscore.operators import availability as A
from linkscore.sources import sinks as W

KEYS = ["sn", "date", "hr"]


def score_hours(rows: DataFrame, static: DataFrame | None = None) -> DataFrame:
    """Availability per device, date and hour of heartbeats and modem events in one table.

    A row with a modem event is an event, any other a heartbeat; ``static`` is joined on ``sn``.
    """
    crashes = A.modem_crashes(rows, KEYS)
    scored = A.availability(rows.where(F.col("modem_event").isNull()), crashes=crashes, keys=KEYS)
    return scored if static is None else scored.join(static, "sn", "left")


def batch_writer(path: str, static: DataFrame | None = None) -> Callable[[DataFrame, int], None]:
    """What a stream of rows does with a micro-batch: stores its rows and scores the dates it touches."""

    def put(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        placed = batch.withColumns({"date": F.to_date("ts"), "hr": F.hour("ts"), "batch": F.lit(number).cast("long")})
        W.write_dates(placed, f"{path}/rows", ("date", "batch"))
        stored = spark.read.schema(placed.schema).parquet(f"{path}/rows")
        # As many rows as dates in the batch, so they may be broadcast; they prune the stored dates.
        touched = F.broadcast(stored.where(F.col("batch") == number).select("date").distinct())
        rows = stored.join(touched, "date", "left_semi").drop("batch")
        W.write_dates(score_hours(rows, static), f"{path}/scores")

    return put


def write_scores(rows: DataFrame, path: str, checkpoint: str, static: DataFrame | None = None) -> StreamingQuery:
    """Keeps ``path``/scores up to date with the rows that have come, then stops; run again to go on."""
    writer = rows.writeStream.option("checkpointLocation", checkpoint).foreachBatch(batch_writer(path, static))
    return writer.trigger(availableNow=True).start()
