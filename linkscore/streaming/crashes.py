"""The hourly crash count as a stream: the same rows as the batch count, hour by hour."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def crashes_per_hour(events: DataFrame, lateness: str = "10 minutes") -> DataFrame:
    """Modem events per device and hour, for a batch or a stream of (sn, ts, modem_event).

    On a stream an hour is final once the watermark has passed its end; later rows are left out.
    """
    rows = events.where(F.col("modem_event").isNotNull()).withWatermark("ts", lateness)
    counted = rows.groupBy(F.window("ts", "1 hour"), "sn").agg(F.count("*").alias("crashes"))
    return counted.select("sn", F.col("window.start").alias("hour"), "crashes")


def write_crashes(counts: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append each finished hour to Parquet, then stop; run again to go on from the checkpoint."""
    writer = counts.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
    return writer.outputMode("append").trigger(availableNow=True).start()
