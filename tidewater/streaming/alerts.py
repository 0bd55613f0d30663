"""Threshold alerts over a streaming hourly rollup.

Hourly counts are a watermarked event-time aggregation (append mode: an hour is
final once the watermark passes its end).  Each micro-batch's alerts go to
``<path>/batch_id=<n>`` in overwrite mode, so a replayed batch rewrites the same
folder instead of duplicating alerts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidewater.functions.timefn import to_rest, zone_window_offset


def streaming_hourly_counts(events: DataFrame, time_col: str = "timestamp",
                            watermark: str | None = None) -> DataFrame:
    """Hourly counts per event type over an event-time (TIMESTAMP) column.  Pass
    ``watermark`` only if the stream does not declare one already."""
    src = events.withWatermark(time_col, watermark) if watermark else events
    hour = F.window(time_col, "1 hour", startTime=zone_window_offset(events.sparkSession, 3600))
    g = src.groupBy(hour.alias("w"), "event_type").agg(
        F.count(F.lit(1)).alias("event_count"))
    return g.select(to_rest("w.start").alias("hour"), "event_type", "event_count")


def start_hourly_alerts(events: DataFrame, threshold: int, path: str, checkpoint: str,
                        trigger: dict, time_col: str = "timestamp") -> StreamingQuery:
    def write(batch: DataFrame, batch_id: int) -> None:
        (batch.where(F.col("event_count") > threshold)
         .write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}"))
    return (streaming_hourly_counts(events, time_col).writeStream.outputMode("append").foreachBatch(write)
            .option("checkpointLocation", checkpoint).trigger(**trigger).start())
