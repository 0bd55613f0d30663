"""Tumbling windows over event time (watermarked, append mode) and over arrival
time (partial counts per micro-batch).  Windows are epoch-aligned and [start, end)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from tidewater.functions.codec import is_record
from tidewater.schemas import COUNTER_PAYLOAD
from tidewater.functions.timefn import to_rest
from tidewater.streaming import batches

WINDOW = "10 seconds"


def decodable_messages(env: DataFrame, *columns: str) -> DataFrame:
    """The counter's input: messages that decode to a JSON object; no field is read."""
    return env.where(is_record(F.col("value"), COUNTER_PAYLOAD)).select(*(columns or ["offset"]))


def event_time_window_stats(events: DataFrame, time_col: str = "timestamp", duration: str = WINDOW,
                            value_col: str | None = None, watermark: str | None = "5 seconds") -> DataFrame:
    """(window_start, window_end, message_count[, avg/min/max of value]).
    In a stream each window is emitted once the watermark passes its end; rows
    behind the watermark are dropped by the state operator."""
    src = events.withWatermark(time_col, watermark) if watermark and events.isStreaming else events
    aggs = [F.count(F.lit(1)).alias("message_count")]
    if value_col:
        aggs += [F.avg(value_col).alias("avg_value"), F.min(value_col).alias("min_value"),
                 F.max(value_col).alias("max_value")]
    g = src.groupBy(F.window(F.col(time_col), duration).alias("w")).agg(*aggs)
    return g.select(to_rest("w.start").alias("window_start"), to_rest("w.end").alias("window_end"),
                    *[c for c in g.columns if c != "w"])


def arrival_window_count(env: DataFrame, duration: str = WINDOW, watermark: str | None = WINDOW) -> DataFrame:
    """Tumbling count over the broker's arrival time, whatever the micro-batches' times.
    On a stream the watermark lets windows that can no longer change leave the state."""
    counted = decodable_messages(env, "timestamp")
    if watermark and env.isStreaming:
        counted = counted.withWatermark("timestamp", watermark)
    g = counted.groupBy(F.window("timestamp", duration).alias("w")).agg(F.count(F.lit(1)).alias("message_count"))
    return g.select(to_rest("w.start").alias("window_start"), to_rest("w.end").alias("window_end"),
                    "message_count")


def start_append(df: DataFrame, path: str, checkpoint: str, trigger: dict) -> StreamingQuery:
    return (df.writeStream.format("parquet").outputMode("append").option("path", path)
            .option("checkpointLocation", checkpoint).trigger(**trigger).start())


def start_partial_log(stream: DataFrame, aggregate: Callable[[DataFrame], DataFrame], path: str,
                      checkpoint: str, trigger: dict, query_name: str | None = None) -> StreamingQuery:
    """Each micro-batch's own partial aggregate goes to ``<path>/batch_id=<n>`` (overwrite,
    so a replayed batch is harmless).  There is no state and no watermark: rows may come
    in any order and in any batches, and none is lost.  Output stays in proportion to a
    batch's groups."""
    def write(batch: DataFrame, batch_id: int) -> None:
        aggregate(batch).write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")
    w = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(**trigger)
    return (w.queryName(query_name) if query_name else w).start()


def start_table_rollup(spark: SparkSession, source: str, schema: StructType, aggregate: Callable[[DataFrame], DataFrame],
                       path: str, checkpoint: str, trigger: dict) -> StreamingQuery:
    """The partial aggregates of a processor's table, of whole source batches: a batch that
    the processor or this job replays is counted once."""
    def write(rows: DataFrame, batch_id: int, before: dict | None) -> None:
        aggregate(rows).write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")
    return batches.follow(spark, source, schema, path, checkpoint, write, trigger)


def folded_path(path: str) -> str:
    return path.rstrip("/") + "_folded"


def read_partial_log(spark: SparkSession, path: str, keys: list[str], counts: list[str],
                     upto: int | None = None) -> DataFrame:
    """The log's partial counts added up, with what :func:`fold_partial_log` has folded up
    to batch ``upto``."""
    partial = spark.read.parquet(path)
    if upto is not None:
        folded = spark.read.parquet(f"{folded_path(path)}/upto={upto}")
        partial = partial.where(F.col("batch_id") > upto).drop("batch_id").unionByName(folded)
    return partial.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in counts])


def fold_partial_log(spark: SparkSession, path: str, keys: list[str], counts: list[str], upto: int) -> None:
    """Add up the batches to ``upto`` into one small table beside the log; their folders may
    then be removed.  Repeating it changes nothing."""
    partial = spark.read.parquet(path).where(F.col("batch_id") <= upto)
    (partial.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in counts])
     .write.mode("overwrite").parquet(f"{folded_path(path)}/upto={upto}"))
