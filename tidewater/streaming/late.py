"""Tumbling windows that close once, a late table, and corrections of closed windows.

Each micro-batch adds its rows' partial aggregates to those of the open windows, which are
carried as a small table.  When the watermark (latest event time seen less ``delay``) passes
a window's end, the window goes to ``<table>`` and leaves the state.  Rows of a window that
is closed already are late: they go whole to ``<table>_late`` and, as partial aggregates, to
``<table>_corrections``.  Closed windows and corrections added up are what the whole topic
gives for the windows closed by then; no row is lost.

Every micro-batch writes its own folder in each table and then its entry (see
``streaming/batches``), so replays change nothing.  The state holds a row per open window:
those that reach past the watermark.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import DoubleType, LongType, StructField, StructType, TimestampNTZType

from tidewater.session import filesystem
from tidewater.streaming import batches

KEYS = ["window_start", "window_end"]
ADDED = {"message_count": F.sum, "value_count": F.sum, "value_sum": F.sum, "min_value": F.min, "max_value": F.max}
PARTIAL = StructType([StructField(c, t()) for c, t in (
    ("window_start", TimestampNTZType), ("window_end", TimestampNTZType), ("message_count", LongType), ("value_count", LongType),
    ("value_sum", DoubleType), ("min_value", DoubleType), ("max_value", DoubleType))])


def side(table: str, name: str) -> str:
    return f"{table.rstrip('/')}_{name}"


def window_start(time: str, seconds: int):
    """The epoch-aligned start of a row's window, on times without zone."""
    origin = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    us, width = F.timestamp_diff("MICROSECOND", origin, F.col(time)), seconds * 1_000_000
    return F.timestamp_add("MICROSECOND", us - F.pmod(us, F.lit(width)), origin)


def partials(rows: DataFrame, value: str, seconds: int, time: str = "event_time") -> DataFrame:
    v = F.col(value).cast("double")
    return (rows.where(F.col(time).isNotNull()).groupBy(window_start(time, seconds).alias("window_start"))
            .agg(F.count(F.lit(1)).alias("message_count"), F.count(v).alias("value_count"), F.sum(v).alias("value_sum"),
                 F.min(v).alias("min_value"), F.max(v).alias("max_value"))
            .withColumn("window_end", F.timestamp_add("SECOND", F.lit(seconds), F.col("window_start"))).select(*PARTIAL.names))


def added(rows: DataFrame) -> DataFrame:
    return rows.groupBy(*KEYS).agg(*[f(c).alias(c) for c, f in ADDED.items()]).select(*PARTIAL.names)


def start_windows(events: DataFrame, table: str, checkpoint: str, trigger: dict, value: str, seconds: int = 10,
                  delay_s: float = 5) -> StreamingQuery:
    """``events``: a stream with event_time (without zone).  Rows without a time are in no
    window, as in a batch."""
    spark, origin = events.sparkSession, F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")

    def write(batch: DataFrame, batch_id: int) -> dict:
        before = batches.entry(spark, table, batch_id - 1) if batch_id else None
        state = lambda n: f"{side(table, 'state')}/batch_id={n}"
        put = lambda df, path: df.write.mode("overwrite").parquet(path)
        carried = spark.read.schema(PARTIAL).parquet(state(batch_id - 1)) if before else spark.createDataFrame([], PARTIAL)
        batch = batch.persist()
        try:
            seen = batch.agg(F.max(F.timestamp_diff("MICROSECOND", origin, F.col("event_time")))).first()[0]
            past = before["watermark_us"] if before else None
            mark = max((m for m in (past, None if seen is None else seen - int(delay_s * 1_000_000)) if m is not None), default=None)
            closed = lambda us, end: F.lit(False) if us is None else end <= F.timestamp_add("MICROSECOND", F.lit(us), origin)
            end = F.timestamp_add("SECOND", F.lit(seconds), window_start("event_time", seconds))
            is_late = F.coalesce(closed(past, end), F.lit(False))  # closed before this batch
            late = batch.where(is_late)
            put(late, f"{side(table, 'late')}/batch_id={batch_id}")
            put(partials(late, value, seconds), f"{side(table, 'corrections')}/batch_id={batch_id}")
            open_ = added(carried.unionByName(partials(batch.where(~is_late), value, seconds)))
            put(open_.where(closed(mark, F.col("window_end"))), f"{table}/batch_id={batch_id}")
            put(open_.where(~closed(mark, F.col("window_end"))), state(batch_id))
        finally:
            batch.unpersist()
        fs, old = filesystem(spark, state(batch_id - 2))
        fs.delete(old, True)
        return {"watermark_us": mark}

    return batches.start(events, table, checkpoint, write, trigger, "corrected-windows")


def corrected(spark: SparkSession, table: str, value_stats: bool = True) -> DataFrame:
    """The closed windows with all corrections so far: window_start, window_end, message_count
    and, with ``value_stats``, avg_value, min_value and max_value."""
    rows = [batches.read(spark, t, PARTIAL, upto=batches.last_batch(spark, table)) for t in (table, side(table, "corrections"))]
    total = added(rows[0].unionByName(rows[1]))
    stats = [F.try_divide("value_sum", "value_count").alias("avg_value"), "min_value", "max_value"] if value_stats else []
    return total.select(*KEYS, "message_count", *stats)
