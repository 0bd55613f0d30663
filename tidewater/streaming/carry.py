"""Sequence operators on a stream: what a batch must know of earlier rows is carried from one
micro-batch to the next as a small table.

A micro-batch works on its own rows and the carried ones, with the same operators as a batch
job (hot entities are cut there, no pairs of rows are made), writes its results to
``<table>/batch_id=<n>`` and the rows to carry to ``<table>_state/batch_id=<n>``, then its
entry (``streaming/batches``).  Batch n reads version n - 1 and nothing else, so a replayed
batch gives the same; older versions are removed.

Order: the watermark is the latest event time seen less ``delay``.  Rows ahead of it wait in
the carried table, so rows that come out of order by no more than the delay are handled as if
in order.  Rows behind it are handled when they come, against what is still carried.  Rows
without a time are handled at once, before all others.

What is carried is bounded: the rows of the last ``delay``, and for an anomaly the last n
readings of each sensor, for a purchase the last view of each user while it is younger than
the watermark less the pattern's length.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import BooleanType, StructField, StructType
from pyspark.sql.window import Window

from tidewater.functions.timefn import to_rest
from tidewater.operators import detect as D
from tidewater.session import filesystem
from tidewater.streaming import batches

DELAY_S = 5
ORDER = ("event_time", "event_id")


def state_of(table: str) -> str:
    return table.rstrip("/") + "_state"


def _at(us: int):
    """An instant (microseconds since the local origin) as a time without zone."""
    return F.timestamp_add("MICROSECOND", F.lit(us), F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"))


def _latest_us(rows: DataFrame) -> int | None:
    origin = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return rows.agg(F.max(F.timestamp_diff("MICROSECOND", origin, F.col("event_time")))).first()[0]


def start_carried(events: DataFrame, table: str, checkpoint: str, results: Callable[[DataFrame], DataFrame],
                  keep: Callable[[DataFrame, int], DataFrame], trigger: dict, delay_s: float = DELAY_S,
                  query_name: str | None = None) -> StreamingQuery:
    """``events``: a stream with event_time (without zone) and event_id.  ``results(rows)`` gets
    settled rows, carried (``_new`` false) and new, and returns what to emit for new ones;
    ``keep(rows, watermark_us)`` the rows of them to carry on."""
    spark, delay_us = events.sparkSession, int(delay_s * 1_000_000)
    schema = StructType([*events.schema.fields, StructField("_settled", BooleanType())])

    def write(batch: DataFrame, batch_id: int) -> dict:
        before = batches.entry(spark, table, batch_id - 1) if batch_id else None
        state = lambda n: f"{state_of(table)}/batch_id={n}"
        carried = spark.read.schema(schema).parquet(state(batch_id - 1)) if before else spark.createDataFrame([], schema)
        batch = batch.persist()
        try:
            seen, past = _latest_us(batch), before and before["watermark_us"]
            watermark = max((w for w in (past, None if seen is None else seen - delay_us) if w is not None), default=None)
            rows = carried.unionByName(batch.withColumn("_settled", F.lit(False)))
            settles = F.lit(False) if watermark is None else F.col("event_time") <= _at(watermark)
            ready = (rows.where(F.col("_settled") | F.col("event_time").isNull() | settles)
                     .withColumn("_new", ~F.col("_settled")).drop("_settled"))
            waiting = rows.where(~F.col("_settled") & F.col("event_time").isNotNull() & ~F.coalesce(settles, F.lit(False)))
            results(ready).write.mode("overwrite").parquet(f"{table}/batch_id={batch_id}")
            kept = keep(ready, watermark).select(*events.columns, F.lit(True).alias("_settled"))
            kept.unionByName(waiting.select(*kept.columns)).write.mode("overwrite").parquet(state(batch_id))
        finally:
            batch.unpersist()
        fs, old = filesystem(spark, state(batch_id - 2))
        fs.delete(old, True)
        return {"watermark_us": watermark}

    return batches.start(events, table, checkpoint, write, trigger, query_name)


def last_rows(rows: DataFrame, key: str, n: int) -> DataFrame:
    """The last ``n`` rows of each key; limited in each task before the shuffle."""
    newest = Window.partitionBy(key).orderBy(*[F.col(c).desc_nulls_last() for c in ORDER])
    return rows.withColumn("_place", F.row_number().over(newest)).where(F.col("_place") <= n).drop("_place")


def start_sensor_anomalies(readings: DataFrame, table: str, checkpoint: str, trigger: dict, threshold: float = 2.0, n: int = 20,
                           value: str = "reading", delay_s: float = DELAY_S) -> StreamingQuery:
    """Readings whose z-score against the previous ``n`` readings of their sensor reaches the
    threshold, as :func:`tidewater.operators.detect.sensor_anomalies` finds them in a table."""
    def results(rows: DataFrame) -> DataFrame:
        return D.sensor_anomalies(rows, threshold, n, value).where("_new").drop("_new")

    return start_carried(readings, table, checkpoint, results, lambda rows, _: last_rows(rows, "sensor_id", n), trigger, delay_s,
                         "sensor-anomalies")


def start_view_then_purchase(events: DataFrame, table: str, checkpoint: str, trigger: dict, within_us: int = 30 * 60 * 1_000_000,
                             view: str = "view", purchase: str = "purchase", delay_s: float = DELAY_S) -> StreamingQuery:
    """Purchases after a view of the same user, as
    :func:`tidewater.operators.detect.view_then_purchase` finds them in a table.  Only views are
    carried, so every purchase is judged once."""
    def results(rows: DataFrame) -> DataFrame:
        return D.view_then_purchase(rows, within_us, view, purchase)

    def keep(rows: DataFrame, watermark_us: int | None) -> DataFrame:
        views = rows.where(F.col("event_type") == view)
        if watermark_us is not None:
            views = views.where(F.col("event_time") >= _at(watermark_us - within_us))
        return last_rows(views, "user_id", 1)

    return start_carried(events.where(F.col("event_type").isin(view, purchase)), table, checkpoint, results, keep, trigger, delay_s,
                         "view-then-purchase")


def sensor_readings(decoded: DataFrame) -> DataFrame:
    return decoded.select(F.col("offset").alias("event_id"), "sensor_id", to_rest("timestamp").alias("event_time"), "reading")


def user_events(decoded: DataFrame) -> DataFrame:
    return decoded.select(F.col("offset").alias("event_id"), "user_id", "event_type", to_rest("timestamp").alias("event_time"))
