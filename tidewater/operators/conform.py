"""Sink rows -> warehouse rows (the bridge between the stream's lake tables and
the warehouse tables the views read), plus the sink-row projections."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.functions.timefn import event_date, to_rest
from tidewater.schemas import WAREHOUSE_SENSOR_DATA, WAREHOUSE_USER_ACTIVITY


def user_activity_sink_row(decoded: DataFrame, processing_time=None) -> DataFrame:
    """Decoded user-activity payload -> 17-column sink row (timestamp -> event_time)."""
    pt = processing_time if processing_time is not None else F.current_timestamp()
    return decoded.select(
        "user_id", "event_type", F.col("timestamp").alias("event_time"),
        "session_id", "ip_address", "user_agent", "page_url", "referrer", "time_spent",
        "element_id", "search_query", "results_count", "order_id", "product_ids",
        "total_amount", "currency", to_rest(pt).alias("processing_time"))


def sensor_sink_row(decoded: DataFrame, processing_time=None) -> DataFrame:
    """Decoded sensor payload -> 10-column sink row; the nested location is flattened."""
    pt = processing_time if processing_time is not None else F.current_timestamp()
    return decoded.select(
        "sensor_id", "sensor_type", F.col("timestamp").alias("event_time"),
        F.col("location.lat").alias("latitude"), F.col("location.lon").alias("longitude"),
        F.col("location.facility").alias("facility"),
        "battery_level", "reading", "unit", to_rest(pt).alias("processing_time"))


def conform_user_activity(sink: DataFrame, with_partition: bool = False) -> DataFrame:
    cols = [F.col(f.name) for f in WAREHOUSE_USER_ACTIVITY.fields]
    if with_partition:
        cols.append(event_date("event_time").alias("event_date"))
    return sink.select(*cols)


def conform_sensor_data(sink: DataFrame, with_partition: bool = False) -> DataFrame:
    cols = []
    for f in WAREHOUSE_SENSOR_DATA.fields:
        cols.append(F.col("reading").alias("sensor_value") if f.name == "sensor_value" else F.col(f.name))
    if with_partition:
        cols.append(event_date("event_time").alias("event_date"))
    return sink.select(*cols)
