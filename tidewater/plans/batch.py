"""Batch queries: views, checks, conform, decode, publish, enrichment."""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from tidewater.functions.codec import dead_letters, decode_valid
from tidewater.operators import conform as C
from tidewater.operators import enrich as E
from tidewater.operators import views as V
from tidewater.plans.oracle_base import SD, UA, WSD, WUA, with_
from tidewater.plans.registry import query
from tidewater.schemas import SENSOR_PAYLOAD, USER_ACTIVITY_PAYLOAD
from tidewater.session import run_dir
from tidewater.sources import bindings as B
from tidewater.sources import lake as L
from tidewater.sources.broker import envelope, publish, read_events, truncate_every

R = 6  # decimals kept for floating aggregates compared across engines


def warehouse_user_activity(spark, sf_dir):
    return C.conform_user_activity(B.user_activity(spark, sf_dir))


def warehouse_sensor_data(spark, sf_dir):
    return C.conform_sensor_data(B.sensor_data(spark, sf_dir))


@query("hourly_user_activity", with_(WUA) + """
SELECT date_trunc('hour', event_time) AS hour, event_type, COUNT(*) AS event_count
FROM wua GROUP BY 1, 2""")
def q_hourly_user_activity(spark, sf_dir):
    return V.hourly_user_activity(warehouse_user_activity(spark, sf_dir))


@query("sensor_stats", with_(WSD) + f"""
SELECT date_trunc('hour', event_time) AS hour, sensor_type, facility,
       COUNT(*) AS reading_count, round(AVG(sensor_value), {R}) AS avg_value,
       MIN(sensor_value) AS min_value, MAX(sensor_value) AS max_value
FROM wsd GROUP BY 1, 2, 3""")
def q_sensor_stats(spark, sf_dir):
    return V.sensor_stats(warehouse_sensor_data(spark, sf_dir)).withColumn(
        "avg_value", F.round("avg_value", R))


@query("table_counts", with_(WUA, WSD) + """
SELECT (SELECT COUNT(*) FROM wua) AS user_count, (SELECT COUNT(*) FROM wsd) AS sensor_count""")
def q_table_counts(spark, sf_dir):
    return V.table_counts(warehouse_user_activity(spark, sf_dir), warehouse_sensor_data(spark, sf_dir))


@query("event_type_distribution", with_(WUA) + """
SELECT event_type, COUNT(*) AS event_count FROM wua GROUP BY 1""")
def q_event_type_distribution(spark, sf_dir):
    return V.event_type_distribution(warehouse_user_activity(spark, sf_dir))


@query("sensor_type_avg", with_(WSD) + f"""
SELECT sensor_type, round(AVG(sensor_value), {R}) AS avg_value FROM wsd GROUP BY 1""")
def q_sensor_type_avg(spark, sf_dir):
    return V.sensor_type_avg(warehouse_sensor_data(spark, sf_dir)).withColumn(
        "avg_value", F.round("avg_value", R))


@query("activity_rollup", with_(WUA) + """
SELECT date_trunc('day', event_time) AS day, date_trunc('hour', event_time) AS hour, event_type,
       CAST(grouping(date_trunc('day', event_time), date_trunc('hour', event_time), event_type) AS BIGINT) AS grain,
       COUNT(*) AS event_count
FROM wua
GROUP BY ROLLUP (date_trunc('day', event_time), date_trunc('hour', event_time), event_type)""")
def q_activity_rollup(spark, sf_dir):
    return V.activity_rollup(warehouse_user_activity(spark, sf_dir))


DRILL_LO, DRILL_HI, DRILL_TYPE, DRILL_FACILITY = "2024-01-03 00:00:00", "2024-01-10 00:00:00", "click", "facility-3"


@query("filter_drilldown", with_(WSD) + f"""
SELECT date_trunc('hour', event_time) AS hour, sensor_type, facility,
       COUNT(*) AS reading_count, round(AVG(sensor_value), {R}) AS avg_value,
       MIN(sensor_value) AS min_value, MAX(sensor_value) AS max_value
FROM wsd
WHERE event_time >= TIMESTAMP '{DRILL_LO}' AND event_time < TIMESTAMP '{DRILL_HI}'
  AND sensor_type = '{DRILL_TYPE}' AND facility = '{DRILL_FACILITY}'
GROUP BY 1, 2, 3""")
def q_filter_drilldown(spark, sf_dir):
    return V.filter_drilldown(warehouse_sensor_data(spark, sf_dir), DRILL_LO, DRILL_HI,
                              DRILL_TYPE, DRILL_FACILITY).withColumn("avg_value", F.round("avg_value", R))


@query("conform_user_activity", with_(WUA) + "SELECT * FROM wua")
def q_conform_user_activity(spark, sf_dir):
    return warehouse_user_activity(spark, sf_dir)


@query("conform_sensor_data", with_(WSD) + "SELECT * FROM wsd")
def q_conform_sensor_data(spark, sf_dir):
    return warehouse_sensor_data(spark, sf_dir)


# ---- enrichment / cross-source joins -------------------------------------------------

@query("enrich_user_activity", with_(UA) + """
SELECT ua.event_id, ua.user_id, ua.event_type, ua.event_time,
       c.c_name, c.c_mktsegment, n.n_name, r.r_name
FROM ua
LEFT JOIN customer c ON CAST(ua.user_id AS BIGINT) = c.c_custkey
LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
LEFT JOIN region r ON n.n_regionkey = r.r_regionkey""")
def q_enrich_user_activity(spark, sf_dir):
    ua = B.user_activity(spark, sf_dir).select("event_id", "user_id", "event_type", "event_time")
    return E.enrich_user_activity(ua, *[B.read_table(spark, sf_dir, t) for t in ("customer", "nation", "region")])


@query("hourly_cross_source", with_(WUA, WSD) + f"""
SELECT COALESCE(a.hour, b.hour) AS hour, a.user_events, b.sensor_readings, b.avg_sensor_value
FROM (SELECT date_trunc('hour', event_time) AS hour, COUNT(*) AS user_events FROM wua GROUP BY 1) a
FULL OUTER JOIN (SELECT date_trunc('hour', event_time) AS hour, COUNT(*) AS sensor_readings,
                        round(AVG(sensor_value), {R}) AS avg_sensor_value FROM wsd GROUP BY 1) b
ON a.hour = b.hour""")
def q_hourly_cross_source(spark, sf_dir):
    return E.hourly_cross_source(warehouse_user_activity(spark, sf_dir), warehouse_sensor_data(spark, sf_dir)) \
        .withColumn("avg_sensor_value", F.round("avg_sensor_value", R))


# ---- codec: publish, decode, dead letters ---------------------------------------------

def _events(spark, sf_dir):
    return B.read_table(spark, sf_dir, "events")


def user_envelope(spark, sf_dir, corrupt_every: int | None = None):
    env = envelope(B.user_activity_payload(_events(spark, sf_dir)), "user_activity")
    return truncate_every(env, corrupt_every) if corrupt_every else env


def sensor_envelope(spark, sf_dir, corrupt_every: int | None = None):
    env = envelope(B.sensor_payload(_events(spark, sf_dir)), "sensor_data")
    return truncate_every(env, corrupt_every) if corrupt_every else env


UA_JSON = """json_object('user_id', user_id, 'event_type', event_type,
    'timestamp', strftime(event_time, '%Y-%m-%dT%H:%M:%S.%f'), 'session_id', session_id,
    'ip_address', ip_address, 'user_agent', user_agent, 'page_url', page_url, 'referrer', referrer,
    'time_spent', time_spent, 'element_id', element_id, 'search_query', search_query,
    'results_count', results_count, 'order_id', order_id, 'product_ids', product_ids,
    'total_amount', total_amount, 'currency', currency)"""


@query("publish_keyed_json", with_(UA) + f"""
SELECT user_id AS key, CAST({UA_JSON} AS VARCHAR) AS value, 'user-activity' AS topic, event_id AS offset FROM ua""")
def q_publish_keyed_json(spark, sf_dir):
    return user_envelope(spark, sf_dir).select("key", "value", "topic", "offset")


UA_DECODED_COLS = """event_id AS offset, user_id, event_type, event_time, session_id, ip_address, user_agent,
       page_url, referrer, time_spent, element_id, search_query, results_count, order_id,
       array_to_string(product_ids, ',') AS product_ids, total_amount, currency"""


def _ua_decoded_out(df):
    return df.select(
        "offset", "user_id", "event_type", F.col("timestamp").cast("timestamp_ntz").alias("event_time"),
        "session_id", "ip_address", "user_agent", "page_url", "referrer", "time_spent", "element_id",
        "search_query", "results_count", "order_id", F.array_join("product_ids", ",").alias("product_ids"),
        "total_amount", "currency")


@query("src_user_activity", with_(UA) + f"SELECT {UA_DECODED_COLS} FROM ua")
def q_src_user_activity(spark, sf_dir):
    return _ua_decoded_out(decode_valid(_published(spark, "user_activity", user_envelope(spark, sf_dir)), USER_ACTIVITY_PAYLOAD))


def _published(spark, family, env):
    """A bounded scan of a topic that ``env`` has been published to."""
    path = run_dir(spark, "topic") + "/" + family
    publish(env, path)
    return read_events(spark, family, path, stream=False)


@query("topic_key_partitions", """
SELECT CAST(user_id AS VARCHAR) AS key, COUNT(*) AS messages, 1::BIGINT AS partitions FROM events GROUP BY 1""")
def q_topic_key_partitions(spark, sf_dir):
    """Messages of one key share one partition of a topic published by key: the partition is
    read off the files that hold them."""
    path = os.path.join(run_dir(spark, "by_key"), "user_activity")
    publish(user_envelope(spark, sf_dir), path, by_key=True, num_files=16)
    part = F.regexp_extract("_metadata.file_name", r"^part-(\d+)", 1)
    per = read_events(spark, "user_activity", path, stream=False).groupBy("key", part.alias("part")).agg(F.count(F.lit(1)).alias("n"))
    return per.groupBy("key").agg(F.sum("n").alias("messages"), F.count(F.lit(1)).alias("partitions"))


@query("src_sensor_data", with_(SD) + """
SELECT event_id AS offset, sensor_id, sensor_type, event_time, latitude, longitude, facility,
       battery_level, reading, unit FROM sd""")
def q_src_sensor_data(spark, sf_dir):
    return _sensor_out(decode_valid(_published(spark, "sensor_data", sensor_envelope(spark, sf_dir)), SENSOR_PAYLOAD))


def _sensor_out(dec):
    return dec.select("offset", "sensor_id", "sensor_type",
                      F.col("timestamp").cast("timestamp_ntz").alias("event_time"),
                      F.col("location.lat").alias("latitude"), F.col("location.lon").alias("longitude"),
                      F.col("location.facility").alias("facility"), "battery_level", "reading", "unit")


CORRUPT_EVERY = 50  # fixture: every 50th message is cut to its first 10 characters


@query("decode_lenient", with_(UA) + f"SELECT {UA_DECODED_COLS} FROM ua WHERE event_id % {CORRUPT_EVERY} <> 0")
def q_decode_lenient(spark, sf_dir):
    return _ua_decoded_out(decode_valid(user_envelope(spark, sf_dir, CORRUPT_EVERY), USER_ACTIVITY_PAYLOAD))


@query("dead_letter", f"""
SELECT CAST(user_id AS VARCHAR) AS key, 'user-activity' AS topic, event_id AS offset,
       '{{"user_id"' AS value, 'malformed JSON' AS error
FROM events WHERE event_id % {CORRUPT_EVERY} = 0""")
def q_dead_letter(spark, sf_dir):
    return dead_letters(user_envelope(spark, sf_dir, CORRUPT_EVERY), USER_ACTIVITY_PAYLOAD).drop("partition")


@query("sensor_stats_sql", with_(WSD) + f"""
SELECT date_trunc('hour', event_time) AS hour, sensor_type, facility,
       COUNT(*) AS reading_count, round(AVG(sensor_value), {R}) AS avg_value,
       MIN(sensor_value) AS min_value, MAX(sensor_value) AS max_value
FROM wsd GROUP BY 1, 2, 3""")
def q_sensor_stats_sql(spark, sf_dir):
    """The views through their SQL text: the warehouse rows registered as temp
    views, the two views created over them with CREATE OR REPLACE TEMP VIEW."""
    _create_views(spark, sf_dir)
    return spark.table("sensor_stats").withColumn("avg_value", F.round("avg_value", R))


@query("hourly_user_activity_sql", with_(WUA) + """
SELECT date_trunc('hour', event_time) AS hour, event_type, COUNT(*) AS event_count
FROM wua GROUP BY 1, 2""")
def q_hourly_user_activity_sql(spark, sf_dir):
    _create_views(spark, sf_dir)
    return spark.table("hourly_user_activity")


def _create_views(spark, sf_dir):
    warehouse_user_activity(spark, sf_dir).createOrReplaceTempView("warehouse_user_activity")
    warehouse_sensor_data(spark, sf_dir).createOrReplaceTempView("warehouse_sensor_data")
    L.create_views(spark, temp=True, user_source="warehouse_user_activity", sensor_source="warehouse_sensor_data")
