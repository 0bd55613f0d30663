"""Declared schemas (never inferred) and key metadata of the two event families."""

from __future__ import annotations

from pyspark.sql.types import (ArrayType, DoubleType, IntegerType, LongType, StringType,
                               StructField, StructType, TimestampNTZType, TimestampType)

# Broker-shaped envelope every source yields (a broker connector yields the same
# columns after CAST(key/value AS STRING)).
ENVELOPE = StructType([
    StructField("key", StringType()),
    StructField("value", StringType()),
    StructField("topic", StringType()),
    StructField("partition", IntegerType()),
    StructField("offset", LongType()),
    StructField("timestamp", TimestampType()),
])

# Topic names of the two event families.
USER_ACTIVITY_TOPIC = "user-activity"
SENSOR_DATA_TOPIC = "sensor-data"

# Declared payload of a user-activity message (16 fields; each event type fills a subset).
USER_ACTIVITY_PAYLOAD = StructType([
    StructField("user_id", StringType()),
    StructField("event_type", StringType()),
    StructField("timestamp", TimestampType()),
    StructField("session_id", StringType()),
    StructField("ip_address", StringType()),
    StructField("user_agent", StringType()),
    StructField("page_url", StringType()),
    StructField("referrer", StringType()),
    StructField("time_spent", IntegerType()),
    StructField("element_id", StringType()),
    StructField("search_query", StringType()),
    StructField("results_count", IntegerType()),
    StructField("order_id", StringType()),
    StructField("product_ids", ArrayType(StringType())),
    StructField("total_amount", DoubleType()),
    StructField("currency", StringType()),
])

LOCATION = StructType([
    StructField("lat", DoubleType()),
    StructField("lon", DoubleType()),
    StructField("facility", StringType()),
])

# Declared payload of a sensor message (7 fields, one nested).
SENSOR_PAYLOAD = StructType([
    StructField("sensor_id", StringType()),
    StructField("sensor_type", StringType()),
    StructField("timestamp", TimestampType()),
    StructField("location", LOCATION),
    StructField("battery_level", DoubleType()),
    StructField("reading", DoubleType()),
    StructField("unit", StringType()),
])

# The counter's declared source row: one column no payload carries, so only
# whether a message decodes matters.
COUNTER_PAYLOAD = StructType([StructField("message", StringType())])

# Lake (sink) rows: 17 and 10 columns.  Timestamps are NTZ at rest.
USER_ACTIVITY_SINK = StructType(
    [StructField("user_id", StringType()), StructField("event_type", StringType()),
     StructField("event_time", TimestampNTZType())]
    + [f for f in USER_ACTIVITY_PAYLOAD.fields[3:]]
    + [StructField("processing_time", TimestampNTZType())])

SENSOR_SINK = StructType([
    StructField("sensor_id", StringType()),
    StructField("sensor_type", StringType()),
    StructField("event_time", TimestampNTZType()),
    StructField("latitude", DoubleType()),
    StructField("longitude", DoubleType()),
    StructField("facility", StringType()),
    StructField("battery_level", DoubleType()),
    StructField("reading", DoubleType()),
    StructField("unit", StringType()),
    StructField("processing_time", TimestampNTZType()),
])

# Warehouse rows (8 and 7 columns), partitioned by day(event_time) [, sensor_type].
WAREHOUSE_USER_ACTIVITY = StructType([
    StructField("user_id", StringType()),
    StructField("event_type", StringType()),
    StructField("event_time", TimestampNTZType()),
    StructField("session_id", StringType()),
    StructField("ip_address", StringType()),
    StructField("user_agent", StringType()),
    StructField("page_url", StringType()),
    StructField("total_amount", DoubleType()),
])

WAREHOUSE_SENSOR_DATA = StructType([
    StructField("sensor_id", StringType()),
    StructField("sensor_type", StringType()),
    StructField("event_time", TimestampNTZType()),
    StructField("latitude", DoubleType()),
    StructField("longitude", DoubleType()),
    StructField("facility", StringType()),
    StructField("sensor_value", DoubleType()),
])

# Declared, unenforced primary keys.
USER_ACTIVITY_KEY = ("user_id", "session_id")
SENSOR_DATA_KEY = ("sensor_id",)

USER_ACTIVITY_PARTITIONS = ("event_date",)
SENSOR_DATA_PARTITIONS = ("event_date", "sensor_type")

FAMILIES = {
    "user_activity": dict(topic=USER_ACTIVITY_TOPIC, payload=USER_ACTIVITY_PAYLOAD,
                          sink=USER_ACTIVITY_SINK, key=USER_ACTIVITY_KEY, key_field="user_id"),
    "sensor_data": dict(topic=SENSOR_DATA_TOPIC, payload=SENSOR_PAYLOAD,
                        sink=SENSOR_SINK, key=SENSOR_DATA_KEY, key_field="sensor_id"),
}
