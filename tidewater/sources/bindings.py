"""Bindings from the driver's tables to the two event families.

The driver's ``events`` table (event_id, ts, user_id, event_type, value, props)
stands in for both topics.  Every derived column is a plain expression that an
independent SQL engine can repeat (see ``tidewater.plans.oracle``).  Only
projections: Catalyst prunes the Parquet scan to the columns a query uses.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _k() -> Column:
    return F.get_json_object(F.col("props"), "$.k").try_cast("int")


def bind_user_activity(events: DataFrame) -> DataFrame:
    """events -> user-activity sink rows (17 columns) + event_id.

    processing_time is bound to ts so that as-of reads are reproducible."""
    uid = F.col("user_id")
    et = F.col("event_type")
    k = _k()
    view, click, purchase = et == "view", et == "click", et == "purchase"
    uid_s = uid.cast("string")
    return events.select(
        uid_s.alias("user_id"),
        et.alias("event_type"),
        F.col("ts").alias("event_time"),
        F.concat(uid_s, F.lit("-"), F.date_format("ts", "yyyyMMdd")).alias("session_id"),
        F.concat_ws(".", F.lit("10"), F.expr("(user_id div 65536) % 256").cast("string"),
                    F.expr("(user_id div 256) % 256").cast("string"),
                    (uid % 256).cast("string")).alias("ip_address"),
        F.concat(F.lit("agent/"), (k % 7).cast("string")).alias("user_agent"),
        F.when(view | click, F.concat(F.lit("/page/"), k.cast("string"))).alias("page_url"),
        F.when(view & (k % 10 >= 3),
               F.concat(F.lit("/page/"), ((k + 1) % 100).cast("string"))).alias("referrer"),
        F.when(view, k % 296 + 5).cast("int").alias("time_spent"),
        F.when(click, F.concat(F.lit("btn-"), k.cast("string"))).alias("element_id"),
        F.lit(None).cast("string").alias("search_query"),
        F.lit(None).cast("int").alias("results_count"),
        F.when(purchase, F.concat(F.lit("order-"), F.col("event_id").cast("string"))).alias("order_id"),
        F.when(purchase, F.transform(F.sequence(F.lit(0), k % 5),
                                     lambda i: F.concat(F.lit("prod-"), ((k + i) % 100).cast("string"))))
         .alias("product_ids"),
        F.when(purchase, F.col("value")).alias("total_amount"),
        F.when(purchase, F.lit("USD")).alias("currency"),
        F.col("ts").alias("processing_time"),
        F.col("event_id"),
    )


def bind_sensor_data(events: DataFrame) -> DataFrame:
    """events -> sensor sink rows (10 columns) + event_id."""
    k = _k()
    return events.select(
        F.concat(F.lit("sensor-"), (F.col("user_id") % 100 + 1).cast("string")).alias("sensor_id"),
        F.col("event_type").alias("sensor_type"),
        F.col("ts").alias("event_time"),
        ((k - 50) * 1.5).cast("double").alias("latitude"),
        ((k - 50) * 3.0).cast("double").alias("longitude"),
        F.concat(F.lit("facility-"), (k % 10).cast("string")).alias("facility"),
        k.cast("double").alias("battery_level"),
        F.col("value").alias("reading"),
        F.concat(F.lit("unit-"), F.col("event_type")).alias("unit"),
        F.col("ts").alias("processing_time"),
        F.col("event_id"),
    )


def user_activity_payload(events: DataFrame) -> DataFrame:
    """Payload-shaped frame (declared field names, ``timestamp`` column) + event_id."""
    b = bind_user_activity(events)
    return b.withColumnRenamed("event_time", "timestamp").drop("processing_time")


def sensor_payload(events: DataFrame) -> DataFrame:
    b = bind_sensor_data(events)
    return b.select("sensor_id", "sensor_type", F.col("event_time").alias("timestamp"),
                    F.struct(F.col("latitude").alias("lat"), F.col("longitude").alias("lon"),
                             F.col("facility")).alias("location"),
                    "battery_level", "reading", "unit", "event_id")


def user_activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bind_user_activity(read_table(spark, sf_dir, "events"))


def sensor_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bind_sensor_data(read_table(spark, sf_dir, "events"))


def family_payload(spark: SparkSession, sf_dir: str, family: str) -> DataFrame:
    ev = read_table(spark, sf_dir, "events")
    return user_activity_payload(ev) if family == "user_activity" else sensor_payload(ev)
