"""Table lifecycle queries: pruned range reads, as-of reads, schema evolution,
declared-key operators, data-quality report."""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from tidewater.operators import keys as K
from tidewater.operators import quality as Q
from tidewater.operators.conform import conform_user_activity
from tidewater.plans.batch import CORRUPT_EVERY
from tidewater.plans.oracle_base import SD, UA, WUA, with_
from tidewater.plans.registry import query
from tidewater.session import run_dir
from tidewater.sources import bindings as B
from tidewater.sources import lake as L

RANGE_LO, RANGE_HI = "2024-01-05 06:00:00", "2024-01-09 18:30:00"


@query("partition_pruned_range", with_(WUA) + f"""
SELECT user_id, event_type, event_time, session_id, ip_address, user_agent, page_url, total_amount,
       CAST(event_time AS DATE) AS event_date
FROM wua WHERE event_time >= TIMESTAMP '{RANGE_LO}' AND event_time < TIMESTAMP '{RANGE_HI}'""")
def q_partition_pruned_range(spark, sf_dir):
    """Warehouse table written partitioned by day; the range read prunes days."""
    return L.read_range(spark.read.parquet(_warehouse_table(spark, sf_dir)), RANGE_LO, RANGE_HI)


def _warehouse_table(spark, sf_dir):
    """The day-partitioned warehouse user-activity table, written for this run."""
    path = os.path.join(run_dir(spark, "warehouse"), "user_activity")
    L.write_partitioned(conform_user_activity(B.user_activity(spark, sf_dir)), path)
    return path


FIRST_HALF_SQL = "event_id < (SELECT MIN(event_id) + (MAX(event_id) - MIN(event_id) + 1) // 2 FROM events)"


@query("as_of_read", with_(UA) + f"""
SELECT user_id, event_type, event_time, order_id FROM ua WHERE {FIRST_HALF_SQL}""")
def q_as_of_read(spark, sf_dir):
    """Two waves go through the processor, each a batch; the read as of an instant at which
    the second was running (its rows are stamped, its entry is not written) gives the first,
    though both have landed since."""
    from tidewater.plans.batch import user_envelope
    from tidewater.sources.broker import publish, read_events
    from tidewater.streaming import batches, ingest as I
    run = run_dir(spark, "as_of")
    topic, table, schema = os.path.join(run, "topic"), os.path.join(run, "table"), I.table_schema("user_activity")
    env, split = user_envelope(spark, sf_dir), _middle(spark, sf_dir)
    for wave in (F.col("offset") < split, F.col("offset") >= split):
        publish(env.where(wave), topic)
        I.run_to_end(I.start_processor(read_events(spark, "user_activity", topic), "user_activity", table,
                                       table + "_dead_letters", os.path.join(run, "ckpt"), I.TEST_TRIGGER))
    began = batches.read(spark, table, schema).agg(F.max("processing_time").cast("string")).first()[0]
    rows = batches.read_as_of(spark, table, schema, began or "2024-01-01 00:00:00")
    return rows.select("user_id", "event_type", "event_time", "order_id")


def _middle(spark, sf_dir):
    r = B.read_table(spark, sf_dir, "events").agg(F.min("event_id").alias("lo"), F.max("event_id").alias("hi")).first()
    return r["lo"] + (r["hi"] - r["lo"] + 1) // 2 if r["lo"] is not None else 0


EVOLVE_SPLIT_SQL = "(SELECT MIN(event_id) + (MAX(event_id) - MIN(event_id) + 1) // 2 FROM events)"


@query("schema_evolution", with_(UA) + f"""
SELECT event_id, user_id, event_type, event_time, page_url,
       CASE WHEN event_id >= {EVOLVE_SPLIT_SQL} THEN total_amount END AS total_amount,
       CASE WHEN event_id >= {EVOLVE_SPLIT_SQL} THEN currency END AS currency
FROM ua""")
def q_schema_evolution(spark, sf_dir):
    """Older files lack the columns added later; a read by the declared current schema
    returns NULL for them on old rows and the values on new rows."""
    ua, split = B.user_activity(spark, sf_dir), _middle(spark, sf_dir)
    path = os.path.join(run_dir(spark, "evolve"), "user_activity")
    v1 = ua.where(F.col("event_id") < split).select("event_id", "user_id", "event_type", "event_time", "page_url")
    v2 = ua.where(F.col("event_id") >= split).select("event_id", "user_id", "event_type", "event_time",
                                                      "page_url", "total_amount", "currency")
    v1.write.parquet(path)
    v2.write.mode("append").parquet(path)
    return L.read_evolving(spark, path, v2.schema)


@query("latest_by_key", with_(SD) + """
SELECT sensor_id, sensor_type, event_time, latitude, longitude, facility, battery_level, reading, unit,
       processing_time, event_id
FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY sensor_id ORDER BY event_time DESC, event_id DESC) AS rn FROM sd)
WHERE rn = 1""")
def q_latest_by_key(spark, sf_dir):
    return K.latest_by_key(B.sensor_data(spark, sf_dir), ["sensor_id"], ["event_time", "event_id"])


@query("key_violations", with_(UA) + """
SELECT user_id, session_id, COUNT(*) AS row_count FROM ua GROUP BY 1, 2 HAVING COUNT(*) > 1""")
def q_key_violations(spark, sf_dir):
    return K.key_violations(B.user_activity(spark, sf_dir), ["user_id", "session_id"])


# Rules for the driver-bound rows (same machinery as the reference contract rules).
DRIVER_EVENT_TYPES = ["click", "error", "purchase", "signup", "view"]


def driver_rules():
    et, t = F.col("event_type"), F.lit(True)
    return {
        "event_type_domain": (t, et.isin(DRIVER_EVENT_TYPES)),
        "view_fields": (et == "view", F.col("page_url").isNotNull() & F.col("time_spent").between(5, 300)),
        "click_fields": (et == "click", F.col("element_id").like("btn-%") & F.col("page_url").isNotNull()),
        "purchase_fields": (et == "purchase", F.col("order_id").isNotNull()
                            & F.size("product_ids").between(1, 5) & (F.col("currency") == "USD")
                            & (F.col("total_amount") >= 0)),
        "amount_not_large": (et == "purchase", F.col("total_amount") <= 300),
        "event_time_present": (t, F.col("event_time").isNotNull()
                               & (F.col("event_time") <= F.col("processing_time"))),
    }


def _rule_sql(name, applies, holds):
    return (f"SELECT '{name}' AS rule, CAST(count_if({applies}) AS BIGINT) AS checked, "
            f"CAST(count_if(({applies}) AND NOT coalesce({holds}, FALSE)) AS BIGINT) AS failed FROM ua")


QUALITY_SQL = with_(UA) + "\nUNION ALL\n".join([
    _rule_sql("event_type_domain", "TRUE", "event_type IN ('click', 'error', 'purchase', 'signup', 'view')"),
    _rule_sql("view_fields", "event_type = 'view'", "page_url IS NOT NULL AND time_spent BETWEEN 5 AND 300"),
    _rule_sql("click_fields", "event_type = 'click'", "element_id LIKE 'btn-%' AND page_url IS NOT NULL"),
    _rule_sql("purchase_fields", "event_type = 'purchase'",
              "order_id IS NOT NULL AND len(product_ids) BETWEEN 1 AND 5 AND currency = 'USD' "
              "AND total_amount >= 0"),
    _rule_sql("amount_not_large", "event_type = 'purchase'", "total_amount <= 300"),
    _rule_sql("event_time_present", "TRUE", "event_time IS NOT NULL AND event_time <= processing_time"),
])


@query("quality_report", QUALITY_SQL)
def q_quality_report(spark, sf_dir):
    return Q.rule_report(B.user_activity(spark, sf_dir), driver_rules())


@query("quality_stream", QUALITY_SQL.replace(" FROM ua", f" FROM ua WHERE event_id % {CORRUPT_EVERY} <> 0"))
def q_quality_stream(spark, sf_dir):
    """The quality report of a topic with broken messages, from what the processor observed
    while it wrote its batches: no row is read a second time."""
    from tidewater.plans.streams import _process, _topic
    from tidewater.streaming import batches
    run = run_dir(spark, "quality_stream")
    table = os.path.join(run, "tables", "user_activity")
    _process(spark, _topic(spark, sf_dir, "user_activity", CORRUPT_EVERY), table, os.path.join(run, "ckpt"),
             min_files_per_trigger=4, rules=driver_rules())
    return Q.report_from_log(batches.entries(spark, table))
