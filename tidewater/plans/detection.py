"""Detection queries: z-scores, anomalies, view->purchase pattern, range check, alerts."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewater.operators import detect as D
from tidewater.operators import enrich as EN
from tidewater.operators import views as V
from tidewater.plans import streams as S
from tidewater.plans.batch import R, warehouse_user_activity
from tidewater.plans.oracle_base import SD, UA, WUA, with_
from tidewater.plans.registry import query
from tidewater.sources import bindings as B

N_PREV = 20
Z_THRESHOLD = 2.0

ZSCORE_SQL = with_(SD) + f"""
, s AS (
  SELECT event_id, sensor_id, event_time, reading,
         COUNT(reading) OVER w AS prev_count, AVG(reading) OVER w AS prev_mean,
         STDDEV_SAMP(reading) OVER w AS prev_std
  FROM sd
  WINDOW w AS (PARTITION BY sensor_id ORDER BY event_time, event_id ROWS BETWEEN {N_PREV} PRECEDING AND 1 PRECEDING)
), z AS (
  SELECT *, CASE WHEN prev_std > 0 THEN (reading - prev_mean) / prev_std END AS z_score FROM s
)
SELECT event_id, sensor_id, event_time, reading, prev_count, round(prev_mean, {R}) AS prev_mean,
       round(prev_std, {R}) AS prev_std, round(z_score, {R}) AS z_score FROM z"""


def _readings(spark, sf_dir):
    return B.sensor_data(spark, sf_dir).select("event_id", "sensor_id", "event_time", "reading")


def _round_z(df):
    return df.select("event_id", "sensor_id", "event_time", "reading", "prev_count",
                     *[F.round(c, R).alias(c) for c in ("prev_mean", "prev_std", "z_score")])


@query("sensor_zscores", ZSCORE_SQL)
def q_sensor_zscores(spark, sf_dir):
    return _round_z(D.sensor_zscores(_readings(spark, sf_dir), N_PREV))


ANOMALY_SQL = ZSCORE_SQL + f" WHERE abs(z_score) >= {Z_THRESHOLD}"


@query("sensor_anomalies", ANOMALY_SQL)
def q_sensor_anomalies(spark, sf_dir):
    return _round_z(D.sensor_anomalies(_readings(spark, sf_dir), Z_THRESHOLD, N_PREV))


VIEW_PURCHASE_SQL = with_(UA) + """
, s AS (
  SELECT event_id, user_id, event_type, event_time,
         MAX(CASE WHEN event_type = 'view' THEN event_time END) OVER (
           PARTITION BY user_id ORDER BY event_time, event_id
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS last_view_time
  FROM ua WHERE event_type IN ('view', 'purchase')
)
SELECT event_id, user_id, event_time AS purchase_time, last_view_time FROM s
WHERE event_type = 'purchase' AND last_view_time IS NOT NULL
  AND event_time - last_view_time <= INTERVAL '30 minutes'"""


@query("view_then_purchase", VIEW_PURCHASE_SQL)
def q_view_then_purchase(spark, sf_dir):
    return D.view_then_purchase(B.user_activity(spark, sf_dir))


# Nominal reading range per bound sensor type (parameters of this binding).
DRIVER_RANGES = [("click", 0.0, 400.0), ("error", 0.0, 300.0), ("purchase", 0.0, 350.0),
                 ("signup", 0.0, 300.0), ("view", 0.0, 300.0)]


def _ranges_sql():
    return ("(VALUES " + ", ".join(f"('{t}', CAST({lo} AS DOUBLE), CAST({hi} AS DOUBLE))" for t, lo, hi in DRIVER_RANGES)
            + ") AS l(sensor_type, lo, hi)")


@query("out_of_range", with_(SD) + f"""
SELECT sd.event_id, sd.sensor_id, sd.sensor_type, sd.event_time, sd.reading, l.lo, l.hi
FROM sd JOIN {_ranges_sql()} ON sd.sensor_type = l.sensor_type
WHERE sd.reading < l.lo OR sd.reading > l.hi""")
def q_out_of_range(spark, sf_dir):
    limits = spark.sql(f"SELECT * FROM {_ranges_sql()}")  # a relation whose size the optimizer knows
    sd = B.sensor_data(spark, sf_dir).select("event_id", "sensor_id", "sensor_type", "event_time", "reading")
    return D.out_of_range(sd, limits)


@query("enrich_as_of", with_(UA) + """
SELECT f.event_id, f.user_id, f.event_type, f.event_time, v.plan, v.agent
FROM (SELECT * FROM ua WHERE event_type <> 'signup') f
ASOF LEFT JOIN (SELECT user_id, event_time AS valid_from, session_id AS plan, user_agent AS agent
                FROM ua WHERE event_type = 'signup') v
  ON f.user_id = v.user_id AND f.event_time >= v.valid_from""")
def q_enrich_as_of(spark, sf_dir):
    """Events with what their user's last signup by then had set: a dimension that changes."""
    ua = B.user_activity(spark, sf_dir)
    signups = ua.where("event_type = 'signup'").select(
        "user_id", F.col("event_time").alias("valid_from"), F.col("session_id").alias("plan"), F.col("user_agent").alias("agent"))
    facts = ua.where("event_type <> 'signup'").select("event_id", "user_id", "event_type", "event_time")
    return EN.enrich_as_of(facts, signups, "user_id", "event_time", "event_id", "valid_from", ["plan", "agent"])


ALERT_THRESHOLD = 5


@query("hourly_alerts", with_(WUA) + f"""
SELECT date_trunc('hour', event_time) AS hour, event_type, COUNT(*) AS event_count
FROM wua GROUP BY 1, 2 HAVING COUNT(*) > {ALERT_THRESHOLD}""")
def q_hourly_alerts(spark, sf_dir):
    return D.hourly_alerts(V.hourly_user_activity(warehouse_user_activity(spark, sf_dir)), ALERT_THRESHOLD)


query("sensor_anomalies_stream", ANOMALY_SQL)(S.q_sensor_anomalies_stream)
query("view_then_purchase_stream", VIEW_PURCHASE_SQL)(S.q_view_then_purchase_stream)
