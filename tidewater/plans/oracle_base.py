"""The bindings of ``tidewater.sources.bindings`` written as SQL common table
expressions (DuckDB dialect), so every oracle text starts from the same rows."""

EV = """ev AS (
  SELECT *, TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events
)"""

UA = """ua AS (
  SELECT CAST(user_id AS VARCHAR) AS user_id,
         event_type,
         ts AS event_time,
         CAST(user_id AS VARCHAR) || '-' || strftime(ts, '%Y%m%d') AS session_id,
         '10.' || ((user_id // 65536) % 256) || '.' || ((user_id // 256) % 256) || '.' || (user_id % 256) AS ip_address,
         'agent/' || (k % 7) AS user_agent,
         CASE WHEN event_type IN ('view', 'click') THEN '/page/' || k END AS page_url,
         CASE WHEN event_type = 'view' AND k % 10 >= 3 THEN '/page/' || ((k + 1) % 100) END AS referrer,
         CAST(CASE WHEN event_type = 'view' THEN k % 296 + 5 END AS INTEGER) AS time_spent,
         CASE WHEN event_type = 'click' THEN 'btn-' || k END AS element_id,
         CAST(NULL AS VARCHAR) AS search_query,
         CAST(NULL AS INTEGER) AS results_count,
         CASE WHEN event_type = 'purchase' THEN 'order-' || event_id END AS order_id,
         CASE WHEN event_type = 'purchase'
              THEN list_transform(range(0, k % 5 + 1), lambda i: 'prod-' || ((k + i) % 100)) END AS product_ids,
         CASE WHEN event_type = 'purchase' THEN value END AS total_amount,
         CASE WHEN event_type = 'purchase' THEN 'USD' END AS currency,
         ts AS processing_time,
         event_id
  FROM ev
)"""

SD = """sd AS (
  SELECT 'sensor-' || (user_id % 100 + 1) AS sensor_id,
         event_type AS sensor_type,
         ts AS event_time,
         CAST((k - 50) * 1.5 AS DOUBLE) AS latitude,
         CAST((k - 50) * 3.0 AS DOUBLE) AS longitude,
         'facility-' || (k % 10) AS facility,
         CAST(k AS DOUBLE) AS battery_level,
         value AS reading,
         'unit-' || event_type AS unit,
         ts AS processing_time,
         event_id
  FROM ev
)"""

# Warehouse rows (conformed): sensor value renamed.
WUA = """wua AS (
  SELECT user_id, event_type, event_time, session_id, ip_address, user_agent, page_url, total_amount FROM ua
)"""

WSD = """wsd AS (
  SELECT sensor_id, sensor_type, event_time, latitude, longitude, facility, reading AS sensor_value FROM sd
)"""


def with_(*ctes: str) -> str:
    """WITH clause over the named CTEs (dependencies first)."""
    order = [EV, UA, SD, WUA, WSD]
    need = set(ctes)
    if WUA in need:
        need.add(UA)
    if WSD in need:
        need.add(SD)
    need.add(EV)
    return "WITH " + ",\n".join(c for c in order if c in need) + "\n"
