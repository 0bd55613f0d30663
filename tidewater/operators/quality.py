"""Data-quality validation: contract rules as column expressions, evaluated in
one pass (one partial aggregate per partition, one tiny final row), then
unpivoted to one row per rule."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A rule: name -> (applies-to predicate, must-hold predicate).  A NULL outcome of
# the must-hold predicate counts as a failure.
Rules = dict[str, tuple[Column, Column]]

# The generator's domains for the two reference event families.
USER_EVENT_TYPES = ["page_view", "click", "search", "purchase", "login", "logout"]
SENSOR_TYPES = ["temperature", "humidity", "pressure", "light", "motion"]
# sensor_type: (min reading, max reading, unit)
SENSOR_RANGES = {
    "temperature": (-10.0, 40.0, "C"),
    "humidity": (0.0, 100.0, "%"),
    "pressure": (970.0, 1030.0, "hPa"),
    "light": (0.0, 1000.0, "lux"),
    "motion": (0.0, 1.0, "binary"),
}


def rule_counts(rules: Rules) -> list[Column]:
    """Aggregates ``<rule>.checked`` and ``<rule>.failed`` of every rule."""
    aggs = []
    for name, (applies, holds) in rules.items():
        aggs.append(F.count_if(applies).alias(f"{name}.checked"))
        aggs.append(F.count_if(applies & ~F.coalesce(holds, F.lit(False))).alias(f"{name}.failed"))
    return aggs


def rule_report(df: DataFrame, rules: Rules) -> DataFrame:
    """(rule, checked, failed) for every rule, from a single scan."""
    one = df.agg(*rule_counts(rules))
    stack = ", ".join(f"'{n}', `{n}.checked`, `{n}.failed`" for n in rules)
    return one.select(F.expr(f"stack({len(rules)}, {stack}) AS (rule, checked, failed)"))


def report_from_log(log: DataFrame) -> DataFrame:
    """(rule, checked, failed) from the numbers that a processor's log holds for each batch:
    the same report, without reading a row again."""
    seen = log.select(F.explode("metrics").alias("name", "n")).where(F.col("name").contains("."))
    part, n = F.substring_index("name", ".", -1), F.col("n")
    return (seen.groupBy(F.regexp_extract("name", r"^(.*)\.[a-z]+$", 1).alias("rule"))
            .agg(F.sum(F.when(part == "checked", n)).alias("checked"), F.sum(F.when(part == "failed", n)).alias("failed")))


def user_activity_rules() -> Rules:
    """Contract of the reference generator's user-activity payloads."""
    et, t = F.col("event_type"), F.lit(True)
    return {
        "event_type_domain": (t, et.isin(USER_EVENT_TYPES)),
        "page_view_fields": (et == "page_view",
                             F.col("page_url").isNotNull() & F.col("time_spent").between(5, 300)),
        "click_fields": (et == "click", F.col("element_id").like("btn-%") & F.col("page_url").isNotNull()),
        "search_fields": (et == "search",
                          F.col("search_query").isNotNull() & F.col("results_count").between(0, 100)),
        "purchase_fields": (et == "purchase",
                            F.col("order_id").isNotNull() & F.size("product_ids").between(1, 5)
                            & F.col("total_amount").between(10, 500) & (F.col("currency") == "USD")),
        "event_time_present": (t, F.col("event_time").isNotNull()
                               & (F.col("event_time") <= F.col("processing_time"))),
    }


def sensor_rules() -> Rules:
    st, t = F.col("sensor_type"), F.lit(True)
    in_range = F.lit(False)
    for name, (lo, hi, unit) in SENSOR_RANGES.items():
        in_range = in_range | ((st == name) & F.col("reading").between(lo, hi) & (F.col("unit") == unit))
    return {
        "sensor_type_domain": (t, st.isin(SENSOR_TYPES)),
        "reading_range_and_unit": (t, in_range),
        "battery_level_range": (t, F.col("battery_level").between(0, 100)),
        "event_time_present": (t, F.col("event_time").isNotNull()
                               & (F.col("event_time") <= F.col("processing_time"))),
    }
