"""The analytics views and check queries.

All are single-pass hash aggregations: partial aggregation runs before the
shuffle, so a hot group (one event type holding a third of the rows) costs one
partial row per input partition, not a hot reducer.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.functions.timefn import day_trunc, hour_trunc
from tidewater.sources.lake import read_range


def hourly_user_activity(ua: DataFrame) -> DataFrame:
    """(hour, event_type, event_count); NULL event_time rows form a NULL hour group."""
    return (ua.groupBy(hour_trunc("event_time").alias("hour"), F.col("event_type"))
            .agg(F.count(F.lit(1)).alias("event_count")))


def sensor_stats(sd: DataFrame, value_col: str = "sensor_value") -> DataFrame:
    """(hour, sensor_type, facility, reading_count, avg/min/max of the value).
    COUNT(*) counts NULL readings; AVG/MIN/MAX skip them."""
    v = F.col(value_col)
    return (sd.groupBy(hour_trunc("event_time").alias("hour"), F.col("sensor_type"), F.col("facility"))
            .agg(F.count(F.lit(1)).alias("reading_count"), F.avg(v).alias("avg_value"),
                 F.min(v).alias("min_value"), F.max(v).alias("max_value")))


def event_type_distribution(ua: DataFrame) -> DataFrame:
    return ua.groupBy("event_type").agg(F.count(F.lit(1)).alias("event_count"))


def sensor_type_avg(sd: DataFrame, value_col: str = "sensor_value") -> DataFrame:
    return sd.groupBy("sensor_type").agg(F.avg(value_col).alias("avg_value"))


def table_counts(ua: DataFrame, sd: DataFrame) -> DataFrame:
    """One row (user_count, sensor_count) from one aggregation over both tables:
    each row is tagged with its table, partial counts per partition, one final
    row.  The scans read no columns (Parquet row counts only)."""
    tagged = (ua.select(F.lit(True).alias("_u"))
              .unionByName(sd.select(F.lit(False).alias("_u"))))
    return tagged.agg(F.count_if(F.col("_u")).alias("user_count"),
                      F.count_if(~F.col("_u")).alias("sensor_count"))


def data_present(counts: DataFrame) -> bool:
    """Gate: both tables hold rows."""
    r = counts.first()
    return bool(r and r["user_count"] > 0 and r["sensor_count"] > 0)


def activity_rollup(ua: DataFrame) -> DataFrame:
    """Counts at day / day+hour / day+hour+type / grand-total grains for drill-down.
    ``grain`` is grouping_id(day, hour, event_type)."""
    return (ua.select(day_trunc("event_time").alias("day"), hour_trunc("event_time").alias("hour"),
                      "event_type")
            .rollup("day", "hour", "event_type")
            .agg(F.grouping_id("day", "hour", "event_type").alias("grain"),
                 F.count(F.lit(1)).alias("event_count")))


def filter_drilldown(sd: DataFrame, lo: str, hi: str, sensor_type: str | None = None,
                     facility: str | None = None, value_col: str = "sensor_value") -> DataFrame:
    """Drill-down: ``sensor_stats`` restricted to hours in [lo, hi) (hour-aligned
    bounds) and optionally one type and facility.  The predicates are put on the
    raw rows so the time and type bounds reach the Parquet scan (PushedFilters);
    on a table partitioned by day and type both prune directories."""
    rows = read_range(sd, lo, hi)
    if sensor_type is not None:
        rows = rows.where(F.col("sensor_type") == sensor_type)
    if facility is not None:
        rows = rows.where(F.col("facility") == facility)
    return sensor_stats(rows, value_col)
