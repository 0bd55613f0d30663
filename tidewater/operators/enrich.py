"""Enrichment and cross-source joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidewater.functions.timefn import hour_trunc
from tidewater.operators import detect as D


def enrich_user_activity(ua: DataFrame, customer: DataFrame, nation: DataFrame, region: DataFrame) -> DataFrame:
    """Events with their customer's c_name, c_mktsegment, n_name and r_name (left joins on
    user_id = c_custkey and the customer's nation and region).  An id that is not a number
    finds no customer.  Works unchanged on a streaming ``ua``.

    Nothing is forced: each dimension is joined by itself, so the optimizer knows its
    projected scan's size and broadcasts it below its own limit; a larger one is joined by
    shuffle, where AQE corrects the choice and splits skewed event partitions."""
    c = customer.select("c_custkey", "c_name", "c_mktsegment", "c_nationkey")
    n = nation.select("n_nationkey", "n_name", "n_regionkey")
    r = region.select("r_regionkey", "r_name")
    return (ua.join(c, ua["user_id"].try_cast("long") == c["c_custkey"], "left")
            .join(n, c["c_nationkey"] == n["n_nationkey"], "left")
            .join(r, n["n_regionkey"] == r["r_regionkey"], "left")
            .select(*[ua[x] for x in ua.columns], "c_name", "c_mktsegment", "n_name", "r_name"))


def enrich_as_of(facts: DataFrame, versions: DataFrame, key: str, time: str, fact_id: str, valid_from: str,
                 columns: list[str], target_rows: int = D.TARGET_ROWS) -> DataFrame:
    """Facts with ``columns`` of the version of their key that was valid at their time: the
    last one with ``valid_from`` <= ``time`` (of several at one instant the greatest values),
    NULL before the first.  ``versions`` has the key under the same name.

    A version holds until the next, so the join is a running maximum over facts and versions
    in one order, a key's versions before its facts at the same instant.  No pairs are made, and
    a hot key is cut into buckets of ``target_rows``, each of which is told the last version
    before it.  Facts without key or time find none; versions without either are left out."""
    kind = facts.schema
    version = F.struct(F.col(valid_from).cast(kind[time].dataType).alias("_from"), *[F.col(c).alias(c) for c in columns])
    v = versions.where(F.col(key).isNotNull() & F.col(valid_from).isNotNull()).select(
        *[F.col(key).cast(f.dataType).alias(key) if f.name == key else
          F.col(valid_from).cast(f.dataType).alias(time) if f.name == time else
          F.lit(None).cast(f.dataType).alias(f.name) for f in kind.fields],
        version.alias("_version"), F.lit(False).alias("_fact"), F.lit(None).cast("long").alias("_tie"))
    least = -(1 << 61)  # below every id, above a version's NULL
    f = facts.select("*", F.lit(None).cast(v.schema["_version"].dataType).alias("_version"), F.lit(True).alias("_fact"),
                     F.coalesce(F.col(fact_id).cast("long"), F.lit(least)).alias("_tie"))
    x = D.cut(f.unionByName(v).withColumnRenamed("_tie", "_order"), key, (time, "_order"), target_rows, latest=F.col("_version"))
    so_far = Window.partitionBy(key, "_b").orderBy(time, "_order").rowsBetween(Window.unboundedPreceding, 0)
    found = F.coalesce(F.max("_version").over(so_far), F.col("_before"))
    valid = F.when(F.col(key).isNotNull() & F.col(time).isNotNull(), F.col("_found"))
    return (x.withColumn("_found", found).where("_fact")
            .select(*[F.col(c) for c in facts.columns], *[valid[c].alias(c) for c in columns]))


def hourly_cross_source(ua: DataFrame, sd: DataFrame, value_col: str = "sensor_value") -> DataFrame:
    """Full outer join of the two families' hourly rollups on hour (they share no
    entity key).  Both inputs are pre-aggregated before the join, so the join
    moves one row per hour per side."""
    a = ua.groupBy(hour_trunc("event_time").alias("hour")).agg(F.count(F.lit(1)).alias("user_events"))
    b = sd.groupBy(hour_trunc("event_time").alias("hour")).agg(
        F.count(F.lit(1)).alias("sensor_readings"), F.avg(value_col).alias("avg_sensor_value"))
    return a.join(b, "hour", "full_outer")
