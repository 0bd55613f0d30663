"""Anomaly and pattern detection.

Per-entity sequence operators (previous N readings of a sensor, last view of
a user) are not run as one window per entity: an entity may hold a third of all
rows, and there are only ~100 sensors.  Instead an entity with more than
``target_rows`` rows is cut, in row order, into buckets of about that many rows,
and each (entity, bucket) group gets exactly what it needs from earlier rows,
so parallelism follows the data, not the number of entities.

The cuts are found by counting.  A hot entity's rows are split at quantiles of their
times into cells; a cell that still holds too many rows is split again at quantiles of its
own rows, and so on; an instant that holds too many is a cell of its own and is split at
quantiles of the ids.  Buckets are runs of cells.  So they follow the rows whatever the
density: a stray timestamp, a burst or a crowded instant of any share of the rows changes
nothing.  Rows without a time come first and are cut by their id.  The results do not depend
on the cuts.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidewater.session import checkpointed

TARGET_ROWS = 200_000   # rows per (entity, bucket) group; a window task handles one group
MAX_CUTS = 1_000_000    # at most so many targets in all rows: beyond, the target grows
CELLS_PER_TARGET = 4
FAN_OUT = 64            # quantile ranges of one split
LEVELS = 8              # splits of splits: 64^8 cells; beyond are only rows equal in time and id
BROADCAST_ROWS = 100_000  # counted rows (some 500 bytes each); a larger table is joined by shuffle
STEP = 128              # of a cell's number from one level to the next


def _placed(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """Adds ``_timed`` (has a time; rows without sort first, as in a window), ``_tie``, the id,
    and ``_at``: microseconds from a fixed local origin, which no time zone touches."""
    time, tie = F.col(order[0]), F.col(order[1]).cast("long")
    origin = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return df.withColumns({"_timed": time.isNotNull(), "_tie": F.coalesce(tie, F.lit(-(1 << 62))), "_at": F.coalesce(
        F.timestamp_diff("MICROSECOND", origin, time.cast("timestamp_ntz")), F.lit(0))})


def _hinted(table: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(table) if rows <= BROADCAST_ROWS else table


def _splits(x: DataFrame, key: str, most: float) -> DataFrame:
    """For each open cell of more than ``most`` rows: ``_by_tie``, whether ids split it (all its
    rows are of one instant), and ``_edges``, the least values of the parts after the first.
    Rows equal in time and id are not split."""
    shares = [i / FAN_OUT for i in range(1, FAN_OUT)]
    stats = x.where("_open").groupBy(key, "_timed", "_cell").agg(
        F.count(F.lit(1)).alias("n"), (F.min("_at") == F.max("_at")).alias("_by_tie"), (F.min("_tie") == F.max("_tie")).alias("one_tie"),
        F.percentile_approx("_at", shares).alias("at"), F.percentile_approx("_tie", shares).alias("tie"))
    parts = F.least(F.ceil(F.col("n") / most), F.lit(FAN_OUT)).cast("int")
    found = F.when(F.col("_by_tie"), F.col("tie")).otherwise(F.col("at"))
    edges = F.transform(F.sequence(F.lit(1), parts - 1), lambda j: F.get("found", F.round(j * FAN_OUT / parts).cast("int") - 1))
    # a value that stands at two edges is crowded: it gets a part of its own
    crowded = F.transform(F.filter("edges", lambda e, i: e == F.get("edges", i + 1)), lambda e: e + 1)
    return (stats.where((F.col("n") > most) & ~(F.col("_by_tie") & F.col("one_tie")))
            .withColumn("found", found).withColumn("edges", edges)
            .select(F.col(key).alias("_sk"), F.col("_timed").alias("_st"), F.col("_cell").alias("_sc"), "_by_tie",
                    F.array_sort(F.array_distinct(F.concat("edges", crowded))).alias("_edges")))


def _celled(rows: DataFrame, hot: DataFrame, n_hot: int, key: str, most: float) -> DataFrame:
    """Adds ``_cell``: numbers in row order of a hot key's rows, NULL for other keys."""
    x = rows.join(_hinted(hot.select(F.col(key).alias("_hk"), F.lit(0).cast("long").alias("_cell")), n_hot),
                  rows[key].eqNullSafe(F.col("_hk")), "left").drop("_hk")
    x = x.withColumn("_open", F.col("_cell").isNotNull())
    for _ in range(LEVELS):
        splits = checkpointed(_splits(x, key, most))
        n = splits.count()
        if not n:
            break
        j = x.join(_hinted(splits, n), x["_open"] & x[key].eqNullSafe(splits["_sk"]) & (x["_timed"] == splits["_st"])
                   & (x["_cell"] == splits["_sc"]), "left")
        value = F.when(F.col("_by_tie"), F.col("_tie")).otherwise(F.col("_at"))
        part = F.coalesce(F.size(F.filter("_edges", lambda e: e <= value)), F.lit(0))
        part = F.when(F.col("_edges").isNull(), 0).otherwise(part)
        x = j.withColumns({"_cell": F.col("_cell") * STEP + part, "_open": F.col("_edges").isNotNull()}).drop(*splits.columns)
    return x.drop("_open")


def cut(df: DataFrame, key: str, order: Sequence[str], target_rows: int = TARGET_ROWS, carry: int = 0,
        latest: Column | None = None) -> DataFrame:
    """``df`` with ``_b``, the bucket of each row within its key.  ``carry``: later buckets
    that begin within so many rows after the row's cell also get the row, marked ``_carry``.
    ``latest``: ``_before`` is the largest value of that column in earlier buckets.

    Without a hot key this is one count by key.  With hot keys each level of cells is one
    aggregate over their rows, done while the plan is built.  A bucket holds less than twice
    the target, but for rows equal in time and id.  Tables joined to the rows (hot keys, splits,
    cells) are counted, and broadcast up to ``BROADCAST_ROWS``; a larger cell table is joined by
    (key, cell), where no group is large."""
    rows = _placed(df, order)
    counts = rows.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    target = max(target_rows, -(-rows.count() // MAX_CUTS))
    hot = checkpointed(counts.where(F.col("_n") > target))
    n_hot = hot.count()
    if not n_hot:
        own = {"_b": F.lit(0).cast("long")} | ({"_carry": F.lit(False)} if carry else {})
        if latest is not None:
            own["_before"] = F.lit(None).cast(df.select(latest.alias("c")).schema["c"].dataType)
        return df.withColumns(own)
    x = _celled(rows, hot, n_hot, key, max(1, target / CELLS_PER_TARGET))
    cell = ["_timed", "_cell"]
    aggs = [F.count(F.lit(1)).alias("_cnt")] + ([F.max(latest).alias("_latest")] if latest is not None else [])
    in_order = Window.partitionBy(key).orderBy(*cell)
    so_far = in_order.rowsBetween(Window.unboundedPreceding, 0)
    cells = (x.where(F.col("_cell").isNotNull()).groupBy(key, *cell).agg(*aggs)
             .withColumn("_end", F.sum("_cnt").over(so_far))
             .withColumn("_b", F.floor((F.col("_end") - F.col("_cnt")) / target)))
    added = {}
    if carry:
        next_b = F.lead("_b").over(in_order)
        cells = cells.withColumn("_next", F.when(next_b != F.col("_b"), next_b))
        added["_later"] = F.collect_list("_next").over(
            Window.partitionBy(key).orderBy("_end").rangeBetween(0, carry - 1))
    if latest is not None:
        cells = cells.withColumn("_earlier", F.max("_latest").over(
            in_order.rowsBetween(Window.unboundedPreceding, -1)))
        added["_before"] = F.first("_earlier").over(Window.partitionBy(key, "_b").orderBy(*cell))
    cells = checkpointed(cells.select(F.col(key).alias("_ck"), *[F.col(c).alias(f"_c{c}") for c in cell], "_b",
                                      *[c.alias(name) for name, c in added.items()]))
    x = x.join(_hinted(cells, cells.count()), x[key].eqNullSafe(cells["_ck"]) & (x["_timed"] == cells["_c_timed"])
               & (x["_cell"] == cells["_c_cell"]), "left")
    x = x.withColumn("_b", F.coalesce("_b", F.lit(0)).cast("long"))
    if carry:
        place = F.concat(F.array(F.struct(F.col("_b"), F.lit(False).alias("_carry"))), F.transform(
            F.coalesce("_later", F.array().cast("array<bigint>")), lambda b: F.struct(b.cast("long").alias("_b"), F.lit(True).alias("_carry"))))
        x = x.select(*df.columns, F.inline(place))
    return x.select(*df.columns, "_b", *(["_carry"] if carry else []), *(["_before"] if latest is not None else []))


def previous_rows_stats(df: DataFrame, key: str, value: str, n: int = 20,
                        order: Sequence[str] = ("event_time", "event_id"),
                        target_rows: int = TARGET_ROWS) -> DataFrame:
    """Adds prev_count, prev_mean, prev_std: count, mean and sample standard
    deviation of ``value`` over the previous ``n`` rows of the same ``key``
    (ordered by ``order``: a time, then a numeric id), exactly as a ROWS BETWEEN n
    PRECEDING AND 1 PRECEDING window partitioned by ``key`` would; NULL is a key
    like any other.

    Plan: the cells that hold the last n rows before a bucket are copied to it
    with the shuffle by (key, bucket); one window runs per group and the copies
    are dropped.  One full shuffle, one sort; scans of the key for its counts and, with hot
    keys, of key, time and id for each level of cells."""
    x = cut(df, key, order, target_rows, carry=n)
    w = Window.partitionBy(key, "_b").orderBy(*order).rowsBetween(-n, -1)
    v = F.col(value)
    return (x.withColumn("prev_count", F.count(v).over(w))
            .withColumn("prev_mean", F.avg(v).over(w))
            .withColumn("prev_std", F.stddev_samp(v).over(w))
            .where(~F.col("_carry")).drop("_carry", "_b"))


def zscore(df: DataFrame, value: str) -> DataFrame:
    z = F.when(F.col("prev_std") > 0, (F.col(value) - F.col("prev_mean")) / F.col("prev_std"))
    return df.withColumn("z_score", z)


def sensor_zscores(sd: DataFrame, n: int = 20, value: str = "reading") -> DataFrame:
    """z-score of each reading against the previous n readings of its sensor."""
    return zscore(previous_rows_stats(sd, "sensor_id", value, n), value)


def sensor_anomalies(sd: DataFrame, threshold: float = 2.0, n: int = 20, value: str = "reading") -> DataFrame:
    return sensor_zscores(sd, n, value).where(F.abs(F.col("z_score")) >= threshold)


def view_then_purchase(ua: DataFrame, within_us: int = 30 * 60 * 1_000_000,
                       view: str = "view", purchase: str = "purchase",
                       target_rows: int = TARGET_ROWS) -> DataFrame:
    """Purchases preceded by a view of the same user at most ``within`` earlier:
    (event_id, user_id, purchase_time, last_view_time).

    The last view before a purchase is either earlier in the purchase's own
    (user, bucket) group -- a running max inside the group -- or the latest
    view of any earlier bucket, which the cells' aggregate already has."""
    ev = (ua.where(F.col("event_type").isin(view, purchase))
          .select("event_id", "user_id", "event_type", "event_time"))
    viewed = F.when(F.col("event_type") == view, F.col("event_time"))
    x = cut(ev, "user_id", ("event_time", "event_id"), target_rows, latest=viewed)
    w = (Window.partitionBy("user_id", "_b").orderBy("event_time", "event_id")
         .rowsBetween(Window.unboundedPreceding, -1))
    last = F.greatest(F.col("_same"), F.col("_before"))
    gap = F.timestamp_diff("MICROSECOND", F.col("last_view_time").cast("timestamp_ntz"), F.col("event_time").cast("timestamp_ntz"))
    return (x.withColumn("_same", F.max(viewed).over(w)).where(F.col("event_type") == purchase)
            .withColumn("last_view_time", last).where(gap <= within_us)
            .select("event_id", "user_id", F.col("event_time").alias("purchase_time"), "last_view_time"))


def out_of_range(sd: DataFrame, limits: DataFrame, type_col: str = "sensor_type",
                 value: str = "reading") -> DataFrame:
    """Readings outside their type's nominal [lo, hi].  ``limits`` (one row per type) is
    broadcast if the optimizer sees that it is small; works on a stream as well."""
    lim = limits.select(F.col("sensor_type").alias("_t"), "lo", "hi")
    j = sd.join(lim, sd[type_col] == lim["_t"])
    return j.where((F.col(value) < F.col("lo")) | (F.col(value) > F.col("hi"))).drop("_t")


def hourly_alerts(hourly: DataFrame, threshold: int) -> DataFrame:
    """Rows of the hourly rollup above a threshold."""
    return hourly.where(F.col("event_count") > threshold)
