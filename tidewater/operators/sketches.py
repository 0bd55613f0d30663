"""Distinct counts and quantiles at several grains without rescanning the raw rows.

Each hour (and group) keeps mergeable sketches: HLL for distinct entities, KLL for the
values' quantiles.  Hours add up to days and days to the whole by merging sketches, and so do
micro-batches: a stream logs the partials of its own rows (``streaming/windows``).  A row of
partials has a bounded size whatever its rows.

Errors: with ``LG_K`` = 12 the standard error of a distinct count is 1.04 / sqrt(2^12), 1.6 %;
with ``K`` = 200 the rank of a quantile is off by at most 1.65 % of the rows in 99 % of cases.
Counts are exact.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.functions.timefn import day_trunc, hour_trunc

LG_K, K = 12, 200
COUNT_ERROR, RANK_ERROR = 1.04 / 2 ** (LG_K / 2), 0.0165


def sketch_partials(rows: DataFrame, entity: str, value: str, groups: Sequence[str] = (), time_col: str = "event_time") -> DataFrame:
    """hour, groups, event_count and the two sketches of each hour's rows; NULL entities and
    values are not counted in the sketches."""
    return rows.groupBy(hour_trunc(time_col).alias("hour"), *groups).agg(
        F.count(F.lit(1)).alias("event_count"), F.hll_sketch_agg(entity, F.lit(LG_K)).alias("entities"),
        F.kll_sketch_agg_double(F.col(value).cast("double"), F.lit(K)).alias("values"))


def sketch_rollup(partials: DataFrame, groups: Sequence[str] = (), quantiles: Sequence[float] = (0.5, 0.95)) -> DataFrame:
    """day, hour, groups, grain, event_count, entities (estimated) and ``quantiles`` at the
    grains day + hour + groups, day + hour, day and all.  ``grain`` is their grouping_id."""
    keys = ["day", "hour", *groups]
    merged = (partials.withColumn("day", day_trunc("hour")).rollup(*keys)
              .agg(F.grouping_id(*keys).alias("grain"), F.sum("event_count").alias("event_count"),
                   F.hll_sketch_estimate(F.hll_union_agg("entities")).alias("entities"), F.kll_merge_agg_double("values").alias("_kll")))
    found = F.when(F.kll_sketch_get_n_double("_kll") > 0, F.kll_sketch_get_quantile_double(
        "_kll", F.array(*[F.lit(float(q)) for q in quantiles])))
    return merged.withColumn("quantiles", found).drop("_kll")
