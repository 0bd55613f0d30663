"""Declared (unenforced) primary keys: latest row per key and key audit.

Both are plain aggregations with partial (map-side) aggregation, so a key that
holds a third of all rows becomes one partial row per input partition before
the shuffle -- no task ever sees a whole hot key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def latest_by_key(df: DataFrame, keys: Sequence[str],
                  order: Sequence[str] = ("event_time", "event_id")) -> DataFrame:
    """One row per key: the row with the greatest ``order`` tuple (later event time,
    then the tie-break column).  Opt-in; never applied on ingest."""
    rest = [c for c in df.columns if c not in keys]
    best = F.max_by(F.struct(*[F.col(c) for c in rest]), F.struct(*[F.col(c) for c in order]))
    return df.groupBy(*keys).agg(best.alias("_row")).select(*keys, *[F.col(f"_row.{c}").alias(c) for c in rest])


def key_violations(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once: (keys..., row_count)."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("row_count")).where(F.col("row_count") > 1)
