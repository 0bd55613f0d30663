"""The latest row of every key, kept up to date batch by batch.

The state is a bucketed table: hashed by key into a fixed number of files, sorted by key
within each.  A micro-batch is reduced to its latest row per key (partial aggregates first, so
a hot key is one row a task), dealt to the same buckets and merged with the state bucket by
bucket: the state is read where it lies, it is neither shuffled nor sorted.  The merged rows
are the next version, ``<table>/batch_id=<n>``, valid from its entry on; version n is made of
version n - 1 and the batch alone, so replays change nothing.  Versions before the last but
one are removed.

Keys are compared as equal values, NULL like any other.  Ties in the order columns go to the
greater row.
"""

from __future__ import annotations

import zlib
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from tidewater.operators import keys as K
from tidewater.session import filesystem
from tidewater.streaming import batches

HASHED = "_key"


def _name(table: str, batch_id: int) -> str:
    """A name for one version in the session's catalog; the files are found by their place."""
    return f"latest_{zlib.crc32(table.encode()):08x}_{batch_id}"


def state(spark: SparkSession, table: str, schema: StructType, buckets: int, batch_id: int) -> DataFrame:
    """One version as the bucketed table it was written as, also in a new session."""
    name, columns = _name(table, batch_id), ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(f"CREATE TABLE {name} ({columns}, {HASHED} STRING) USING parquet CLUSTERED BY ({HASHED}) SORTED BY ({HASHED}) "
              f"INTO {buckets} BUCKETS LOCATION '{table}/batch_id={batch_id}'")
    return spark.table(name)


def hashed(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """With the key as one text column that is never NULL, which buckets are dealt by."""
    return rows.withColumn(HASHED, F.to_json(F.struct(*keys), {"ignoreNullFields": "false"}))


def merged(old: DataFrame | None, new: DataFrame, order: Sequence[str], buckets: int) -> DataFrame:
    """One row per key of both, the greater in ``order``; ``new`` is dealt as ``old`` lies."""
    if old is None:
        return new.repartition(buckets, HASHED)
    columns = [c for c in new.columns if c != HASHED]
    row = lambda side: F.struct(*[F.col(f"{side}.{c}").alias(c) for c in [*order, *[c for c in columns if c not in order]]])
    a, b = old.alias("o"), new.repartition(buckets, HASHED).alias("n")
    j = a.join(b, F.col(f"o.{HASHED}") == F.col(f"n.{HASHED}"), "full_outer")
    # of a missing side every column is NULL; greatest() takes the other side's row then
    both = F.greatest(F.when(F.col(f"o.{HASHED}").isNotNull(), row("o")), F.when(F.col(f"n.{HASHED}").isNotNull(), row("n")))
    return j.select(F.coalesce(f"o.{HASHED}", f"n.{HASHED}").alias(HASHED), both.alias("_row")).select(
        *[F.col(f"_row.{c}").alias(c) for c in columns], HASHED)


def start_latest(events: DataFrame, table: str, checkpoint: str, trigger: dict, keys: Sequence[str],
                 order: Sequence[str] = ("event_time", "event_id"), buckets: int | None = None) -> StreamingQuery:
    """``buckets``: fixed for the table's life; by default the session's shuffle partitions."""
    spark = events.sparkSession
    n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))

    def write(batch: DataFrame, batch_id: int) -> None:
        new = hashed(K.latest_by_key(batch, keys, order).select(*events.columns), keys)
        old = state(spark, table, events.schema, n, batch_id - 1) if batch_id else None
        fs, place = filesystem(spark, f"{table}/batch_id={batch_id}")
        fs.delete(place, True)  # what an attempt without an entry left
        spark.sql(f"DROP TABLE IF EXISTS {_name(table, batch_id)}")
        (merged(old, new, order, n).write.bucketBy(n, HASHED).sortBy(HASHED).format("parquet")
         .option("path", f"{table}/batch_id={batch_id}").saveAsTable(_name(table, batch_id)))
        _, gone = filesystem(spark, f"{table}/batch_id={batch_id - 2}")
        fs.delete(gone, True)

    return batches.start(events, table, checkpoint, write, trigger, "latest-by-key")


def read_latest(spark: SparkSession, table: str, schema: StructType) -> DataFrame:
    last = batches.last_batch(spark, table)
    return batches.read(spark, table, schema, after=last - 1, upto=last).drop("batch_id")
