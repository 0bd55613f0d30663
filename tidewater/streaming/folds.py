"""Compaction of tables written by micro-batches.

A fold takes the finished batches after the last fold and writes their rows once more, to
``<table>_folds/upto=<n>``: few files, inside each partition in the order of a space-filling
curve over time and entity.  Its entry (``<table>_folds_log``) says which batches it holds,
so the whole table is the folds' rows and those of the batches after the last fold: a late
row arrives in a later batch, whatever its day, and is read from there until the next fold.
Batch ids are kept as a column, so as-of reads work on folded rows as well; ``event_hour``
is added, by whose range files and row groups are skipped (``sources/lake.read_range``).  A fold costs in
proportion to what came since the last one; with ``whole=True`` it takes in all earlier
folds as well.

Folded batch folders may be removed (:func:`drop_folded`) once no reader that began before
the fold is left.
"""

from __future__ import annotations

import time
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from tidewater.functions.timefn import event_hour
from tidewater.operators.cluster import write_clustered
from tidewater.streaming import batches

ROWS_PER_FILE = 2_000_000


def folds_of(table: str) -> str:
    return table.rstrip("/") + "_folds"


def chain(spark: SparkSession, table: str) -> list[int]:
    """The folds that make up the table, latest first, by the last batch they hold.  A fold's
    entry names the batch that it begins after (``upto``)."""
    begins = {r["batch_id"]: r["upto"] for r in batches.entries(spark, folds_of(table)).select("batch_id", "upto").collect()}
    found, at = [], max(begins, default=-1)
    while at >= 0:
        found.append(at)
        at = begins[at]
    return found


def _folded(spark: SparkSession, table: str, schema: StructType, folds: list[int]) -> DataFrame:
    kept = StructType([*schema.fields, StructField("batch_id", LongType()), StructField("event_hour", IntegerType()),
                       StructField("upto", LongType())])
    return spark.read.schema(kept).parquet(folds_of(table)).where(F.col("upto").isin(folds)).drop("upto")


def _with_hour(rows: DataFrame) -> DataFrame:
    return rows.withColumn("event_hour", event_hour("event_time"))


def read_whole(spark: SparkSession, table: str, schema: StructType, upto: int | None = None) -> DataFrame:
    """The table up to a batch (the last finished one): folds and the batches after them."""
    last, folds = batches.last_batch(spark, table) if upto is None else upto, chain(spark, table)
    rest = _with_hour(batches.read(spark, table, schema, after=folds[0] if folds else -1, upto=last))
    if not folds:
        return rest
    rows = _folded(spark, table, schema, folds)
    return (rows if folds[0] <= last else rows.where(F.col("batch_id") <= last)).unionByName(rest)


def read_whole_as_of(spark: SparkSession, table: str, schema: StructType, at: str) -> DataFrame:
    return read_whole(spark, table, schema, batches.batch_as_of(spark, table, at))


def fold(spark: SparkSession, table: str, schema: StructType, partitions: Sequence[str], cluster_by: Sequence[str],
         rows_per_file: int = ROWS_PER_FILE, whole: bool = False) -> int:
    """Fold the finished batches not folded yet; the last batch folded.  Repeating it, or a
    fold that broke off, changes nothing: a fold counts from its entry on."""
    last, folds = batches.last_batch(spark, table), chain(spark, table)
    done = folds[0] if folds else -1
    if last <= done:
        return done
    rows = read_whole(spark, table, schema, last) if whole else _with_hour(batches.read(spark, table, schema, done, last))
    write_clustered(rows, f"{folds_of(table)}/upto={last}", partitions, cluster_by, rows_per_file)
    batches.put_entry(spark, folds_of(table), {"batch_id": last, "finished_us": int(time.time() * 1_000_000),
                                               "upto": -1 if whole else done})
    return last


def drop_folded(spark: SparkSession, table: str) -> None:
    """Remove what the folds hold: batch folders, and folds merged into a whole one."""
    folds = chain(spark, table)
    if folds:
        batches.drop_batches(spark, table, folds[0])
        fs, root = batches.filesystem(spark, folds_of(table))
        for status in fs.listStatus(root):
            name = status.getPath().getName()
            if name.startswith("upto=") and int(name.split("=")[1]) not in folds:
                fs.delete(status.getPath(), True)
