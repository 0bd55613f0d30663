"""Tables written by micro-batches, chained by the batches their sources have finished.

A table is ``<table>/batch_id=<n>`` and, beside it, ``<table>_log/<n>.json``: one small
entry for each finished batch, written after its rows and never again.

* A batch that is replayed after its entry stands is skipped; one replayed before is written
  anew.  So an entry always describes rows that no longer change.
* Readers take the batches that have entries (ids are consecutive, so all up to the last):
  they never see half a batch, nor one that is being overwritten.
* A job that consumes such a table (:func:`follow`) is driven by the entries, not by the data
  files: its own entry says up to which source batch it has come, and its next batch takes
  the whole source batches after that.  Files that a replay names anew are not new rows.
* An entry holds when the batch was finished, the numbers observed while it was written and
  the event-time watermark behind it.  An as-of read resolves an instant to the last batch
  finished by then, so a batch that was running at that instant stays out, also later.

One query writes a table; its checkpoint and its table belong together.
"""

from __future__ import annotations

import json
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType, StructField, StructType

from tidewater.session import filesystem

# One entry of a table's log.  ``upto``: the last source batch taken in, for chained tables.
ENTRY = "batch_id long, finished_us long, upto long, watermark_us long, metrics map<string,long>"
SETTLED_S = 1.0          # an entry is visible so long after its stamp, with room to spare
BATCHES_PER_TRIGGER = 1_000


def log_of(table: str) -> str:
    return table.rstrip("/") + "_log"


def create(spark: SparkSession, table: str) -> None:
    """The empty table, so that its readers may start before its writer."""
    for path in (table, log_of(table)):
        fs, p = filesystem(spark, path)
        fs.mkdirs(p)


def _entry_path(table: str, batch_id: int) -> str:
    return f"{log_of(table)}/{batch_id:012d}.json"


def entry(spark: SparkSession, table: str, batch_id: int) -> dict | None:
    """The entry of one batch, None while it is unfinished."""
    fs, p = filesystem(spark, _entry_path(table, batch_id))
    if not fs.exists(p):
        return None
    rows = spark.read.schema(ENTRY).json(_entry_path(table, batch_id)).collect()
    return rows[0].asDict() if rows else None


def finish(spark: SparkSession, table: str, batch_id: int, **fields) -> None:
    """Write the entry of a batch: beside its place, then renamed into it."""
    before = entry(spark, table, batch_id - 1) if batch_id else None
    now = int(time.time() * 1_000_000)  # never before the batch before, whatever the drivers' clocks
    put_entry(spark, table, {"batch_id": batch_id, "finished_us": max(now, before["finished_us"] + 1 if before else 0), **fields})


def put_entry(spark: SparkSession, table: str, fields: dict) -> None:
    fs, place = filesystem(spark, _entry_path(table, fields["batch_id"]))
    _, beside = filesystem(spark, f"{log_of(table)}/.{fields['batch_id']:012d}.tmp")
    out = fs.create(beside, True)
    out.write(bytearray(json.dumps(fields).encode()))
    out.close()
    if not fs.rename(beside, place):
        raise OSError(f"the entry of batch {fields['batch_id']} of {table} could not be written")


def entries(spark: SparkSession, table: str) -> DataFrame:
    create(spark, table)
    return spark.read.schema(ENTRY).json(log_of(table))


def last_batch(spark: SparkSession, table: str, by_us: int | None = None) -> int:
    """The last finished batch (by an instant), -1 before the first."""
    log = entries(spark, table)
    log = log if by_us is None else log.where(F.col("finished_us") <= by_us)
    found = log.agg(F.max("batch_id")).first()[0]
    return -1 if found is None else found


def read(spark: SparkSession, table: str, schema: StructType, after: int = -1, upto: int | None = None) -> DataFrame:
    """The rows of the finished batches with ``after`` < id <= ``upto``, and their ``batch_id``."""
    upto = last_batch(spark, table) if upto is None else upto
    create(spark, table)
    with_id = StructType([*schema.fields, StructField("batch_id", LongType())])
    return spark.read.schema(with_id).parquet(table).where((F.col("batch_id") > after) & (F.col("batch_id") <= upto))


def instant_us(spark: SparkSession, at: str) -> int:
    """An instant given as local text of the session's zone."""
    return spark.sql("SELECT unix_micros(CAST(:at AS TIMESTAMP)) AS us", args={"at": at}).first()["us"]


def batch_as_of(spark: SparkSession, table: str, at: str) -> int:
    """The last batch finished by ``at``.  An instant is answered once entries stamped by then
    are surely visible: one not yet past waits for so long, one ahead is an error."""
    us = instant_us(spark, at)
    ahead = us / 1_000_000 - time.time()
    if ahead > SETTLED_S:
        raise ValueError(f"{at} is not past yet")
    time.sleep(max(0.0, ahead + SETTLED_S))
    return last_batch(spark, table, us)


def read_as_of(spark: SparkSession, table: str, schema: StructType, at: str) -> DataFrame:
    """The table as it was at ``at``: the same rows whenever it is asked."""
    return read(spark, table, schema, upto=batch_as_of(spark, table, at))


def start(stream: DataFrame, table: str, checkpoint: str, write: Callable[[DataFrame, int], dict | None],
          trigger: dict, query_name: str | None = None) -> StreamingQuery:
    """``write(batch, batch_id)`` puts a micro-batch's rows in place, overwriting what an
    unfinished attempt left, and returns fields of its entry."""
    spark = stream.sparkSession
    create(spark, table)

    def run(batch: DataFrame, batch_id: int) -> None:
        if entry(spark, table, batch_id) is None:
            finish(spark, table, batch_id, **(write(batch, batch_id) or {}))

    w = stream.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint).trigger(**trigger)
    return (w.queryName(query_name) if query_name else w).start()


def follow(spark: SparkSession, source: str, schema: StructType, table: str, checkpoint: str,
           write: Callable[[DataFrame, int, dict | None], dict | None], trigger: dict, query_name: str | None = None,
           batches_per_trigger: int = BATCHES_PER_TRIGGER) -> StreamingQuery:
    """Consume a table batch by batch: ``write(rows, batch_id, before)`` gets the whole source
    batches finished since the entry ``before`` of this table's last batch.  What it gets
    depends on the entries only, so a replayed batch gets the same rows."""
    create(spark, source)
    log = spark.readStream.schema(ENTRY).option("maxFilesPerTrigger", batches_per_trigger).json(log_of(source))

    def run(found: DataFrame, batch_id: int) -> dict:
        before = entry(spark, table, batch_id - 1) if batch_id else None
        after = before["upto"] if before else -1
        upto = max(found.agg(F.max("batch_id")).first()[0], after)
        return {**(write(read(spark, source, schema, after, upto), batch_id, before) or {}), "upto": upto}

    return start(log, table, checkpoint, run, trigger, query_name)


def local_text(spark: SparkSession, us: int) -> str:
    """An instant as local text of the session's zone, to the microsecond."""
    return spark.sql("SELECT CAST(CAST(timestamp_micros(:us) AS TIMESTAMP_NTZ) AS STRING) AS t", args={"us": us}).first()["t"]


def drop_batches(spark: SparkSession, table: str, upto: int) -> None:
    """Remove the folders of batches up to ``upto``; their entries stay."""
    fs, root = filesystem(spark, table)
    for status in fs.listStatus(root):
        name = status.getPath().getName()
        if name.startswith("batch_id=") and int(name.split("=")[1]) <= upto:
            fs.delete(status.getPath(), True)
