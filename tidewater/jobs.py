"""Long-running jobs:

* ``user_activity``, ``sensor_data``: processors, topic -> lake table and dead letters;
* ``message_counter``: 10 s counts of a topic's messages by arrival time;
* ``warehouse``: a processor's table -> the warehouse table the views read;
* ``compact``: folds a warehouse table's new batches into few clustered files (runs once);
* ``anomalies``: z-score anomalies of sensors; ``conversions``: purchases after a page view;
* ``alerts``: hourly counts above a threshold; ``enrich``: events with their customer.

    python -m tidewater.jobs user_activity --topic-path ... --table ... --checkpoint ...
    # on a cluster: zip the package and ship it with the driver script
    spark-submit --py-files tidewater.zip tidewater/jobs.py sensor_data --table ... --checkpoint ...

Each job owns its checkpoint folder (its independent consumer progress).
Broker sources are used when ``--kafka`` is given and the connector is on the
class path; otherwise the topic is a folder of envelope files.
"""

from __future__ import annotations

import argparse
import os

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import DateType, StructField, StructType

from tidewater.config import load_config
from tidewater.operators import conform as C
from tidewater.operators import enrich as EN
from tidewater.sources import bindings as B
from tidewater.schemas import WAREHOUSE_SENSOR_DATA, WAREHOUSE_USER_ACTIVITY
from tidewater.sources.broker import read_events
from tidewater.streaming import alerts as A
from tidewater.streaming import batches, folds
from tidewater.streaming import carry as CA
from tidewater.streaming import ingest as I
from tidewater.streaming import windows as W


COUNTER_INTERVAL = "5 seconds"  # below the counter's 10 s window


def _source(spark, family, args, job):
    cfg = load_config(args.env)
    if args.kafka:
        cfg["source"] = "kafka"
    if args.max_offsets_per_trigger:
        cfg["maxOffsetsPerTrigger"] = args.max_offsets_per_trigger
    return read_events(spark, family, args.topic_path, cfg=cfg, group_prefix=job,
                       max_files_per_trigger=args.max_files_per_trigger)


def _trigger(args, interval: str | None = None) -> dict:
    return I.TEST_TRIGGER if args.available_now else {"processingTime": args.interval or interval or "60 seconds"}


def _checkpoint(args, name: str) -> str:
    return os.path.join(args.checkpoint, name)


def processor(spark: SparkSession, family: str, args) -> list[StreamingQuery]:
    """Topic -> sink rows -> partitioned Parquet; undecodable messages -> dead-letter
    table; one read and one parse for both."""
    job = f"{family.replace('_', '-')}-processor"
    return [I.start_processor(_source(spark, family, args, job), family, args.table,
                              args.table.rstrip("/") + "_dead_letters", _checkpoint(args, "ingest"),
                              trigger=_trigger(args), query_name=job, files_per_partition=args.files_per_partition)]


def message_counter(spark: SparkSession, args) -> list[StreamingQuery]:
    """10 s counts of decodable sensor messages by arrival time; each batch logs its own."""
    source, trigger = _source(spark, "sensor_data", args, "message-counter-job"), _trigger(args, COUNTER_INTERVAL)
    if args.console:
        return [I.console_sink(W.arrival_window_count(source), trigger, output_mode="update")]
    return [W.start_partial_log(source, W.arrival_window_count, args.table, _checkpoint(args, "counter"), trigger)]


CONFORM = {"user_activity": C.conform_user_activity, "sensor_data": C.conform_sensor_data}


def start_warehouse(spark: SparkSession, family: str, source: str, table: str, checkpoint: str, trigger: dict,
                    **how) -> StreamingQuery:
    """A processor's table, finished batch by finished batch, conformed and appended to the
    warehouse table.  Neither side's replays add or lose rows, and the job may start first."""
    def write(rows, batch_id: int, before: dict | None) -> None:
        (CONFORM[family](rows, with_partition=True).write.mode("overwrite")
         .partitionBy(*I.PARTITIONS[family]).parquet(f"{table}/batch_id={batch_id}"))
    return batches.follow(spark, source, I.table_schema(family), table, checkpoint, write, trigger, **how)


def warehouse(spark: SparkSession, args) -> list[StreamingQuery]:
    return [start_warehouse(spark, args.family, args.source, args.table, _checkpoint(args, "warehouse"), _trigger(args))]


CLUSTER_BY = {"user_activity": ["event_time", "user_id"], "sensor_data": ["event_time", "sensor_id"]}


def warehouse_schema(family: str) -> StructType:
    """The rows of a warehouse table."""
    fields = {"user_activity": WAREHOUSE_USER_ACTIVITY, "sensor_data": WAREHOUSE_SENSOR_DATA}[family].fields
    return StructType([*fields, StructField("event_date", DateType())])


def read_warehouse(spark: SparkSession, family: str, table: str, upto: int | None = None):
    """The whole warehouse table, folded or not, as the views read it."""
    return folds.read_whole(spark, table, warehouse_schema(family), upto).drop("batch_id")


def compact(spark: SparkSession, args) -> list[StreamingQuery]:
    """Fold what has come since the last run; ``--drop`` removes what earlier runs folded."""
    if args.drop:
        folds.drop_folded(spark, args.table)
    folds.fold(spark, args.table, warehouse_schema(args.family), I.PARTITIONS[args.family], CLUSTER_BY[args.family],
               args.rows_per_file, args.whole)
    return []


def alerts(spark: SparkSession, args) -> list[StreamingQuery]:
    events = I.decoded_events(_source(spark, "user_activity", args, "alerts-job"), "user_activity")
    return [A.start_hourly_alerts(events, args.threshold, args.table, _checkpoint(args, "alerts"), _trigger(args))]


def anomalies(spark: SparkSession, args) -> list[StreamingQuery]:
    decoded = I.decoded_events(_source(spark, "sensor_data", args, "anomalies-job"), "sensor_data", watermark=None)
    return [CA.start_sensor_anomalies(CA.sensor_readings(decoded), args.table, _checkpoint(args, "anomalies"), _trigger(args))]


def conversions(spark: SparkSession, args) -> list[StreamingQuery]:
    decoded = I.decoded_events(_source(spark, "user_activity", args, "conversions-job"), "user_activity", watermark=None)
    return [CA.start_view_then_purchase(CA.user_events(decoded), args.table, _checkpoint(args, "conversions"), _trigger(args),
                                        view="page_view")]


def enrich(spark: SparkSession, args) -> list[StreamingQuery]:
    """``--source``: the folder of the customer, nation and region tables."""
    rows = I.ingest_frame(_source(spark, "user_activity", args, "enrich-job"), "user_activity")
    out = EN.enrich_user_activity(rows, *[B.read_table(spark, args.source, t) for t in ("customer", "nation", "region")])
    return [out.writeStream.format("parquet").outputMode("append").partitionBy("event_date").option("path", args.table)
            .option("checkpointLocation", _checkpoint(args, "enrich")).trigger(**_trigger(args)).start()]


JOBS = {"message_counter": message_counter, "warehouse": warehouse, "compact": compact, "alerts": alerts, "enrich": enrich,
        "anomalies": anomalies, "conversions": conversions,
        **{f: (lambda spark, args, f=f: processor(spark, f, args)) for f in CONFORM}}


def await_all(spark: SparkSession, queries: list[StreamingQuery]) -> None:
    """Wait for every query; if one fails, stop the others and raise its error."""
    try:
        while any(q.isActive for q in queries):
            spark.streams.awaitAnyTermination()
            spark.streams.resetTerminated()
    finally:
        for q in queries:
            q.stop()
    for q in queries:
        if q.exception() is not None:
            raise q.exception()


def main(argv=None):
    ap = argparse.ArgumentParser(prog="tidewater.jobs")
    ap.add_argument("job", choices=sorted(JOBS))
    ap.add_argument("--topic-path")
    ap.add_argument("--table", required=True)
    ap.add_argument("--checkpoint", help="folder of the job's progress; needed by all jobs but compact")
    ap.add_argument("--source", help="input table of warehouse; dimension folder of enrich")
    ap.add_argument("--family", choices=sorted(CONFORM), default="user_activity")
    ap.add_argument("--rows-per-file", type=int, default=folds.ROWS_PER_FILE, help="compact: rows a file")
    ap.add_argument("--whole", action="store_true", help="compact: take in all earlier folds")
    ap.add_argument("--drop", action="store_true", help="compact: first remove the batch folders that earlier runs folded")
    ap.add_argument("--threshold", type=int, default=1000, help="alerts: events an hour")
    ap.add_argument("--env", default="local")
    ap.add_argument("--kafka", action="store_true")
    ap.add_argument("--console", action="store_true")
    ap.add_argument("--interval", help="trigger interval; 60 seconds, for the counter 5 seconds")
    ap.add_argument("--available-now", action="store_true")
    ap.add_argument("--profile", choices=["local", "cluster"], default="cluster")
    ap.add_argument("--max-files-per-trigger", type=int, help="bound on files per micro-batch")
    ap.add_argument("--max-offsets-per-trigger", type=int, help="bound on broker messages per micro-batch")
    ap.add_argument("--files-per-partition", type=int,
                    help="bound on files per table partition per micro-batch (adds one shuffle; for backfills)")
    args = ap.parse_args(argv)
    if args.job != "compact" and not args.checkpoint:
        ap.error("--checkpoint is needed")
    from tidewater.session import STREAMING_STATE_PARTITIONS, get_spark
    # State of the windowed jobs lives in RocksDB (off-heap, spills to local disk,
    # snapshots to the checkpoint) rather than on the JVM heap.
    spark = get_spark(profile=args.profile, shuffle_partitions=None, extra={
        "spark.sql.streaming.stateStore.providerClass":
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        "spark.sql.shuffle.partitions": STREAMING_STATE_PARTITIONS if args.profile == "cluster" else "8"})
    spark.streams.resetTerminated()  # a query that failed earlier in this session is not this job's
    queries = JOBS[args.job](spark, args)
    await_all(spark, queries)
    return queries


if __name__ == "__main__":
    import sys
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    main()
