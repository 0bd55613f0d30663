"""Streaming ingest: envelope -> lenient decode -> watermark -> sink row ->
append to a date-partitioned Parquet table.

Exactly-once: the Parquet file sink commits each micro-batch through its own
metadata log, and the source offsets through the checkpoint, so a restarted or
re-run query adds no duplicate rows.  The processor, which writes rows and dead
letters from one parse, writes a folder per micro-batch and a log of finished ones.  Stateless:
the watermark is declared (the table is an event-time table) but drops nothing
here; late rows are kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import DateType, StructField, StructType

from tidewater.functions.codec import dead_letters, decode, decode_valid, split_dead_letters, valid_rows
from tidewater.functions.timefn import event_date, to_rest
from tidewater.operators.conform import sensor_sink_row, user_activity_sink_row
from tidewater.operators.quality import Rules, rule_counts
from tidewater.schemas import FAMILIES, SENSOR_DATA_PARTITIONS, USER_ACTIVITY_PARTITIONS
from tidewater.streaming import batches

WATERMARK_DELAY = "5 seconds"
PRODUCTION_TRIGGER = {"processingTime": "60 seconds"}
TEST_TRIGGER = {"availableNow": True}

PARTITIONS = {"user_activity": USER_ACTIVITY_PARTITIONS, "sensor_data": SENSOR_DATA_PARTITIONS}


def decoded_events(env: DataFrame, family: str, watermark: str | None = WATERMARK_DELAY) -> DataFrame:
    """Valid decoded payloads with the event-time watermark declared on ``timestamp``."""
    schema = FAMILIES[family]["payload"]
    dec = decode_valid(env, schema)
    return dec.withWatermark("timestamp", watermark) if watermark else dec


def sink_rows(decoded: DataFrame, family: str) -> DataFrame:
    """Sink row at rest: event_time as NTZ, processing_time = batch time, event_date."""
    rows = (user_activity_sink_row(decoded) if family == "user_activity" else sensor_sink_row(decoded))
    rows = rows.withColumn("event_time", to_rest("event_time"))
    return rows.withColumn("event_date", event_date("event_time"))


def ingest_frame(env: DataFrame, family: str, watermark: str | None = WATERMARK_DELAY) -> DataFrame:
    return sink_rows(decoded_events(env, family, watermark), family)


def cluster_for_sink(rows: DataFrame, partition_cols, files_per_partition: int) -> DataFrame:
    """Shuffle a micro-batch so each table partition (e.g. one day) is written by
    at most ``files_per_partition`` tasks: hash of (partition values, salt), the
    salt spreading a hot partition over that many tasks instead of one."""
    salt = F.pmod(F.xxhash64(*[F.col(c) for c in rows.columns]), F.lit(files_per_partition))
    return rows.repartition(*[F.col(c) for c in partition_cols], salt)


def start_ingest(env: DataFrame, family: str, table_path: str, checkpoint: str,
                 trigger: dict | None = None, watermark: str | None = WATERMARK_DELAY,
                 query_name: str | None = None, files_per_partition: int | None = None,
                 ingest_date: bool = False) -> StreamingQuery:
    """Continuous insert: topic -> sink rows -> partitioned Parquet.  Map-only by default;
    ``files_per_partition`` adds one shuffle per micro-batch to bound the files
    written per partition (for backfills spanning many days).  ``ingest_date`` also
    partitions by the day of landing, for pruned as-of reads."""
    rows, partitions = ingest_frame(env, family, watermark), PARTITIONS[family]
    if ingest_date:
        rows, partitions = rows.withColumn("ingest_date", event_date("processing_time")), ("ingest_date", *partitions)
    if files_per_partition:
        rows = cluster_for_sink(rows, partitions, files_per_partition)
    w = (rows.writeStream.format("parquet").outputMode("append")
         .partitionBy(*partitions)
         .option("path", table_path).option("checkpointLocation", checkpoint)
         .trigger(**(trigger or PRODUCTION_TRIGGER)))
    if query_name:
        w = w.queryName(query_name)
    return w.start()


def start_processor(env: DataFrame, family: str, table_path: str, dead_letter_path: str, checkpoint: str,
                    trigger: dict | None = None, query_name: str | None = None,
                    files_per_partition: int | None = None, rules: Rules | None = None) -> StreamingQuery:
    """Processor: each message is read and parsed once; valid rows go to
    ``<table>/batch_id=<n>``, dead letters to ``<dead letters>/batch_id=<n>``, and then the
    batch is entered in the table's log (``streaming/batches``).  The entry holds what was
    observed while the rows were written, in the same pass: rows, dead letters and, for each
    of ``rules``, rows checked and failed."""
    schema, partitions = FAMILIES[family]["payload"], PARTITIONS[family]

    def write(batch: DataFrame, batch_id: int) -> dict:
        parsed, seen, lost = decode(batch, schema).persist(), Observation(), Observation()
        try:
            rows = sink_rows(valid_rows(parsed, schema), family)
            rows = rows.observe(seen, F.count(F.lit(1)).alias("rows"), *rule_counts(rules or {}))
            if files_per_partition:
                rows = cluster_for_sink(rows, partitions, files_per_partition)
            rows.write.mode("overwrite").partitionBy(*partitions).parquet(f"{table_path}/batch_id={batch_id}")
            (split_dead_letters(parsed).withColumn("failed_at", to_rest(F.current_timestamp()))
             .observe(lost, F.count(F.lit(1)).alias("dead_letters"))
             .write.mode("overwrite").parquet(f"{dead_letter_path}/batch_id={batch_id}"))
            return {"metrics": {**seen.get, **lost.get}}
        finally:
            parsed.unpersist()

    return batches.start(env, table_path, checkpoint, write, trigger or PRODUCTION_TRIGGER, query_name)


def table_schema(family: str) -> StructType:
    """The rows of a processor's table."""
    return StructType([*FAMILIES[family]["sink"].fields, StructField("event_date", DateType())])


def read_batches(spark: SparkSession, path: str) -> DataFrame:
    """A table of one folder per micro-batch."""
    return spark.read.parquet(path).drop("batch_id")


# SQL entry point: the same transform as text over a temp view of decoded rows.
SINK_SOURCES = {"event_time": "CAST(timestamp AS TIMESTAMP_NTZ)",
                "processing_time": "CAST(CURRENT_TIMESTAMP AS TIMESTAMP_NTZ)",
                "latitude": "location.lat", "longitude": "location.lon", "facility": "location.facility"}


def ingest_text(family: str, view: str) -> str:
    """The sink row of ``family`` as SQL over decoded rows, from the declared schemas."""
    columns = [f"{SINK_SOURCES[f.name]} AS {f.name}" if f.name in SINK_SOURCES else f.name
               for f in FAMILIES[family]["sink"].fields]
    return f"SELECT {', '.join(columns)}, to_date({SINK_SOURCES['event_time']}) AS event_date FROM {view}"


def ingest_sql(spark: SparkSession, env: DataFrame, family: str, view: str) -> DataFrame:
    """Register the decoded stream as a temp view and express the reshape in SQL."""
    decoded_events(env, family).createOrReplaceTempView(view)
    return spark.sql(ingest_text(family, view))


def start_dead_letters(env: DataFrame, family: str, path: str, checkpoint: str,
                       trigger: dict | None = None) -> StreamingQuery:
    """Side output: undecodable messages with their error text, to their own
    Parquet table (exactly-once like the main sink, own checkpoint)."""
    return (dead_letters(env, FAMILIES[family]["payload"]).withColumn("failed_at", to_rest(F.current_timestamp()))
            .writeStream.format("parquet").outputMode("append")
            .option("path", path).option("checkpointLocation", checkpoint)
            .trigger(**(trigger or PRODUCTION_TRIGGER)).start())


def start_csv_sink(env: DataFrame, family: str, path: str, checkpoint: str,
                   trigger: dict | None = None) -> StreamingQuery:
    """File sink in CSV: arrays go out as JSON text, timestamps with microseconds."""
    rows = ingest_frame(env, family)
    rows = rows.select(*[F.to_json(c).alias(c) if c == "product_ids" else F.col(c) for c in rows.columns])
    return (rows.writeStream.format("csv").outputMode("append")
            .option("header", "true").option("timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
            .option("path", path).option("checkpointLocation", checkpoint)
            .trigger(**(trigger or PRODUCTION_TRIGGER)).start())


def console_sink(df: DataFrame, trigger: dict | None = None, output_mode: str = "append") -> StreamingQuery:
    """Print sink (``SELECT * FROM view`` printed per micro-batch); aggregated
    streams without a watermark use ``output_mode="complete"``."""
    return (df.writeStream.format("console").outputMode(output_mode)
            .trigger(**(trigger or PRODUCTION_TRIGGER)).start())


def run_to_end(q: StreamingQuery, timeout_s: int = 600) -> StreamingQuery:
    """Wait for an availableNow query (the bounded "wait until queryable")."""
    finished = q.awaitTermination(timeout_s)
    if not finished:
        q.stop()
        raise TimeoutError(f"stream {q.name or q.id} did not finish in {timeout_s}s")
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    return q


def wait_for_rows(spark: SparkSession, path: str, min_rows: int = 1, timeout_s: float = 60.0,
                  poll_s: float = 2.0) -> int:
    """Bounded wait until a lake table is queryable and holds at least
    ``min_rows`` rows; returns the count, raises TimeoutError at the deadline.
    Each poll is one count job (a scalar back to the driver)."""
    import time
    deadline = time.monotonic() + timeout_s
    while True:
        try:
            n = spark.read.parquet(path).count()
        except Exception:  # noqa: BLE001 - table folder not created yet
            n = 0
        if n >= min_rows:
            return n
        if time.monotonic() >= deadline:
            raise TimeoutError(f"{path}: {n} rows after {timeout_s}s, wanted {min_rows}")
        time.sleep(poll_s)


def progress_metrics(spark: SparkSession, q: StreamingQuery) -> DataFrame:
    """Delivery report: one row per finished micro-batch from the query's progress."""
    rows = [(p["batchId"], p["numInputRows"], float(p.get("inputRowsPerSecond") or 0.0),
             float(p.get("processedRowsPerSecond") or 0.0),
             int((p.get("durationMs") or {}).get("triggerExecution", 0)),
             sum(int(s.get("numRowsDroppedByWatermark", 0)) for s in p.get("stateOperators") or []))
            for p in q.recentProgress]
    return spark.createDataFrame(rows, "batch_id long, num_input_rows long, input_rows_per_second double, "
                                       "processed_rows_per_second double, trigger_ms long, "
                                       "dropped_by_watermark long")
