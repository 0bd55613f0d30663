"""Broker-shaped sources and the keyed-JSON publish path.

``read_events`` yields the envelope ``(key, value, topic, partition, offset,
timestamp)`` either from a broker (when its connector is on the class path and
the config says so) or from Parquet envelope files written by :func:`publish`
(a "topic directory").  Downstream code never knows which.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.config import kafka_sink_options, kafka_source_options
from tidewater.functions.codec import encode_keyed_json, partition_by_key
from tidewater.schemas import ENVELOPE, FAMILIES


PARTITIONS = 8
MAX_RECORDS_PER_FILE = 5_000_000


def envelope(payload: DataFrame, family: str, num_partitions: int = PARTITIONS,
             offset_col: str = "event_id") -> DataFrame:
    """Payload rows -> envelope rows.  ``partition`` is a hash of the key, so
    equal keys share a partition; ``offset`` is the row's position in the log;
    the broker timestamp is the event time."""
    fam = FAMILIES[family]
    enc = encode_keyed_json(payload.withColumn("_broker_ts", F.col("timestamp")),
                            fam["payload"], fam["key_field"])
    return enc.select(
        "key", "value",
        F.lit(fam["topic"]).alias("topic"),
        F.pmod(F.hash("key"), F.lit(num_partitions)).cast("int").alias("partition"),
        F.col(offset_col).cast("long").alias("offset"),
        F.col("_broker_ts").cast("timestamp").alias("timestamp"),
    )


def truncate_every(env: DataFrame, n: int, keep_chars: int = 10) -> DataFrame:
    """Fixture: corrupt every n-th message (by offset) by cutting its value."""
    return env.withColumn("value", F.when(F.col("offset") % n == 0, F.left(F.col("value"), F.lit(keep_chars)))
                          .otherwise(F.col("value")))


def publish(env: DataFrame, path: str, mode: str = "append", cfg: dict | None = None,
            family: str | None = None, num_files: int | None = None, by_key: bool = False,
            max_records_per_file: int = MAX_RECORDS_PER_FILE) -> None:
    """Write envelope rows to a topic: the broker if configured (it partitions by
    key itself), else a Parquet topic directory, written as the rows are read, in
    files of bounded length; no shuffle.  ``by_key`` keeps each key's messages in
    one of ``num_files`` tasks' files (per-key order, at the price of a hot file
    for a hot key)."""
    if cfg and cfg.get("source") == "kafka":
        (env.select("key", "value").write.format("kafka")
         .options(**kafka_sink_options(cfg, family)).save())
        return
    if by_key:
        env = partition_by_key(env, num_files or env.sparkSession.sparkContext.defaultParallelism)
    env.write.mode(mode).option("maxRecordsPerFile", max_records_per_file).parquet(path)


def read_events(spark: SparkSession, family: str, path: str | None = None,
                cfg: dict | None = None, stream: bool = True,
                max_files_per_trigger: int | None = None, group_prefix: str | None = None) -> DataFrame:
    """The envelope of one topic, as a stream (default) or a bounded frame."""
    if cfg and cfg.get("source") == "kafka":
        reader = spark.readStream if stream else spark.read
        opts = kafka_source_options(cfg, family, group_prefix or f"{family}-processor", stream=stream)
        raw = reader.format("kafka").options(**opts).load()
        return raw.select(F.col("key").cast("string"), F.col("value").cast("string"),
                          "topic", "partition", "offset", "timestamp")
    if stream:
        r = spark.readStream.schema(ENVELOPE)
        if max_files_per_trigger:
            r = r.option("maxFilesPerTrigger", max_files_per_trigger)
        return r.parquet(path)
    return spark.read.schema(ENVELOPE).parquet(path)
