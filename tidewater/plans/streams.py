"""Streaming queries.  Each runs its stream with ``availableNow`` into a fresh
folder under the shared checkpoint root and returns the batch read of the sink
(the stream's output is what gets compared)."""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from tidewater.functions.timefn import day_trunc, hour_trunc
from tidewater.operators import views as V
from tidewater.operators.conform import conform_user_activity
from tidewater.plans.batch import CORRUPT_EVERY, R, sensor_envelope, user_envelope
from tidewater.plans.oracle_base import SD, UA, WUA, with_
from tidewater.plans.registry import query
from tidewater.schemas import SENSOR_SINK, USER_ACTIVITY_SINK
from tidewater.session import checkpointed, filesystem, run_dir, shared_root
from tidewater.sources import bindings as B
from tidewater.sources import lake as L
from tidewater.sources.broker import publish, read_events
from tidewater.streaming import ingest as I
from tidewater.streaming import windows as W

NOW = I.TEST_TRIGGER


UA_SINK_COLS = [f.name for f in USER_ACTIVITY_SINK.fields if f.name != "processing_time"] + ["event_date"]
SD_SINK_COLS = [f.name for f in SENSOR_SINK.fields if f.name != "processing_time"] + ["event_date"]


def _ua_table_out(df):
    return df.select(*[F.array_join("product_ids", ",").alias(c) if c == "product_ids" else F.col(c)
                       for c in UA_SINK_COLS])


UA_TABLE_ORACLE = """SELECT user_id, event_type, event_time, session_id, ip_address, user_agent, page_url,
       referrer, time_spent, element_id, search_query, results_count, order_id,
       array_to_string(product_ids, ',') AS product_ids, total_amount, currency,
       CAST(event_time AS DATE) AS event_date
FROM ua"""


_TOPICS: dict[tuple, str] = {}


def _topic(spark, sf_dir, family, corrupt_every=None):
    """The topic folder of one family, published once for the files that ``events`` has now
    (their paths, sizes and times) and read by every streaming query with a checkpoint of
    its own, as independent jobs read one topic.  A rewritten table is published anew."""
    events = B.read_table(spark, sf_dir, "events")
    files = events.select("_metadata.file_path", "_metadata.file_size", "_metadata.file_modification_time").distinct()
    state = files.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64(*files.columns)), F.sum("file_size")).first()
    key = (shared_root(spark), family, corrupt_every, *state)
    if key not in _TOPICS:
        path = os.path.join(run_dir(spark, "topic"), family)
        _publish((user_envelope if family == "user_activity" else sensor_envelope)(spark, sf_dir, corrupt_every), path)
        _TOPICS[key] = path
    return _TOPICS[key]


def _publish(env, path):
    """Files of 12,500 messages or, of a large topic, some 20,000 files."""
    publish(env, path, max_records_per_file=max(12_500, env.count() // 20_000))


def _ingest_once(spark, family, topic_path, table, ckpt):
    q = I.start_ingest(read_events(spark, family, topic_path), family, table, ckpt, trigger=NOW)
    I.run_to_end(q)
    return q


@query("ingest_user_activity", with_(UA) + UA_TABLE_ORACLE)
def q_ingest_user_activity(spark, sf_dir):
    run = run_dir(spark, "ingest_ua")
    topic = _topic(spark, sf_dir, "user_activity")
    table = os.path.join(run, "tables", "user_activity")
    _ingest_once(spark, "user_activity", topic, table, os.path.join(run, "ckpt"))
    return _ua_table_out(spark.read.parquet(table))


SD_TABLE_ORACLE = """SELECT sensor_id, sensor_type, event_time, latitude, longitude, facility, battery_level, reading, unit,
       CAST(event_time AS DATE) AS event_date FROM sd"""


@query("ingest_sensor_data", with_(SD) + SD_TABLE_ORACLE)
def q_ingest_sensor_data(spark, sf_dir):
    run = run_dir(spark, "ingest_sd")
    topic = _topic(spark, sf_dir, "sensor_data")
    table = os.path.join(run, "tables", "sensor_data")
    _ingest_once(spark, "sensor_data", topic, table, os.path.join(run, "ckpt"))
    return spark.read.parquet(table).select(*SD_SINK_COLS)


def _ingest_by_sql(spark, sf_dir, family):
    run = run_dir(spark, "ingest_sql")
    table = os.path.join(run, "tables", family)
    rows = I.ingest_sql(spark, read_events(spark, family, _topic(spark, sf_dir, family)), family,
                        f"{family}_decoded_" + os.path.basename(run).replace("-", "_"))
    I.run_to_end(rows.writeStream.format("parquet").outputMode("append").partitionBy(*I.PARTITIONS[family])
                 .option("path", table).option("checkpointLocation", os.path.join(run, "ckpt")).trigger(**NOW).start())
    return spark.read.parquet(table)


@query("ingest_sql_user_activity", with_(UA) + UA_TABLE_ORACLE)
def q_ingest_sql_user_activity(spark, sf_dir):
    return _ua_table_out(_ingest_by_sql(spark, sf_dir, "user_activity"))


@query("ingest_sql_sensor_data", with_(SD) + SD_TABLE_ORACLE)
def q_ingest_sql_sensor_data(spark, sf_dir):
    return _ingest_by_sql(spark, sf_dir, "sensor_data").select(*SD_SINK_COLS)


@query("processor_rows", with_(UA) + UA_TABLE_ORACLE + f" WHERE event_id % {CORRUPT_EVERY} <> 0")
def q_processor_rows(spark, sf_dir):
    """The production processor over a topic with broken messages: its table."""
    run = run_dir(spark, "processor")
    topic = _topic(spark, sf_dir, "user_activity", CORRUPT_EVERY)
    table = os.path.join(run, "tables", "user_activity")
    I.run_to_end(I.start_processor(read_events(spark, "user_activity", topic), "user_activity", table,
                                   table + "_dead_letters", os.path.join(run, "ckpt"), NOW))
    return _ua_table_out(I.read_batches(spark, table))


HOURLY_ORACLE = with_(WUA) + """
SELECT date_trunc('hour', event_time) AS hour, event_type, COUNT(*) AS event_count FROM wua GROUP BY 1, 2"""


BATCHES, MOST_FILES = 4, 200  # of a topic whose files hold 12,500 messages: 2.5 million a batch


def _files_per_trigger(spark, topic, least):
    """Files of a micro-batch: ``least`` of a small topic, a quarter of a larger one, 200 at most.
    A batch's fixed costs (its plan, entries, commits, a file a day and task) are then paid for
    millions of messages, not for ``least`` files."""
    fs, folder = filesystem(spark, topic)
    files = sum(1 for s in fs.listStatus(folder) if s.getPath().getName().endswith(".parquet"))
    return max(least, min(-(-files // BATCHES), MOST_FILES))


def _process(spark, topic, table, ckpt, family="user_activity", min_files_per_trigger=1, **how):
    how.setdefault("trigger", NOW)
    files = _files_per_trigger(spark, topic, min_files_per_trigger)
    I.run_to_end(I.start_processor(read_events(spark, family, topic, max_files_per_trigger=files), family, table,
                                   table + "_dead_letters", ckpt, **how))


def _lose_commit(spark, ckpt):
    """What a query that dies between its sink and its checkpoint leaves: the last batch's
    commit is missing, and the next start replays that batch."""
    fs, commits = filesystem(spark, os.path.join(ckpt, "commits"))
    ids = [int(n) for n in (s.getPath().getName() for s in fs.listStatus(commits)) if n.isdigit()]
    for name in (str(max(ids)), f".{max(ids)}.crc"):
        fs.delete(filesystem(spark, os.path.join(ckpt, "commits", name))[1], False)


def warehouse_with_replays(spark, sf_dir, run, after_first=None):
    """Processor and warehouse job over three waves of one topic (the oldest rows last); after
    each wave both lose their last commit and replay a batch.  ``after_first(warehouse)`` runs
    when the first wave is in.  The warehouse table's path."""
    from tidewater import jobs
    topic, waves = _three_waves(spark, sf_dir, run, "user_activity")
    table, warehouse = os.path.join(run, "tables", "user_activity"), os.path.join(run, "warehouse", "user_activity")
    ckpts = [os.path.join(run, c) for c in ("ckpt", "ckpt_wh")]

    def both():
        _process(spark, topic, table, ckpts[0], min_files_per_trigger=2)
        I.run_to_end(jobs.start_warehouse(spark, "user_activity", table, warehouse, ckpts[1], NOW))

    for n, publish_wave in enumerate(waves):
        publish_wave()
        both()
        for c in ckpts:
            _lose_commit(spark, c)
        if n == 0 and after_first:
            after_first(warehouse)
    both()
    return warehouse


@query("warehouse_replay_hourly", HOURLY_ORACLE)
def q_warehouse_replay_hourly(spark, sf_dir):
    """The hourly view over a warehouse table whose processor and job replayed batches."""
    from tidewater import jobs
    warehouse = warehouse_with_replays(spark, sf_dir, run_dir(spark, "replay"))
    return V.hourly_user_activity(jobs.read_warehouse(spark, "user_activity", warehouse))


@query("warehouse_job_hourly", HOURLY_ORACLE)
def q_warehouse_job_hourly(spark, sf_dir):
    """The view over the jobs' tables: the warehouse table is folded and its folded batches
    removed after the first wave; the rows of the older days arrive behind the fold."""
    from tidewater import jobs
    from tidewater.streaming import folds

    def compact(warehouse):
        folds.fold(spark, warehouse, jobs.warehouse_schema("user_activity"), I.PARTITIONS["user_activity"],
                   jobs.CLUSTER_BY["user_activity"])
        folds.drop_folded(spark, warehouse)

    warehouse = warehouse_with_replays(spark, sf_dir, run_dir(spark, "warehouse_job"), compact)
    return V.hourly_user_activity(jobs.read_warehouse(spark, "user_activity", warehouse))


@query("rollup_replay", HOURLY_ORACLE)
def q_rollup_replay(spark, sf_dir):
    """Hourly partial counts of a processor's table, batch by batch, added up; both the
    processor and the rollup replay a batch."""
    run = run_dir(spark, "rollup_replay")
    topic, table = _topic(spark, sf_dir, "user_activity"), os.path.join(run, "tables", "user_activity")
    out, ckpts = os.path.join(run, "tables", "hourly"), [os.path.join(run, c) for c in ("ckpt", "ckpt_rollup")]
    for _ in range(2):
        _process(spark, topic, table, ckpts[0], min_files_per_trigger=3)
        I.run_to_end(W.start_table_rollup(spark, table, I.table_schema("user_activity"), V.hourly_user_activity, out, ckpts[1], NOW))
        for c in ckpts:
            _lose_commit(spark, c)
    return W.read_partial_log(spark, out, ["hour", "event_type"], ["event_count"])


@query("restart_no_duplicates", with_(UA) + UA_TABLE_ORACLE)
def q_restart_no_duplicates(spark, sf_dir):
    """Same checkpoint started twice: the second run finds nothing new."""
    run = run_dir(spark, "restart")
    topic = _topic(spark, sf_dir, "user_activity")
    table, ckpt = os.path.join(run, "tables", "user_activity"), os.path.join(run, "ckpt")
    _ingest_once(spark, "user_activity", topic, table, ckpt)
    _ingest_once(spark, "user_activity", topic, table, ckpt)
    return _ua_table_out(spark.read.parquet(table))


@query("stream_equals_batch", with_(WUA) + """
SELECT date_trunc('hour', event_time) AS hour, event_type, COUNT(*) AS event_count FROM wua GROUP BY 1, 2""")
def q_stream_equals_batch(spark, sf_dir):
    """The batch view over the table the stream writes equals the view over the source."""
    run = run_dir(spark, "stream_batch")
    topic = _topic(spark, sf_dir, "user_activity")
    table = os.path.join(run, "tables", "user_activity")
    _ingest_once(spark, "user_activity", topic, table, os.path.join(run, "ckpt"))
    return V.hourly_user_activity(conform_user_activity(spark.read.parquet(table)))


@query("sink_csv_roundtrip", with_(UA) + UA_TABLE_ORACLE)
def q_sink_csv_roundtrip(spark, sf_dir):
    run = run_dir(spark, "csv")
    topic = _topic(spark, sf_dir, "user_activity")
    out = os.path.join(run, "tables", "user_activity_csv")
    q = I.start_csv_sink(read_events(spark, "user_activity", topic), "user_activity", out,
                         os.path.join(run, "ckpt"), trigger=NOW)
    I.run_to_end(q)
    schema = ", ".join(f"{f.name} {'string' if f.name == 'product_ids' else f.dataType.simpleString()}"
                       for f in USER_ACTIVITY_SINK.fields) + ", event_date date"
    back = (spark.read.schema(schema).option("header", "true")
            .option("timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").csv(out))
    back = back.withColumn("product_ids", F.from_json("product_ids", "array<string>"))
    return _ua_table_out(back)


@query("dead_letter_stream", f"""
SELECT CAST(user_id AS VARCHAR) AS key, 'user-activity' AS topic, event_id AS offset,
       '{{"user_id"' AS value, 'malformed JSON' AS error
FROM events WHERE event_id % {CORRUPT_EVERY} = 0""")
def q_dead_letter_stream(spark, sf_dir):
    run = run_dir(spark, "dlq")
    topic = _topic(spark, sf_dir, "user_activity", CORRUPT_EVERY)
    path = os.path.join(run, "tables", "dead_letters")
    q = I.start_dead_letters(read_events(spark, "user_activity", topic), "user_activity", path,
                             os.path.join(run, "ckpt"), trigger=NOW)
    I.run_to_end(q)
    return spark.read.parquet(path).select("key", "topic", "offset", "value", "error")


# ---- windows ---------------------------------------------------------------------------

def _windows_oracle(value_aggs: bool, where: str = "TRUE") -> str:
    extra = (f", round(AVG(reading), {R}) AS avg_value, MIN(reading) AS min_value, MAX(reading) AS max_value"
             if value_aggs else "")
    return with_(SD) + f"""
SELECT time_bucket(INTERVAL '10 seconds', event_time) AS window_start,
       time_bucket(INTERVAL '10 seconds', event_time) + INTERVAL '10 seconds' AS window_end,
       COUNT(*) AS message_count{extra}
FROM sd WHERE {where}
GROUP BY 1, 2
HAVING time_bucket(INTERVAL '10 seconds', event_time) + INTERVAL '10 seconds'
       <= (SELECT MAX(event_time) FROM sd WHERE {where}) - INTERVAL '5 seconds'"""


def _sensor_windows(spark, sf_dir, value_aggs: bool):
    run = run_dir(spark, "tumble")
    topic = _topic(spark, sf_dir, "sensor_data")
    dec = I.decoded_events(read_events(spark, "sensor_data", topic), "sensor_data", watermark=None)
    out = os.path.join(run, "tables", "windows")
    stats = W.event_time_window_stats(dec, "timestamp", value_col="reading" if value_aggs else None)
    q = W.start_append(stats, out, os.path.join(run, "ckpt"), NOW)
    I.run_to_end(q)
    res = spark.read.parquet(out)
    return res.withColumn("avg_value", F.round("avg_value", R)) if value_aggs else res


@query("tumbling_count_event_time", _windows_oracle(False))
def q_tumbling_count_event_time(spark, sf_dir):
    return _sensor_windows(spark, sf_dir, False)


@query("tumbling_stats_event_time", _windows_oracle(True))
def q_tumbling_stats_event_time(spark, sf_dir):
    return _sensor_windows(spark, sf_dir, True)


def wave_bounds(spark, events):
    """Split points of the three-wave replay: 50 % and 90 % of the event_id range."""
    r = events.agg(F.min("event_id").alias("lo"), F.max("event_id").alias("hi")).first()
    span = r["hi"] - r["lo"] + 1
    return r["lo"] + span * 5 // 10, r["lo"] + span * 9 // 10


WAVE_SQL = ("event_id >= (SELECT MIN(event_id) + (MAX(event_id) - MIN(event_id) + 1) * 5 // 10 FROM events)")


def _three_waves(spark, sf_dir, run, family):
    """Publish the topic in three waves: ids [50 %, 90 %), then [90 %, 100 %], then
    the oldest half [0, 50 %) last -- it arrives after the watermark has passed it."""
    ev = B.read_table(spark, sf_dir, "events")
    t50, t90 = wave_bounds(spark, ev)
    env = (user_envelope if family == "user_activity" else sensor_envelope)(spark, sf_dir)
    path = os.path.join(run, "topics", family)
    waves = [(F.col("offset") >= t50) & (F.col("offset") < t90), F.col("offset") >= t90, F.col("offset") < t50]
    return path, [(lambda c=c: _publish(env.where(c), path)) for c in waves]


@query("tumbling_late_drop", _windows_oracle(False, WAVE_SQL))
def q_tumbling_late_drop(spark, sf_dir):
    """Event-time windows over a late replay: each wave is one restart of the same
    query; the oldest half arrives behind the watermark and is dropped."""
    run = run_dir(spark, "late")
    topic, waves = _three_waves(spark, sf_dir, run, "sensor_data")
    out, ckpt = os.path.join(run, "tables", "windows"), os.path.join(run, "ckpt")
    for publish_wave in waves:
        publish_wave()
        dec = I.decoded_events(read_events(spark, "sensor_data", topic), "sensor_data", watermark=None)
        I.run_to_end(W.start_append(W.event_time_window_stats(dec, "timestamp"), out, ckpt, NOW))
    return spark.read.parquet(out)


@query("watermark_passthrough", with_(UA) + UA_TABLE_ORACLE)
def q_watermark_passthrough(spark, sf_dir):
    """The same late replay through the stateless ingest: every row is kept."""
    run = run_dir(spark, "passthrough")
    topic, waves = _three_waves(spark, sf_dir, run, "user_activity")
    table, ckpt = os.path.join(run, "tables", "user_activity"), os.path.join(run, "ckpt")
    for publish_wave in waves:
        publish_wave()
        _ingest_once(spark, "user_activity", topic, table, ckpt)
    return _ua_table_out(spark.read.parquet(table))


@query("tumbling_count_proctime", with_(SD) + """
SELECT time_bucket(INTERVAL '10 seconds', event_time) AS window_start,
       time_bucket(INTERVAL '10 seconds', event_time) + INTERVAL '10 seconds' AS window_end,
       COUNT(*) AS message_count FROM sd GROUP BY 1, 2""")
def q_tumbling_count_proctime(spark, sf_dir):
    """The counter's 10 s windows over arrival time, which the envelope gives."""
    return _arrival_counts(spark, sf_dir)


@query("tumbling_count_proctime_total", "SELECT COUNT(*) AS message_count FROM events")
def q_tumbling_count_proctime_total(spark, sf_dir):
    """The counter's windows summed: every decodable message is counted once."""
    return _arrival_counts(spark, sf_dir).agg(F.sum("message_count").alias("message_count"))


def _arrival_counts(spark, sf_dir):
    run = run_dir(spark, "counter")
    out = os.path.join(run, "tables", "message_counts")
    I.run_to_end(W.start_partial_log(read_events(spark, "sensor_data", _topic(spark, sf_dir, "sensor_data")),
                                     W.arrival_window_count, out, os.path.join(run, "ckpt"), NOW))
    return W.read_partial_log(spark, out, ["window_start", "window_end"], ["message_count"])


@query("stream_from_table", with_(WUA) + """
SELECT date_trunc('hour', event_time) AS hour, event_type, COUNT(*) AS event_count FROM wua GROUP BY 1, 2""")
def q_stream_from_table(spark, sf_dir):
    """The lake table the processor writes, consumed again as a stream: each micro-batch
    adds its own hourly counts to a log, and the log added up equals the batch view,
    whatever the order of the files and the batches."""
    run = run_dir(spark, "table_stream")
    topic = _topic(spark, sf_dir, "user_activity")
    table = os.path.join(run, "tables", "user_activity")
    _ingest_once(spark, "user_activity", topic, table, os.path.join(run, "ckpt_ingest"))
    return hourly_from_table(spark, table, run)


def hourly_from_table(spark, table, run, max_files_per_trigger=None):
    rows = spark.readStream.schema(spark.read.parquet(table).schema)
    if max_files_per_trigger:
        rows = rows.option("maxFilesPerTrigger", max_files_per_trigger)
    out = os.path.join(run, "tables", "hourly")
    I.run_to_end(W.start_partial_log(rows.parquet(table), V.hourly_user_activity, out, os.path.join(run, "ckpt_rollup"), NOW))
    return W.read_partial_log(spark, out, ["hour", "event_type"], ["event_count"])


@query("enrich_stream", with_(UA) + """
SELECT ua.user_id, ua.event_type, ua.event_time, c.c_name, c.c_mktsegment, n.n_name, r.r_name
FROM ua
LEFT JOIN customer c ON CAST(ua.user_id AS BIGINT) = c.c_custkey
LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
LEFT JOIN region r ON n.n_regionkey = r.r_regionkey""")
def q_enrich_stream(spark, sf_dir):
    """Stream-static enrichment: decoded events joined, as they stream, with the
    customer dimension."""
    from tidewater.operators import enrich as EN
    run = run_dir(spark, "enrich_stream")
    topic = _topic(spark, sf_dir, "user_activity")
    rows = I.ingest_frame(read_events(spark, "user_activity", topic), "user_activity")
    out = EN.enrich_user_activity(rows.select("user_id", "event_type", "event_time"),
                                  *[B.read_table(spark, sf_dir, t) for t in ("customer", "nation", "region")])
    path = os.path.join(run, "tables", "enriched")
    I.run_to_end(out.writeStream.format("parquet").option("path", path)
                 .option("checkpointLocation", os.path.join(run, "ckpt")).trigger(**NOW).start())
    return spark.read.parquet(path)


ALERT_THRESHOLD_STREAM = 5


@query("hourly_alerts_stream", with_(UA) + f"""
SELECT date_trunc('hour', event_time) AS hour, event_type, COUNT(*) AS event_count
FROM ua GROUP BY 1, 2
HAVING COUNT(*) > {ALERT_THRESHOLD_STREAM}
   AND date_trunc('hour', event_time) + INTERVAL '1 hour' <= (SELECT MAX(event_time) FROM ua) - INTERVAL '5 seconds'""")
def q_hourly_alerts_stream(spark, sf_dir):
    """Threshold alerts over a streaming hourly rollup: an hour is final (and
    alerted at most once) when the watermark passes its end."""
    from tidewater.streaming import alerts as A
    run = run_dir(spark, "alerts")
    topic = _topic(spark, sf_dir, "user_activity")
    events = I.decoded_events(read_events(spark, "user_activity", topic), "user_activity")
    path = os.path.join(run, "tables", "alerts")
    I.run_to_end(A.start_hourly_alerts(events, ALERT_THRESHOLD_STREAM, path, os.path.join(run, "ckpt"), NOW))
    return spark.read.parquet(path).drop("batch_id")


# ---- detection in the stream -----------------------------------------------------------

def _in_waves(spark, sf_dir, family, start, n=4):
    """A topic published in ``n`` waves in the order of its ids, each taken by a start of the
    same query; after each wave but the last its commit is lost and the batch replayed."""
    run = run_dir(spark, "waves")
    topic, ckpt = os.path.join(run, "topic"), os.path.join(run, "ckpt")
    ids = B.read_table(spark, sf_dir, "events").agg(F.min("event_id"), F.max("event_id")).first()
    env = (user_envelope if family == "user_activity" else sensor_envelope)(spark, sf_dir)
    wave = F.floor((F.col("offset") - (ids[0] or 0)) * n / ((ids[1] or 0) - (ids[0] or 0) + 1))
    out = os.path.join(run, "tables", "out")
    for k in range(n):
        _publish(env.where(wave == k), topic)
        decoded = I.decoded_events(read_events(spark, family, topic), family, watermark=None)
        I.run_to_end(start(decoded, out, ckpt))
        if k < n - 1:
            _lose_commit(spark, ckpt)
    return spark.read.parquet(out).drop("batch_id")


def q_sensor_anomalies_stream(spark, sf_dir):
    """z-score anomalies found batch by batch; the last readings of each sensor are carried."""
    from tidewater.plans.detection import N_PREV, Z_THRESHOLD, _round_z
    from tidewater.streaming import carry as CA
    found = _in_waves(spark, sf_dir, "sensor_data", lambda decoded, out, ckpt: CA.start_sensor_anomalies(
        CA.sensor_readings(decoded), out, ckpt, NOW, Z_THRESHOLD, N_PREV, delay_s=0))
    return _round_z(found)


def q_view_then_purchase_stream(spark, sf_dir):
    """View-then-purchase batch by batch; the last view of each user is carried."""
    from tidewater.streaming import carry as CA
    return _in_waves(spark, sf_dir, "user_activity", lambda decoded, out, ckpt: CA.start_view_then_purchase(
        CA.user_events(decoded), out, ckpt, NOW, delay_s=0))


# ---- mergeable sketches ----------------------------------------------------------------

SKETCH_QUANTILES = (0.5, 0.95)


@query("activity_sketch_rollup", with_(WUA) + """
SELECT date_trunc('day', event_time) AS day, date_trunc('hour', event_time) AS hour, event_type,
       GROUPING(date_trunc('day', event_time), date_trunc('hour', event_time), event_type) AS grain,
       COUNT(*) AS event_count, TRUE AS users_ok, TRUE AS median_ok, TRUE AS p95_ok
FROM wua GROUP BY ROLLUP (1, 2, 3)""")
def q_activity_sketch_rollup(spark, sf_dir):
    """Counts, distinct users and amounts' quantiles at each grain, from hourly sketches that a
    rollup logs batch by batch: whether they lie within three standard errors (one more user)
    and within the stated rank error (one more row) of the exact ones."""
    from tidewater.operators import sketches as K
    run = run_dir(spark, "sketches")
    table, out = os.path.join(run, "tables", "user_activity"), os.path.join(run, "tables", "partials")
    _process(spark, _topic(spark, sf_dir, "user_activity"), table, os.path.join(run, "ckpt"), min_files_per_trigger=3)
    partials = lambda rows: K.sketch_partials(rows, "user_id", "total_amount", ["event_type"])
    I.run_to_end(W.start_table_rollup(spark, table, I.table_schema("user_activity"), partials, out, os.path.join(run, "ckpt_s"), NOW))
    found = K.sketch_rollup(spark.read.parquet(out).drop("batch_id"), ["event_type"], SKETCH_QUANTILES)
    keys = ["day", "hour", "event_type", "grain"]
    found = checkpointed(found.withColumnsRenamed({"entities": "users"}))
    # the exact counts, and the exact ranks of the values found
    rows = (conform_user_activity(B.user_activity(spark, sf_dir)).select(
        day_trunc("event_time").alias("day"), hour_trunc("event_time").alias("hour"), "event_type", "user_id", "total_amount"))
    at = lambda n: F.struct(*[F.col(k).alias(k) if i < n else F.lit(None).cast(rows.schema[k].dataType).alias(k)
                              for i, k in enumerate(keys[:3])], F.lit((1 << (3 - n)) - 1).cast("long").alias("grain"))
    each = rows.select("user_id", "total_amount", F.inline(F.array(*[at(n) for n in range(4)])))
    same = lambda a, b: F.expr(" AND ".join(f"{a}.{k} <=> {b}.{k}" for k in keys))
    users = each.groupBy(*keys, "user_id").agg(F.count("user_id").alias("n")).groupBy(*keys).agg(F.count_if(F.col("n") > 0).alias("exact_users"))
    below = lambda i, op: F.count_if(op(F.col("total_amount"), F.col("quantiles")[i]))
    j = each.alias("e").join(found.alias("f"), same("e", "f"))
    ranks = j.groupBy(*[F.col(f"f.{k}") for k in keys]).agg(
        F.count("total_amount").alias("n"), *[below(i, o).alias(f"{name}{i}") for i in range(2)
                                              for name, o in (("lt", lambda a, b: a < b), ("le", lambda a, b: a <= b))])
    within = lambda i, q: (F.col("n") == 0) | (
        (F.col(f"lt{i}") <= (q + K.RANK_ERROR) * F.col("n") + 1) & (F.col(f"le{i}") >= (q - K.RANK_ERROR) * F.col("n") - 1))
    return (found.alias("f").join(users.alias("u"), same("f", "u")).join(ranks.alias("r"), same("f", "r"))
            .select(*[F.col(f"f.{k}").alias(k) for k in keys], "event_count",
                    (F.abs(F.col("users") - F.col("exact_users")) <= 3 * K.COUNT_ERROR * F.col("exact_users") + 1).alias("users_ok"),
                    within(0, SKETCH_QUANTILES[0]).alias("median_ok"), within(1, SKETCH_QUANTILES[1]).alias("p95_ok")))


# ---- late rows and latest rows ---------------------------------------------------------

@query("windows_late_corrected", _windows_oracle(True))
def q_windows_late_corrected(spark, sf_dir):
    """The late replay of ``tumbling_late_drop``, but nothing is dropped: late rows correct the
    windows they belong to, and the windows closed in the end are those of the whole topic."""
    from tidewater.streaming import carry as CA, late as LA
    run = run_dir(spark, "late_corrected")
    topic, waves = _three_waves(spark, sf_dir, run, "sensor_data")
    out, ckpt = os.path.join(run, "tables", "windows"), os.path.join(run, "ckpt")
    for publish_wave in waves:
        publish_wave()
        decoded = I.decoded_events(read_events(spark, "sensor_data", topic), "sensor_data", watermark=None)
        I.run_to_end(LA.start_windows(CA.sensor_readings(decoded), out, ckpt, NOW, "reading"))
        _lose_commit(spark, ckpt)
    return LA.corrected(spark, out).withColumn("avg_value", F.round("avg_value", R))


def latest_readings(decoded):
    return decoded.select("sensor_id", "sensor_type", F.col("timestamp").cast("timestamp_ntz").alias("event_time"),
                          "battery_level", "reading", "unit", F.col("offset").alias("event_id"))


@query("latest_by_key_stream", with_(SD) + """
SELECT sensor_id, sensor_type, event_time, battery_level, reading, unit, event_id
FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY sensor_id ORDER BY event_time DESC, event_id DESC) AS rn FROM sd)
WHERE rn = 1""")
def q_latest_by_key_stream(spark, sf_dir):
    """The latest reading of each sensor, kept batch by batch; the newest rows come first."""
    from tidewater.streaming import latest as LB
    run = run_dir(spark, "latest")
    topic, waves = _three_waves(spark, sf_dir, run, "sensor_data")
    out, ckpt = os.path.join(run, "tables", "latest"), os.path.join(run, "ckpt")
    for publish_wave in waves:
        publish_wave()
        events = latest_readings(I.decoded_events(read_events(spark, "sensor_data", topic), "sensor_data", watermark=None))
        I.run_to_end(LB.start_latest(events, out, ckpt, NOW, ["sensor_id"]))
        _lose_commit(spark, ckpt)
    return LB.read_latest(spark, out, events.schema)
