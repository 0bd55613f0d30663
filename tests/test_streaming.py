"""Streaming behaviour beyond the oracle queries: progress metrics, alerts sink,
independent checkpoints per consumer, stream-static enrichment."""

import os

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from tidewater.operators import enrich as EN
from tidewater.plans.batch import user_envelope
from tidewater.session import run_dir
from tidewater.sources import bindings as B
from tidewater.sources.broker import publish, read_events
from tidewater.streaming import alerts as A
from tidewater.streaming import ingest as I


def _topic(spark, label):
    run = run_dir(spark, label)
    path = os.path.join(run, "topic")
    publish(user_envelope(spark, SF_SMALL), path, max_records_per_file=300)
    return run, path


def test_progress_metrics_count_all_rows(spark):
    run, topic = _topic(spark, "metrics")
    q = I.start_ingest(read_events(spark, "user_activity", topic, max_files_per_trigger=1), "user_activity",
                       run + "/t", run + "/c", trigger=I.TEST_TRIGGER)
    I.run_to_end(q)
    m = I.progress_metrics(spark, q)
    assert m.agg(F.sum("num_input_rows")).first()[0] == 1000


def test_independent_consumers_have_own_progress(spark):
    run, topic = _topic(spark, "groups")
    I.run_to_end(I.start_ingest(read_events(spark, "user_activity", topic), "user_activity",
                                run + "/a", run + "/ca", trigger=I.TEST_TRIGGER))
    I.run_to_end(I.start_dead_letters(read_events(spark, "user_activity", topic), "user_activity",
                                      run + "/dlq", run + "/cd", trigger=I.TEST_TRIGGER))
    assert spark.read.parquet(run + "/a").count() == 1000
    assert spark.read.parquet(run + "/dlq").count() == 0


def test_stream_static_enrichment(spark):
    run, topic = _topic(spark, "enrich")
    dims = [B.read_table(spark, SF_SMALL, t) for t in ("customer", "nation", "region")]
    rows = I.ingest_frame(read_events(spark, "user_activity", topic), "user_activity")
    out = EN.enrich_user_activity(rows.select("user_id", "event_type", "event_time"), *dims)
    q = (out.writeStream.format("parquet").option("path", run + "/e").option("checkpointLocation", run + "/c")
         .trigger(availableNow=True).start())
    I.run_to_end(q)
    got = spark.read.parquet(run + "/e")
    assert got.count() == 1000 and got.where("c_name IS NULL").count() == 0


def test_alert_sink_is_idempotent_per_batch(spark):
    run, topic = _topic(spark, "alerts")
    events = I.decoded_events(read_events(spark, "user_activity", topic), "user_activity")
    q = A.start_hourly_alerts(events, threshold=1, path=run + "/alerts", checkpoint=run + "/c",
                              trigger=I.TEST_TRIGGER)
    I.run_to_end(q)
    got = spark.read.parquet(run + "/alerts")
    batch = B.user_activity(spark, SF_SMALL)
    from tidewater.operators.views import hourly_user_activity
    expect = hourly_user_activity(batch).where("event_count > 1")
    # windows still open at the end (within the watermark) are not final yet
    assert 0 < got.count() <= expect.count()
    assert got.select("hour", "event_type", "event_count").exceptAll(
        expect.select("hour", "event_type", "event_count")).count() == 0


def test_jobs_run_processor_and_counter(spark, capsys):
    from tidewater import jobs
    run, topic = _topic(spark, "jobs")
    args = ["--topic-path", topic, "--table", run + "/ua", "--checkpoint", run + "/c", "--available-now",
            "--profile", "local"]
    p = jobs.main(["user_activity"] + args)
    assert all(q.exception() is None for q in p)
    assert spark.read.parquet(run + "/ua").count() == 1000
    assert spark.read.parquet(run + "/ua_dead_letters").count() == 0
    jobs.main(["warehouse", "--source", run + "/ua", "--table", run + "/wh", "--checkpoint", run + "/c3", "--available-now",
               "--profile", "local"])
    for _ in range(2):  # the second run drops what the first has folded
        jobs.main(["compact", "--table", run + "/wh", "--drop", "--profile", "local"])
    assert spark.read.parquet(run + "/wh_folds").count() == jobs.read_warehouse(spark, "user_activity", run + "/wh").count() == 1000
    common = ["--topic-path", topic, "--available-now", "--profile", "local"]
    jobs.main(["alerts", *common, "--table", run + "/al", "--checkpoint", run + "/c4", "--threshold", "1"])
    assert spark.read.parquet(run + "/al").where("event_count <= 1").count() == 0
    jobs.main(["conversions", *common, "--table", run + "/cv", "--checkpoint", run + "/c6"])
    assert spark.read.parquet(run + "/cv").count() == 0  # the bound events have no page_view
    jobs.main(["enrich", *common, "--source", SF_SMALL, "--table", run + "/en", "--checkpoint", run + "/c5"])
    assert spark.read.parquet(run + "/en").where("c_name IS NOT NULL").count() == 1000
    c = jobs.main(["message_counter", "--topic-path", topic, "--table", run + "/mc", "--checkpoint", run + "/c2",
                   "--available-now", "--profile", "local"])
    assert c[0].exception() is None


def test_console_sink_prints(spark):
    run, topic = _topic(spark, "console")
    from tidewater.streaming import windows as W
    q = I.console_sink(W.arrival_window_count(read_events(spark, "sensor_data", topic)), I.TEST_TRIGGER,
                       output_mode="update")
    I.run_to_end(q)
    assert q.lastProgress["numInputRows"] == 1000 or q.recentProgress


def test_late_rows_are_counted_as_dropped(spark):
    from tidewater.plans.streams import _three_waves
    from tidewater.streaming import windows as W
    from tests.conftest import SF_MID
    run = run_dir(spark, "dropped")
    topic, waves = _three_waves(spark, SF_MID, run, "sensor_data")
    dropped = 0
    for w in waves:
        w()
        dec = I.decoded_events(read_events(spark, "sensor_data", topic), "sensor_data", watermark=None)
        q = W.start_append(W.event_time_window_stats(dec, "timestamp"), run + "/w", run + "/c", I.TEST_TRIGGER)
        I.run_to_end(q)
        dropped += I.progress_metrics(spark, q).agg(F.sum("dropped_by_watermark")).first()[0] or 0
    assert dropped > 0
    assert spark.read.parquet(run + "/w").agg(F.sum("message_count")).first()[0] == 4999


def test_interrupted_ingest_resumes_without_loss_or_duplicates(spark):
    """Stop a processor after its first micro-batch (as if its driver died), then
    restart it on the same checkpoint: the table ends complete, no duplicates."""
    run, topic = _topic(spark, "resume")
    q = I.start_ingest(read_events(spark, "user_activity", topic, max_files_per_trigger=1), "user_activity",
                       run + "/t", run + "/c", trigger={"processingTime": "1 second"})
    import time
    deadline = time.time() + 120
    while (q.lastProgress is None or q.lastProgress["numInputRows"] == 0) and time.time() < deadline:
        time.sleep(0.2)
    q.stop()
    partial = spark.read.parquet(run + "/t").count()
    assert 0 < partial <= 1000
    I.run_to_end(I.start_ingest(read_events(spark, "user_activity", topic, max_files_per_trigger=1), "user_activity",
                                run + "/t", run + "/c", trigger=I.TEST_TRIGGER))
    t = spark.read.parquet(run + "/t")
    assert t.count() == 1000
    assert t.groupBy("user_id", "event_time").count().where("count > 1").count() == 0


def test_stream_plan_parses_each_message_once(spark):
    run, topic = _topic(spark, "plan")
    q = I.start_ingest(read_events(spark, "user_activity", topic), "user_activity", run + "/t", run + "/c",
                       trigger=I.TEST_TRIGGER)
    I.run_to_end(q)
    plan = q._jsq.explainInternal(False)  # the text q.explain() prints
    assert plan.count("parseJson") == 1, plan
    assert "Filter" not in plan.split("parseJson")[0].split("\n")[-1]
    for node in ("BatchEvalPython", "ArrowEvalPython", "PythonUDF"):
        assert node not in plan


def test_wait_for_rows_is_bounded(spark):
    import pytest
    run, topic = _topic(spark, "wait")
    with pytest.raises(TimeoutError):
        I.wait_for_rows(spark, run + "/t", timeout_s=0.5, poll_s=0.1)
    q = I.start_ingest(read_events(spark, "user_activity", topic), "user_activity", run + "/t", run + "/c",
                       trigger=I.TEST_TRIGGER)
    assert I.wait_for_rows(spark, run + "/t", min_rows=1000, timeout_s=120, poll_s=0.5) == 1000
    I.run_to_end(q)


def test_arrival_counts_do_not_depend_on_batches(spark):
    from tidewater.streaming import windows as W
    run, topic = _topic(spark, "counter_log")
    keys = ["window_start", "window_end"]
    got = []
    for name, files in (("one", None), ("many", 1)):
        I.run_to_end(W.start_partial_log(read_events(spark, "sensor_data", topic, max_files_per_trigger=files),
                                         W.arrival_window_count, f"{run}/{name}", f"{run}/c_{name}", I.TEST_TRIGGER))
        got.append(sorted(map(tuple, W.read_partial_log(spark, f"{run}/{name}", keys, ["message_count"]).collect())))
    assert spark.read.parquet(run + "/many").select("batch_id").distinct().count() >= 3
    assert got[0] == got[1] and sum(r[2] for r in got[0]) == 1000
    assert all((b - a).total_seconds() == 10 and a.second % 10 == 0 for a, b, _ in got[0])
    for _ in range(2):
        W.fold_partial_log(spark, run + "/many", keys, ["message_count"], upto=1)
    folded = W.read_partial_log(spark, run + "/many", keys, ["message_count"], upto=1)
    assert sorted(map(tuple, folded.collect())) == got[0]


def test_rollup_over_a_table_does_not_depend_on_batches(spark):
    from tidewater.operators.views import hourly_user_activity
    from tidewater.plans.streams import hourly_from_table
    run, topic = _topic(spark, "table_rollup")
    I.run_to_end(I.start_ingest(read_events(spark, "user_activity", topic), "user_activity", run + "/t", run + "/c", trigger=I.TEST_TRIGGER))
    got = hourly_from_table(spark, run + "/t", run, max_files_per_trigger=1)
    want = hourly_user_activity(B.user_activity(spark, SF_SMALL))
    assert got.exceptAll(want).count() == 0 and got.count() == want.count()


def test_rewritten_table_gives_the_new_result(spark):
    from tidewater.plans.lifecycle import q_partition_pruned_range
    from tidewater.plans.streams import q_stream_from_table
    folder = run_dir(spark, "rewritten").replace("file:", "", 1)
    os.makedirs(folder)
    events = B.read_table(spark, SF_SMALL, "events")
    counts, hours = [], []
    for n in (1, 2):
        events.where(F.col("event_id") % 2 < n).write.mode("overwrite").parquet(folder + "/events.parquet")
        counts.append(q_partition_pruned_range(spark, folder).count())
        hours.append(q_stream_from_table(spark, folder).agg(F.sum("event_count")).first()[0])
    assert 0 < counts[0] < counts[1] and hours == [500, 1000]


def test_processor_survives_a_failure_between_its_two_writes(spark, monkeypatch):
    """The rows of a batch are written, the dead letters fail; a restart repeats the batch."""
    import pytest
    run = run_dir(spark, "two_writes")
    topic = run + "/topic"
    publish(user_envelope(spark, SF_SMALL, 50), topic, max_records_per_file=300)
    source = lambda: read_events(spark, "user_activity", topic, max_files_per_trigger=2)
    start = lambda: I.start_processor(source(), "user_activity", run + "/t", run + "/d", run + "/c", I.TEST_TRIGGER)
    split = I.split_dead_letters

    def fails(parsed):
        raise OSError("killed here")

    monkeypatch.setattr(I, "split_dead_letters", fails)
    with pytest.raises(Exception, match="killed here"):
        I.run_to_end(start())
    assert spark.read.parquet(run + "/t").count() > 0
    monkeypatch.setattr(I, "split_dead_letters", split)
    I.run_to_end(start())
    rows, dead = I.read_batches(spark, run + "/t"), I.read_batches(spark, run + "/d")
    assert rows.count() == 980 and dead.count() == 20
    assert rows.select("user_id", "event_time").exceptAll(B.user_activity(spark, SF_SMALL).select("user_id", "event_time")).count() == 0


def test_non_numeric_ids_are_not_poison(spark):
    from tidewater.sources.broker import envelope
    run = run_dir(spark, "poison")
    payload = B.user_activity_payload(B.read_table(spark, SF_SMALL, "events").limit(20)).withColumn(
        "user_id", F.when(F.col("event_id") % 3 == 0, "abc").when(F.col("event_id") % 3 == 1, None).otherwise(F.col("user_id")))
    publish(envelope(payload, "user_activity"), run + "/topic")
    dims = [B.read_table(spark, SF_SMALL, t) for t in ("customer", "nation", "region")]
    rows = I.ingest_frame(read_events(spark, "user_activity", run + "/topic"), "user_activity")
    q = (EN.enrich_user_activity(rows.select("user_id"), *dims).writeStream.format("parquet").option("path", run + "/e")
         .option("checkpointLocation", run + "/c").trigger(availableNow=True).start())
    I.run_to_end(q)
    got = spark.read.parquet(run + "/e")
    assert got.count() == 20 and got.where("c_name IS NOT NULL").count() == payload.where("user_id RLIKE '^[0-9]+$'").count()


def test_files_per_partition_bounds_sink_files(spark):
    import glob
    run, topic = _topic(spark, "cluster_sink")
    root = run.replace("file:", "", 1)
    I.run_to_end(I.start_ingest(read_events(spark, "user_activity", topic), "user_activity", run + "/plain",
                                run + "/c1", trigger=I.TEST_TRIGGER))
    I.run_to_end(I.start_ingest(read_events(spark, "user_activity", topic), "user_activity", run + "/clustered",
                                run + "/c2", trigger=I.TEST_TRIGGER, files_per_partition=2))
    per_day = [len(glob.glob(d + "/*.parquet")) for d in glob.glob(root + "/clustered/event_date=*")]
    plain = [len(glob.glob(d + "/*.parquet")) for d in glob.glob(root + "/plain/event_date=*")]
    assert per_day and max(per_day) <= 2 and sum(per_day) < sum(plain)
    a, b = spark.read.parquet(run + "/plain"), spark.read.parquet(run + "/clustered")
    assert a.drop("processing_time").exceptAll(b.drop("processing_time")).count() == 0 and b.count() == 1000


def test_out_of_range_on_a_stream_equals_batch(spark):
    from tidewater.operators import detect as D
    from tidewater.plans.batch import sensor_envelope
    from tidewater.plans.detection import DRIVER_RANGES
    run = run_dir(spark, "range_stream")
    publish(sensor_envelope(spark, SF_SMALL), run + "/topic")
    limits = spark.createDataFrame(DRIVER_RANGES, "sensor_type string, lo double, hi double")
    ev = I.decoded_events(read_events(spark, "sensor_data", run + "/topic"), "sensor_data")
    rows = ev.select(F.col("offset").alias("event_id"), "sensor_id", "sensor_type",
                     F.col("timestamp").cast("timestamp_ntz").alias("event_time"), "reading")
    q = (D.out_of_range(rows, limits).writeStream.format("parquet").option("path", run + "/out")
         .option("checkpointLocation", run + "/c").trigger(availableNow=True).start())
    I.run_to_end(q)
    got = spark.read.parquet(run + "/out")
    batch = D.out_of_range(B.sensor_data(spark, SF_SMALL).select("event_id", "sensor_id", "sensor_type",
                                                                 "event_time", "reading"), limits)
    assert got.count() == batch.count()
    assert got.select(*batch.columns).exceptAll(batch).count() == 0


def test_job_cli_runs_in_its_own_process(spark):
    import subprocess
    import sys as _sys
    from tests.conftest import ROOT
    run, topic = _topic(spark, "cli")
    cmd = [_sys.executable, "-m", "tidewater.jobs", "user_activity", "--topic-path", topic, "--table", run + "/ua",
           "--checkpoint", run + "/c", "--available-now", "--profile", "local"]
    res = subprocess.run(cmd, cwd=ROOT, capture_output=True, text=True, timeout=600)
    assert res.returncode == 0, res.stderr[-2000:]
    table = spark.read.parquet(run + "/ua")
    assert table.count() == 1000 and {"batch_id", "event_date"} <= set(table.columns)
    assert table.where("user_id IS NULL OR event_time IS NULL").count() == 0
    assert spark.read.parquet(run + "/ua_dead_letters").count() == 0


@pytest.mark.parametrize("name", ["rollup_replay", "quality_stream", "warehouse_replay_hourly"])
def test_batches_do_not_multiply_with_the_topic(spark, monkeypatch, name):
    """A topic of 40 files: few batches, and every message in them."""
    from __spark_entry__ import queries
    from tidewater.plans import streams
    from tidewater.streaming import batches
    written, put = [], batches.put_entry
    monkeypatch.setattr(batches, "put_entry", lambda s, table, fields: (written.append((table, fields["metrics"])) if "metrics" in fields else None, put(s, table, fields)))
    monkeypatch.setattr(streams, "_publish", lambda env, path: publish(env, path, max_records_per_file=25))
    monkeypatch.setattr(streams, "_TOPICS", {})
    found = queries()[name](spark, SF_SMALL).collect()
    assert 2 <= len(written) <= 2 * streams.BATCHES
    assert sum(m["rows"] + m["dead_letters"] for _, m in written) == 1000
    if name != "quality_stream":
        assert sum(r["event_count"] for r in found) == 1000
