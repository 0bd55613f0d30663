"""Synthetic payloads obey the generator contract end to end (encode -> decode ->
sink row -> rules), broken rows are counted, and view NULL semantics."""

import datetime as dt

from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from tidewater.operators import quality as Q
from tidewater.operators import views as V
from tidewater.sources import bindings as B
from tidewater.sources.broker import envelope, publish
from tests.synth import synth_sensor_data, synth_user_activity
from tidewater.session import run_dir
from tidewater.streaming.ingest import decoded_events, sink_rows


def _report(df, rules):
    return {r["rule"]: (r["checked"], r["failed"]) for r in Q.rule_report(df, rules).collect()}


def test_synthetic_families_pass_contract_after_round_trip(spark):
    ev = B.read_table(spark, SF_SMALL, "events")
    for fam, payload, rules in (("user_activity", synth_user_activity(ev), Q.user_activity_rules()),
                                ("sensor_data", synth_sensor_data(ev), Q.sensor_rules())):
        rows = sink_rows(decoded_events(envelope(payload, fam), fam, watermark=None), fam)
        rep = _report(rows, rules)
        assert all(failed == 0 for _, failed in rep.values()), rep
        assert rep[next(iter(rules))][0] == 1000


def test_synthetic_rows_are_stable_across_partitionings(spark):
    ev = B.read_table(spark, SF_SMALL, "events")
    a = synth_user_activity(ev.repartition(3))
    b = synth_user_activity(ev.repartition(7, "user_id"))
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_broken_rows_are_counted(spark):
    ev = B.read_table(spark, SF_SMALL, "events")
    rows = sink_rows(decoded_events(envelope(synth_sensor_data(ev), "sensor_data"), "sensor_data", watermark=None),
                     "sensor_data")
    broken = rows.withColumn("reading", F.when(F.col("sensor_type") == "humidity", F.lit(150.0))
                             .otherwise(F.col("reading")))
    rep = _report(broken, Q.sensor_rules())
    n_humidity = rows.where("sensor_type = 'humidity'").count()
    assert rep["reading_range_and_unit"][1] == n_humidity > 0
    assert rep["battery_level_range"][1] == 0


def test_views_keep_null_time_group_and_null_readings(spark):
    t = dt.datetime(2024, 1, 1, 10, 15)
    df = spark.createDataFrame(
        [("temperature", "f1", t, 1.0), ("temperature", "f1", t, None), ("temperature", "f1", None, 3.0)],
        "sensor_type string, facility string, event_time timestamp_ntz, sensor_value double")
    got = {(r["hour"], r["reading_count"], r["avg_value"]) for r in V.sensor_stats(df).collect()}
    assert got == {(dt.datetime(2024, 1, 1, 10), 2, 1.0), (None, 1, 3.0)}


def test_publish_by_key_keeps_each_key_in_one_file(spark):
    from tidewater.plans.batch import user_envelope
    path = run_dir(spark, "bykey") + "/topic"
    publish(user_envelope(spark, SF_SMALL), path, num_files=5, by_key=True)
    files = spark.read.parquet(path).select("key", F.input_file_name().alias("f"))
    assert files.groupBy("key").agg(F.countDistinct("f").alias("n")).where("n > 1").count() == 0
