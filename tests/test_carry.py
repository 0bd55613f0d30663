"""Sequence operators on a stream against the same operators on the whole table."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tidewater.operators import detect as D
from tidewater.session import run_dir
from tidewater.streaming import batches, carry as CA
from tidewater.streaming import ingest as I

BASE = dt.datetime(2024, 1, 1)
READING = "event_id long, sensor_id string, event_time timestamp_ntz, reading double"
EVENT = "event_id long, user_id string, event_type string, event_time timestamp_ntz"


def readings(n=600, seed=5):
    rnd, t = random.Random(seed), BASE
    rows = []
    for i in range(n):
        t += dt.timedelta(seconds=rnd.choice([0, 1, 7, 300]))
        sensor = "hot" if rnd.random() < 0.4 else rnd.choice(["a", "b", None])
        rows.append((i, sensor, t, None if rnd.random() < 0.03 else rnd.gauss(0, 1) * (9 if rnd.random() < 0.05 else 1)))
    return rows


def events(n=900, seed=6):
    rnd, t = random.Random(seed), BASE
    rows = []
    for i in range(n):
        t += dt.timedelta(seconds=rnd.choice([0, 2, 40, 200]))
        user = rnd.choice(["hot", "hot", None, f"u{i // 60}"])  # most users come and go
        rows.append((i, user, rnd.choice(["view", "purchase", "click"]), t))
    return rows


class Feed:
    """Batches of rows, each a file that one start of the query takes."""

    def __init__(self, spark, label, schema, start):
        self.spark, self.schema, self.begin, self.run = spark, schema, start, run_dir(spark, label)
        self.table = self.run + "/out"

    def take(self, rows):
        self.spark.createDataFrame(rows, self.schema).coalesce(1).write.mode("append").parquet(self.run + "/in")
        self.start()

    def start(self):
        stream = self.spark.readStream.schema(self.schema).parquet(self.run + "/in")
        I.run_to_end(self.begin(stream, self.table, self.run + "/ckpt"))

    def results(self):
        return sorted(map(tuple, self.spark.read.parquet(self.table).drop("batch_id").collect()), key=repr)

    def carried(self):
        return self.spark.read.parquet(CA.state_of(self.table))


def parts(rows, n):
    return [rows[len(rows) * k // n:len(rows) * (k + 1) // n] for k in range(n)]


def near(rows):
    return [tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in rows]


def whole(df):
    return sorted(map(tuple, df.collect()), key=repr)


def anomalies(delay_s):
    return lambda stream, table, ckpt: CA.start_sensor_anomalies(stream, table, ckpt, I.TEST_TRIGGER, 1.5, 6, delay_s=delay_s)


def purchases(delay_s):
    return lambda stream, table, ckpt: CA.start_view_then_purchase(stream, table, ckpt, I.TEST_TRIGGER, delay_s=delay_s)


@pytest.mark.parametrize("n", [1, 3, 10])
def test_in_order_rows_in_any_batches(spark, n):
    rows = readings()
    f = Feed(spark, "anomalies", READING, anomalies(0))
    for part in parts(rows, n):
        f.take(part)
    want = whole(D.sensor_anomalies(spark.createDataFrame(rows, READING), 1.5, 6))
    assert near(f.results()) == near(want) and len(want) > 50
    sizes = f.carried().groupBy("batch_id").count().collect()
    assert len(sizes) <= 2 and max(r["count"] for r in sizes) <= 4 * 6  # the last 6 of each of 4 sensors


def test_rows_out_of_order_within_the_delay(spark):
    rows = readings(300)
    rnd = random.Random(1)
    shuffled = sorted(rows, key=lambda r: r[2] + dt.timedelta(seconds=rnd.uniform(0, 890)))
    f = Feed(spark, "disorder", READING, anomalies(900))
    for part in parts(shuffled, 5):
        f.take(part)
    entry = batches.entry(spark, f.table, batches.last_batch(spark, f.table))
    mark = dt.datetime(1970, 1, 1) + dt.timedelta(microseconds=entry["watermark_us"])
    assert mark == max(r[2] for r in rows) - dt.timedelta(seconds=900)
    settled = [r for r in rows if r[2] <= mark]
    assert near(f.results()) == near(whole(D.sensor_anomalies(spark.createDataFrame(settled, READING), 1.5, 6)))
    assert f.carried().where("not _settled").join(spark.createDataFrame([(entry["batch_id"],)], "batch_id long"), "batch_id").count() == len(rows) - len(settled)


def test_purchases_and_bounded_state(spark):
    rows = events()
    f = Feed(spark, "purchases", EVENT, purchases(0))
    for part in parts(rows, 6):
        f.take(part)
        last = batches.last_batch(spark, f.table)
        now = max(r[3] for r in part)
        kept = f.carried().where(F.col("batch_id") == last).collect()
        assert len(kept) <= 10 and all(r["event_time"] >= now - dt.timedelta(minutes=30) for r in kept)
        assert len({r["user_id"] for r in kept}) == len(kept)
    want = whole(D.view_then_purchase(spark.createDataFrame(rows, EVENT)))
    assert f.results() == want and len(want) > 100 and len({r[1] for r in rows}) > 15


def test_null_times_and_late_rows(spark):
    f = Feed(spark, "late", EVENT, purchases(0))
    at = lambda minutes: BASE + dt.timedelta(minutes=minutes)
    f.take([(1, "u", "view", at(0)), (2, "u", "purchase", None), (3, "u", "view", None)])
    f.take([(4, "u", "purchase", at(10)), (5, "v", "view", at(60))])
    f.take([(6, "u", "purchase", at(20)), (7, "v", "purchase", at(61)), (8, "w", "view", at(40)), (9, "w", "purchase", at(45))])
    # u's view has left the state with the watermark at 60 minutes; w's pair came late, but together
    assert f.results() == [(4, "u", at(10), at(0)), (7, "v", at(61), at(60)), (9, "w", at(45), at(40))]


def test_death_before_the_entry_repeats_the_batch(spark, monkeypatch):
    rows = events(300)
    f = Feed(spark, "death", EVENT, purchases(0))
    finish = batches.finish

    def dies(*args, **fields):
        raise OSError("killed here")

    for k, part in enumerate(parts(rows, 3)):
        if k:
            monkeypatch.setattr(batches, "finish", dies)
            with pytest.raises(Exception, match="killed here"):
                f.take(part)
            monkeypatch.setattr(batches, "finish", finish)
            f.start()
        else:
            f.take(part)
    assert f.results() == whole(D.view_then_purchase(spark.createDataFrame(rows, EVENT)))


def test_empty_batches_and_rows_without_time_only(spark):
    f = Feed(spark, "nothing", READING, anomalies(5))
    f.take([(1, None, None, 1.0), (2, None, None, None)])
    f.take([])
    f.take([(3, None, BASE, 5.0)])
    assert f.results() == [] and f.carried().agg(F.max("event_id")).first()[0] == 3
