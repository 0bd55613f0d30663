"""Corrected windows and latest rows over micro-batches against one pass over all rows."""

import datetime as dt
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tests.test_carry import Feed, parts
from tidewater.operators import keys as K
from tidewater.streaming import batches, late as LA, latest as LB
from tidewater.streaming import ingest as I

BASE = dt.datetime(2024, 1, 1)
READING = "event_id long, sensor_id string, event_time timestamp_ntz, reading double"


def rows_out_of_order(n, seed):
    rnd = random.Random(seed)
    return [(i, rnd.choice(["hot", "hot", "a", "b", None]), None if rnd.random() < 0.02 else
             BASE + dt.timedelta(seconds=max(0, i - rnd.choice([0, 0, 0, 30, 400]))), rnd.choice([None, rnd.uniform(-5, 5)])) for i in range(n)]


def windows(rows, upto=None):
    found = defaultdict(list)
    for _, _, t, v in rows:
        if t is not None:
            found[t - dt.timedelta(seconds=t.second % 10, microseconds=t.microsecond)].append(v)
    out = []
    for start, values in found.items():
        end, held = start + dt.timedelta(seconds=10), [v for v in values if v is not None]
        if upto is None or end <= upto:
            out.append((start, end, len(values), round(sum(held) / len(held), 6) if held else None,
                        min(held, default=None), max(held, default=None)))
    return sorted(out)


def start_windows(stream, table, ckpt):
    return LA.start_windows(stream, table, ckpt, I.TEST_TRIGGER, "reading", delay_s=20)


def result(spark, table):
    return sorted((*r[:3], r[3] if r[3] is None else round(r[3], 6), *r[4:]) for r in map(tuple, LA.corrected(spark, table).collect()))


@pytest.mark.parametrize("n", [1, 4, 9])
def test_windows_with_corrections_are_those_of_all_rows(spark, n):
    rows = rows_out_of_order(900, n)
    f = Feed(spark, "late", READING, start_windows)
    for k, part in enumerate(parts(rows, n)):
        f.take(part)
        seen = [r for p in parts(rows, n)[:k + 1] for r in p]
        mark = max(r[2] for r in seen if r[2]) - dt.timedelta(seconds=20)
        assert result(spark, f.table) == windows(seen, mark)
        state = spark.read.parquet(LA.side(f.table, "state"))
        last = batches.last_batch(spark, f.table)
        assert state.where(F.col("batch_id") == last).where(F.col("window_end") <= F.lit(mark)).count() == 0
        assert state.select("batch_id").distinct().count() <= 2
    late = spark.read.parquet(LA.side(f.table, "late")).count()
    assert (late > 0) == (n > 1)


def test_windows_survive_a_death_and_empty_batches(spark, monkeypatch):
    rows = rows_out_of_order(300, 7)
    f = Feed(spark, "late_death", READING, start_windows)
    finish = batches.finish
    f.take(rows[:150])
    monkeypatch.setattr(batches, "finish", lambda *a, **k: (_ for _ in ()).throw(OSError("killed here")))
    with pytest.raises(Exception, match="killed here"):
        f.take(rows[150:])
    monkeypatch.setattr(batches, "finish", finish)
    f.start()
    f.take([])
    mark = max(r[2] for r in rows if r[2]) - dt.timedelta(seconds=20)
    assert result(spark, f.table) == windows(rows, mark)


def test_windows_before_the_origin_are_aligned(spark):
    df = spark.createDataFrame([(dt.datetime(1969, 12, 31, 23, 59, 57),)], "t timestamp_ntz")
    assert df.select(LA.window_start("t", 10)).first()[0] == dt.datetime(1969, 12, 31, 23, 59, 50)


def start_latest(stream, table, ckpt):
    return LB.start_latest(stream, table, ckpt, I.TEST_TRIGGER, ["sensor_id"], buckets=4)


def latest(rows):
    best = {}
    for r in rows:
        rank = (r[2] is not None, r[2] or BASE, r[0])
        if r[1] not in best or rank > best[r[1]][0]:
            best[r[1]] = (rank, r)
    return sorted((r for _, r in best.values()), key=repr)


def test_latest_rows_batch_by_batch(spark, monkeypatch):
    rows = rows_out_of_order(400, 3)
    rnd = random.Random(4)
    rnd.shuffle(rows)
    f = Feed(spark, "latest", READING, start_latest)
    get = lambda: sorted(map(tuple, LB.read_latest(spark, f.table, spark.createDataFrame([], READING).schema).collect()), key=repr)
    for k, part in enumerate(parts(rows, 4)):
        f.take(part)
        assert get() == latest(rows[:len(rows) * (k + 1) // 4])
    finish = batches.finish
    monkeypatch.setattr(batches, "finish", lambda *a, **k: (_ for _ in ()).throw(OSError("killed here")))
    extra = [(9_000, "new", BASE, 1.0), (9_001, "hot", BASE + dt.timedelta(days=1), 2.0)]
    with pytest.raises(Exception, match="killed here"):
        f.take(extra)
    assert get() == latest(rows)
    monkeypatch.setattr(batches, "finish", finish)
    for last in range(5):  # as a new session, which knows no table
        spark.sql(f"DROP TABLE IF EXISTS {LB._name(f.table, last)}")
    f.start()
    assert get() == latest(rows + extra)


def test_latest_row_equals_the_batch_operator_with_several_keys(spark):
    schema = "a string, b int, event_time timestamp_ntz, event_id long, v array<string>"
    rnd = random.Random(8)
    rows = [(rnd.choice(["x", None]), rnd.choice([1, 2, None]), BASE + dt.timedelta(seconds=rnd.randint(0, 50)), i, [str(i)]) for i in range(200)]
    f = Feed(spark, "latest_keys", schema, lambda s, t, c: LB.start_latest(s, t, c, I.TEST_TRIGGER, ["a", "b"], buckets=3))
    for part in parts(rows, 3):
        f.take(part)
    df = spark.createDataFrame(rows, schema)
    got = LB.read_latest(spark, f.table, df.schema)
    assert sorted(map(tuple, got.select("a", "b", "event_id").collect()), key=repr) == \
        sorted(map(tuple, K.latest_by_key(df, ["a", "b"]).select("a", "b", "event_id").collect()), key=repr)


def test_the_state_side_is_not_shuffled(spark):
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    f = Feed(spark, "latest_plan", READING, lambda s, t, c: LB.start_latest(s, t, c, I.TEST_TRIGGER, ["sensor_id"], buckets=n))
    f.take(rows_out_of_order(100, 1))
    schema = spark.createDataFrame([], READING).schema
    old = LB.state(spark, f.table, schema, n, 0)
    new = LB.hashed(K.latest_by_key(spark.createDataFrame(rows_out_of_order(50, 2), READING), ["sensor_id"]).select(*schema.names), ["sensor_id"])
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("simple")
        text = LB.merged(old, new, ["event_time", "event_id"], n)._jdf.queryExecution().explainString(mode)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    lines = text.splitlines()
    scan = next(i for i, line in enumerate(lines) if "FileScan parquet" in line and "Bucketed: true" in line)
    join = next(i for i, line in enumerate(lines) if "SortMergeJoin" in line or "ShuffledHashJoin" in line)
    side = lines[join:scan] if join < scan else lines[scan:join]
    assert not any("Exchange" in line for line in side), text
