"""Tables written by micro-batches: replays, jobs that start first, folds, as-of reads."""

import os

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from tidewater import jobs
from tidewater.operators import cluster as CL
from tidewater.operators.views import hourly_user_activity
from tidewater.plans.batch import user_envelope
from tidewater.plans.streams import _lose_commit
from tidewater.session import run_dir
from tidewater.functions.timefn import event_hour
from tidewater.sources import bindings as B
from tidewater.sources import lake as L
from tidewater.sources.broker import publish, read_events
from tidewater.streaming import batches, folds
from tidewater.streaming import ingest as I
from tidewater.streaming import windows as W

FAMILY = "user_activity"
SINK, WAREHOUSE = I.table_schema(FAMILY), jobs.warehouse_schema(FAMILY)


class Chain:
    """A topic, its processor, the warehouse job and the hourly rollup, in a folder of their own."""

    def __init__(self, spark, label):
        self.spark, self.run = spark, run_dir(spark, label)
        self.topic, self.table, self.warehouse, self.hourly = (os.path.join(self.run, n) for n in ("topic", "t", "wh", "hourly"))

    def publish(self, where="true", files=250):
        publish(user_envelope(self.spark, SF_SMALL).where(where), self.topic, max_records_per_file=files)

    def process(self, files=1, **how):
        I.run_to_end(I.start_processor(read_events(self.spark, FAMILY, self.topic, max_files_per_trigger=files), FAMILY, self.table,
                                       self.table + "_dead", self.run + "/c", I.TEST_TRIGGER, **how))

    def conform(self, **how):
        I.run_to_end(jobs.start_warehouse(self.spark, FAMILY, self.table, self.warehouse, self.run + "/cw", I.TEST_TRIGGER, **how))

    def roll_up(self):
        I.run_to_end(W.start_table_rollup(self.spark, self.table, SINK, hourly_user_activity, self.hourly, self.run + "/cr", I.TEST_TRIGGER))

    def counts(self):
        hourly = W.read_partial_log(self.spark, self.hourly, ["hour", "event_type"], ["event_count"])
        return (batches.read(self.spark, self.table, SINK).count(), jobs.read_warehouse(self.spark, FAMILY, self.warehouse).count(),
                hourly.agg(F.sum("event_count")).first()[0])


def test_replay_after_the_entry_adds_nothing(spark):
    c = Chain(spark, "replay_after")
    c.publish("offset % 2 = 0")
    for _ in range(3):
        c.process(), c.conform(), c.roll_up()
        assert c.counts() == (500, 500, 500)
        for ckpt in ("/c", "/cw", "/cr"):
            _lose_commit(spark, c.run + ckpt)
    c.publish("offset % 2 = 1")
    c.process(), c.conform(), c.roll_up()
    assert c.counts() == (1000, 1000, 1000)
    want = jobs.CONFORM[FAMILY](B.user_activity(spark, SF_SMALL), with_partition=True)
    got = jobs.read_warehouse(spark, FAMILY, c.warehouse).select(*want.columns)
    assert got.exceptAll(want).count() == 0


@pytest.mark.parametrize("job", ["process", "conform", "roll_up"])
def test_death_between_rows_and_entry(spark, monkeypatch, job):
    """The rows of a batch are written, its entry is not: the rows are invisible to the jobs
    behind and are written anew."""
    c = Chain(spark, "replay_before")
    c.publish("offset % 2 = 0")
    c.process(), c.conform(), c.roll_up()
    c.publish("offset % 2 = 1")
    finish = batches.finish

    def dies(spark, table, *args, **fields):
        if table == {"process": c.table, "conform": c.warehouse, "roll_up": c.hourly}[job]:
            raise OSError("killed here")
        finish(spark, table, *args, **fields)

    monkeypatch.setattr(batches, "finish", dies)
    for step in ("process", "conform", "roll_up"):
        if step == job:
            with pytest.raises(Exception, match="killed here"):
                getattr(c, step)()
        else:
            getattr(c, step)()
    monkeypatch.setattr(batches, "finish", finish)
    assert batches.read(spark, c.table, SINK).count() == (500 if job == "process" else 1000)
    for _ in range(2):
        c.process(), c.conform(), c.roll_up()
        assert c.counts() == (1000, 1000, 1000)


def test_jobs_may_start_on_an_empty_table_and_lag_behind(spark):
    c = Chain(spark, "early")
    c.conform(), c.roll_up()
    c.publish()
    c.conform()
    c.process()
    assert batches.last_batch(spark, c.table) >= 3
    c.conform(batches_per_trigger=1), c.roll_up()
    assert batches.last_batch(spark, c.warehouse) == batches.last_batch(spark, c.table)
    assert c.counts() == (1000, 1000, 1000)
    assert [r["upto"] for r in batches.entries(spark, c.warehouse).orderBy("batch_id").collect()] == list(range(batches.last_batch(spark, c.table) + 1))


def test_late_rows_behind_a_fold_are_read(spark):
    c = Chain(spark, "fold_late")
    c.publish("offset % 10 <> 3")
    c.process(), c.conform(batches_per_trigger=1)
    whole = lambda: jobs.read_warehouse(spark, FAMILY, c.warehouse)
    how = (I.PARTITIONS[FAMILY], jobs.CLUSTER_BY[FAMILY])
    first = folds.fold(spark, c.warehouse, WAREHOUSE, *how)
    assert folds.fold(spark, c.warehouse, WAREHOUSE, *how) == first and whole().count() == 900
    folds.drop_folded(spark, c.warehouse)
    assert whole().count() == 900 and spark.read.parquet(folds.folds_of(c.warehouse)).count() == 900
    c.publish("offset % 10 = 3")  # every day again, long after the fold
    c.process(), c.conform()
    assert whole().count() == 1000
    second = folds.fold(spark, c.warehouse, WAREHOUSE, *how)
    assert folds.chain(spark, c.warehouse) == [second, first] and whole().count() == 1000
    want = jobs.CONFORM[FAMILY](B.user_activity(spark, SF_SMALL), with_partition=True)
    assert whole().select(*want.columns).exceptAll(want).count() == 0
    for lo, hi in (("2024-01-05 06:00:00", "2024-01-09 18:30:00"), ("2024-01-07 23:59:59", "2024-01-08 00:00:01")):
        ranged = L.read_range(want, lo, hi)
        assert sorted(map(tuple, L.read_range(whole(), lo, hi).select(*want.columns).collect()), key=repr) == sorted(map(tuple, ranged.collect()), key=repr)
    assert folds.read_whole(spark, c.warehouse, WAREHOUSE, upto=first).count() == 900
    assert folds.read_whole(spark, c.warehouse, WAREHOUSE, upto=-1).count() == 0
    c.publish("offset = 5")
    c.process(), c.conform()
    third = folds.fold(spark, c.warehouse, WAREHOUSE, *how, whole=True)
    folds.drop_folded(spark, c.warehouse)
    assert folds.chain(spark, c.warehouse) == [third] and whole().count() == 1001


def test_a_fold_that_broke_off_counts_for_nothing(spark, monkeypatch):
    c = Chain(spark, "fold_broken")
    c.publish()
    c.process(), c.conform()
    how = (spark, c.warehouse, WAREHOUSE, I.PARTITIONS[FAMILY], jobs.CLUSTER_BY[FAMILY])
    put = batches.put_entry

    def dies(*args):
        raise OSError("killed here")

    monkeypatch.setattr(batches, "put_entry", dies)
    with pytest.raises(OSError, match="killed here"):
        folds.fold(*how)
    monkeypatch.setattr(batches, "put_entry", put)
    assert jobs.read_warehouse(spark, FAMILY, c.warehouse).count() == 1000
    folds.fold(*how)
    assert jobs.read_warehouse(spark, FAMILY, c.warehouse).count() == 1000


def test_as_of_inside_a_running_batch_is_repeatable(spark, monkeypatch):
    c = Chain(spark, "as_of")
    c.publish("offset % 2 = 0")
    c.process(files=None)
    c.publish("offset % 2 = 1")
    seen, finish = {}, batches.finish

    def looks(spark_, table, *args, **fields):  # the second batch's rows are written, its entry is not
        seen["at"] = spark.sql("SELECT CAST(CAST(current_timestamp() AS TIMESTAMP_NTZ) AS STRING)").first()[0]
        seen["running"] = batches.read_as_of(spark, c.table, SINK, seen["at"]).count()
        finish(spark_, table, *args, **fields)

    monkeypatch.setattr(batches, "finish", looks)
    c.process(files=None)
    monkeypatch.setattr(batches, "finish", finish)
    assert seen["running"] == 500 and batches.read_as_of(spark, c.table, SINK, seen["at"]).count() == 500
    later = batches.local_text(spark, batches.entry(spark, c.table, 1)["finished_us"])
    assert batches.read_as_of(spark, c.table, SINK, later).count() == 1000
    assert batches.read_as_of(spark, c.table, SINK, "2001-01-01 00:00:00").count() == 0
    with pytest.raises(ValueError):
        batches.read_as_of(spark, c.table, SINK, "2999-01-01 00:00:00")


def test_stamps_follow_the_order_of_batches(spark, monkeypatch):
    table = os.path.join(run_dir(spark, "clock"), "t")
    batches.create(spark, table)
    for n, clock in enumerate((1000.0, 900.0, 1000.000001, 2000.0)):  # drivers whose clocks differ
        monkeypatch.setattr(batches.time, "time", lambda: clock)
        batches.finish(spark, table, n)
    stamps = [r["finished_us"] for r in batches.entries(spark, table).orderBy("batch_id").collect()]
    assert stamps == sorted(set(stamps)) and stamps[-1] == 2_000_000_000


def scanned(df):
    """Rows that the scan of ``df`` read past its statistics."""
    df.collect()
    leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
    return sum(leaves.apply(i).metrics().apply("numOutputRows").value() for i in range(leaves.size()))


def test_clustered_files_skip(spark):
    """One user's hour out of a day's files: along the curve far fewer rows are read than in
    order of time, with as many files."""
    i = F.col("id")
    t = F.timestamp_add("SECOND", i * 4, F.lit("2024-01-01 00:00:00").cast("timestamp_ntz"))
    rows = spark.range(20_000).select(t.alias("event_time"), F.concat(F.lit("user-"), (F.pmod(F.xxhash64("id"), F.lit(50)) + 300)).alias("user_id"),
                                      F.to_date(t).alias("event_date"), event_hour(t).alias("event_hour"))
    run = run_dir(spark, "curve")
    CL.write_clustered(rows, run + "/curve", ["event_date"], ["event_time", "user_id"], 200)
    rows.repartitionByRange(100, "event_time").write.partitionBy("event_date").parquet(run + "/time")
    hour, user, both = {}, {}, {}
    for n in ("curve", "time"):
        table = spark.read.parquet(f"{run}/{n}")
        ranged = L.read_range(table, "2024-01-01 10:00:00", "2024-01-01 11:00:00")
        hour[n], user[n], both[n] = (scanned(x) for x in (ranged, table.where("user_id = 'user-321'"), ranged.where("user_id = 'user-321'")))
    assert hour["time"] < 2_500 and user["time"] > 15_000 and both["time"] > 1_000  # some files lack the user
    assert hour["curve"] < 6_000 and user["curve"] < 6_000 and both["curve"] <= 800
    assert spark.read.parquet(run + "/curve").count() == 20_000


def test_hilbert_places_are_neighbours(spark):
    grid = spark.range(64 * 64).select((F.col("id") % 64).alias("x"), F.expr("id div 64").alias("y"))
    path = sorted((r["k"], r["x"], r["y"]) for r in grid.select("x", "y", CL._hilbert(F.col("x"), F.col("y"), 6).alias("k")).collect())
    assert [k for k, _, _ in path] == list(range(64 * 64))
    assert all(abs(a[1] - b[1]) + abs(a[2] - b[2]) == 1 for a, b in zip(path, path[1:]))


def test_curve_key_takes_nulls_and_equal_values(spark):
    df = spark.createDataFrame([(None, None), ("a", 1.0), ("a", 1.0), ("b", None)], "user_id string, x double")
    assert df.select(CL.curve_key(df, ["user_id", "x"])).count() == 4
    CL.write_clustered(df.where("false").withColumn("d", F.lit(1)), run_dir(spark, "none") + "/t", ["d"], ["user_id", "x"], 10)


def test_processor_observes_its_batches(spark):
    from tidewater.operators import quality as Q
    from tidewater.plans.lifecycle import driver_rules
    c = Chain(spark, "observe")
    publish(user_envelope(spark, SF_SMALL, 50), c.topic, max_records_per_file=300)
    c.process(rules=driver_rules())
    log = batches.entries(spark, c.table)
    assert log.count() >= 4 and log.agg(F.sum("metrics.rows"), F.sum("metrics.dead_letters")).first()[:] == (980, 20)
    want = Q.rule_report(B.user_activity(spark, SF_SMALL).where("event_id % 50 <> 0"), driver_rules())
    assert sorted(map(tuple, Q.report_from_log(log).collect())) == sorted(map(tuple, want.collect()))
