"""As-of enrichment against a plain search, and sketches against exact answers."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tidewater.operators import enrich as EN
from tidewater.operators import sketches as K

BASE = dt.datetime(2024, 1, 1)


def plain(facts, versions):
    out = []
    for i, k, t in facts:
        held = [v for v in versions if k is not None and t is not None and v[0] == k and v[1] is not None and v[1] <= t]
        best = max(held, key=lambda v: (v[1], v[2] is not None, v[2] or "", v[3] is not None, v[3] or 0), default=(None,) * 4)
        out.append((i, k, t, best[2], best[3]))
    return sorted(out, key=repr)


@pytest.mark.parametrize("seed,target", [(1, 10), (2, 3), (3, 100_000)])
def test_as_of_equals_a_plain_search(spark, seed, target):
    rnd = random.Random(seed)
    key = lambda: rnd.choice(["hot", "hot", "hot", "a", "b", None, f"k{rnd.randint(0, 9)}"])
    at = lambda: None if rnd.random() < 0.05 else BASE + dt.timedelta(seconds=rnd.choice([0, 1, 2, rnd.randint(0, 4000)]))
    facts = [(i, key(), at()) for i in range(400)]
    versions = [(key(), at(), rnd.choice(["p", "q", None]), rnd.randint(0, 3)) for _ in range(120)]
    f = spark.createDataFrame([(*r, "own") for r in facts], "event_id long, user_id string, event_time timestamp_ntz, _b string")
    f = f.drop("_b")
    v = spark.createDataFrame(versions, "user_id string, valid_from timestamp_ntz, plan string, level int")
    got = EN.enrich_as_of(f, v, "user_id", "event_time", "event_id", "valid_from", ["plan", "level"], target_rows=target)
    assert got.columns == ["event_id", "user_id", "event_time", "plan", "level"]
    assert sorted(map(tuple, got.collect()), key=repr) == plain(facts, versions)


def test_as_of_with_empty_sides_and_version_names_like_the_facts(spark):
    f = spark.createDataFrame([(1, "a", BASE)], "event_id long, user_id string, event_time timestamp_ntz")
    v = spark.createDataFrame([("a", BASE, 7)], "user_id string, event_time timestamp_ntz, level int")
    how = ("user_id", "event_time", "event_id", "event_time", ["level"])
    assert EN.enrich_as_of(f, v, *how).first()["level"] == 7
    assert EN.enrich_as_of(f, v.where("false"), *how).first()["level"] is None
    assert EN.enrich_as_of(f.where("false"), v, *how).count() == 0


def test_a_hot_key_is_cut_and_plans_no_pairs(spark):
    t = F.timestamp_add("SECOND", F.col("id"), F.lit(BASE).cast("timestamp_ntz"))
    f = spark.range(20_000).select(F.col("id").alias("event_id"), F.lit("hot").alias("user_id"), t.alias("event_time"))
    v = spark.range(0, 20_000, 1000).select(F.lit("hot").alias("user_id"), t.alias("since"), F.col("id").alias("level"))
    got = EN.enrich_as_of(f, v, "user_id", "event_time", "event_id", "since", ["level"], target_rows=500)
    assert got.where("level <> event_id - event_id % 1000").count() == 0 and got.count() == 20_000
    text = got._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in text and "Cartesian" not in text


def test_sketches_merge_over_batches_and_hours(spark):
    t = F.timestamp_add("MINUTE", F.col("id") % 4320, F.lit(BASE).cast("timestamp_ntz"))
    rows = spark.range(200_000).select(
        t.alias("event_time"), F.when(F.col("id") % 2 == 0, "x").otherwise("y").alias("kind"), F.pmod(F.xxhash64("id"), F.lit(30_000)).cast("string").alias("who"),
        (F.pmod(F.xxhash64("id", F.lit(1)), F.lit(1_000_000)) / 1000.0).alias("v"))
    whole = K.sketch_partials(rows, "who", "v", ["kind"])
    parts = [K.sketch_partials(rows.where(F.pmod(F.hash("v"), F.lit(5)) == k), "who", "v", ["kind"]) for k in range(5)]
    logged = parts[0]
    for p in parts[1:]:
        logged = logged.unionByName(p)
    for partials in (whole, logged):
        got = K.sketch_rollup(partials, ["kind"], (0.1, 0.5, 0.99))
        assert {r["grain"]: r["count"] for r in got.groupBy("grain").count().collect()} == {0: 144, 1: 72, 3: 3, 7: 1}
        for r in got.where("grain IN (3, 7)").collect():
            mine = rows if r["day"] is None else rows.where(F.to_date("event_time") == F.lit(r["day"].date()))
            users, n = mine.agg(F.countDistinct("who"), F.count(F.lit(1))).first()
            assert r["event_count"] == n and abs(r["entities"] - users) <= 3 * K.COUNT_ERROR * users
            ranks = mine.agg(*[F.avg((F.col("v") <= q).cast("int")) for q in r["quantiles"]]).first()
            assert all(abs(a - b) <= 1.5 * K.RANK_ERROR for a, b in zip(ranks, (0.1, 0.5, 0.99)))


def test_sketches_of_nulls_and_nothing(spark):
    df = spark.createDataFrame([(None, None, None), (BASE, "a", None), (BASE, None, 2.0)], "event_time timestamp_ntz, who string, v double")
    got = {r["grain"]: r for r in K.sketch_rollup(K.sketch_partials(df, "who", "v"), (), [0.5]).where("grain = 3 OR hour IS NOT NULL").collect()}
    assert got[3]["event_count"] == 3 and got[3]["entities"] == 1 and got[3]["quantiles"] == [2.0]
    only = K.sketch_rollup(K.sketch_partials(df.where("v IS NULL"), "who", "v"), (), [0.5])
    assert all(r["quantiles"] is None for r in only.collect())
    assert K.sketch_partials(df.where("false"), "who", "v").count() == 0
