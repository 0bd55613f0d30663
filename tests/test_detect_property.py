"""Property: the bucketed previous-N statistics equal a plain per-key window for
random data, window sizes and bucket targets, with NULL keys, times and values, ties,
and a stray time."""

import datetime as dt
import math

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidewater.operators import detect as D

BASE = dt.datetime(2024, 1, 1)

rows = st.lists(st.tuples(st.sampled_from(["a", "b", None]),
                          st.one_of(st.none(), st.just(-10**9), st.integers(min_value=0, max_value=50),
                                    st.integers(min_value=0, max_value=5000)),   # seconds: frequent ties
                          st.one_of(st.none(), st.floats(-100, 100, allow_nan=False))),
                min_size=1, max_size=150)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows, st.integers(min_value=1, max_value=6), st.integers(min_value=1, max_value=40))
def test_previous_rows_stats_matches_window(spark, data, n, target):
    df = spark.createDataFrame([(i, k, None if s is None else BASE + dt.timedelta(seconds=s), v) for i, (k, s, v) in enumerate(data)],
                               "event_id long, sensor_id string, event_time timestamp_ntz, reading double")
    got = {r["event_id"]: r for r in D.previous_rows_stats(df, "sensor_id", "reading", n, target_rows=target).collect()}
    w = Window.partitionBy("sensor_id").orderBy("event_time", "event_id").rowsBetween(-n, -1)
    ref = df.select("event_id", F.count("reading").over(w).alias("c"), F.avg("reading").over(w).alias("m"),
                    F.stddev_samp("reading").over(w).alias("s")).collect()
    assert len(got) == len(ref) == len(data)
    for r in ref:
        g = got[r["event_id"]]
        assert g["prev_count"] == r["c"]
        for a, b in ((g["prev_mean"], r["m"]), (g["prev_std"], r["s"])):
            assert (a is None and b is None) or math.isclose(a, b, rel_tol=1e-9, abs_tol=1e-9)
