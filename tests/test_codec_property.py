"""Property: decode(encode(x)) == x for arbitrary user-activity payloads."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tidewater.functions.codec import decode_valid
from tidewater.schemas import USER_ACTIVITY_PAYLOAD
from tidewater.sources.broker import envelope

text = st.one_of(st.none(), st.text(max_size=30))
ints = st.one_of(st.none(), st.integers(min_value=-2**31, max_value=2**31 - 1))
dbls = st.one_of(st.none(), st.floats(allow_nan=False, allow_infinity=False, width=64))
tss = st.one_of(st.none(), st.datetimes(min_value=dt.datetime(1900, 1, 1), max_value=dt.datetime(2200, 1, 1)))
arrays = st.one_of(st.none(), st.lists(st.one_of(st.none(), st.text(max_size=8)), max_size=5))

row = st.tuples(st.text(min_size=1, max_size=12), text, tss, text, text, text, text, text, ints, text, text, ints,
                text, arrays, dbls, text)


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(row, min_size=1, max_size=40))
def test_round_trip(spark, rows):
    schema = USER_ACTIVITY_PAYLOAD.simpleString()[len("struct<"):-1].replace("timestamp:timestamp", "timestamp:timestamp_ntz")
    data = [r + (i,) for i, r in enumerate(rows)]
    df = spark.createDataFrame(data, schema + ",event_id:bigint")
    dec = decode_valid(envelope(df, "user_activity"), USER_ACTIVITY_PAYLOAD, keep=("offset",))
    got = {r["offset"]: r for r in dec.collect()}
    assert len(got) == len(data)
    names = [f.name for f in USER_ACTIVITY_PAYLOAD.fields]
    for src in data:
        g = got[src[-1]]
        for name, v in zip(names, src):
            w = g[name]
            if name == "timestamp" and w is not None:
                w = w.replace(tzinfo=None)
            if name == "timestamp" and v is not None:
                # written with microseconds; read back in the session zone (UTC in tests)
                assert w == v
            else:
                assert w == v, (name, v, w)
