"""Lenient decode table, timestamp strictness, encode/decode round trip."""

from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from tidewater.functions.codec import ERR_MALFORMED, ERR_NOT_OBJECT, ERR_NULL, dead_letters, decode, decode_valid, split_dead_letters, valid_rows
from tidewater.functions.timefn import parse_iso_local
from tidewater.schemas import LOCATION, SENSOR_PAYLOAD, USER_ACTIVITY_PAYLOAD

SCHEMA = StructType([f for f in USER_ACTIVITY_PAYLOAD.fields if f.name in ("page_url", "time_spent", "product_ids")]
                    + [StructField("reading", SENSOR_PAYLOAD["reading"].dataType),
                       StructField("location", LOCATION)])


def _decode(spark, payloads):
    df = spark.createDataFrame([(i, p) for i, p in enumerate(payloads)], "offset long, value string")
    return decode(df, SCHEMA, keep=("offset",))


def test_field_level_leniency(spark):
    payloads = [
        '{"reading":"bad","time_spent":5,"page_url":"u"}',
        '{"reading":"1.5","time_spent":"7"}',
        '{"time_spent":99999999999,"page_url":"u"}',
        '{"product_ids":"notarray","page_url":"z"}',
        '{"location":5,"page_url":"z"}',
        '{"location":{"lat":"x","lon":2,"facility":"f"},"page_url":"z"}',
        '{"product_ids":["a",5,null],"page_url":"z"}',
        '{"page_url":null}',
        '{}',
        '{"page_url":"x","extra":{"deep":[1,2]}}',
    ]
    rows = {r["offset"]: r for r in valid_rows(_decode(spark, payloads), SCHEMA, keep=("offset",)).collect()}
    assert len(rows) == 10
    df = spark.createDataFrame(list(enumerate(payloads)), "offset long, value string")
    single = {r["offset"]: r for r in decode_valid(df, SCHEMA, keep=("offset",)).collect()}
    assert single == rows
    assert rows[0]["reading"] is None and rows[0]["time_spent"] == 5 and rows[0]["page_url"] == "u"
    assert rows[1]["reading"] == 1.5 and rows[1]["time_spent"] == 7
    assert rows[2]["time_spent"] is None and rows[2]["page_url"] == "u"
    assert rows[3]["product_ids"] is None and rows[3]["page_url"] == "z"
    assert rows[4]["location"] is None
    loc = rows[5]["location"]
    assert loc["lat"] is None and loc["lon"] == 2.0 and loc["facility"] == "f"
    assert list(rows[6]["product_ids"]) == ["a", "5", None]
    assert all(rows[7][c] is None for c in ("page_url", "time_spent", "reading"))
    assert all(rows[8][c] is None for c in ("page_url", "time_spent", "reading"))
    assert rows[9]["page_url"] == "x"


def test_message_level_dead_letters(spark):
    bad = ["{bad", "", "   ", "null", "[1]", '[{"page_url":"a"}]', "5", '"s"', None]
    dec = _decode(spark, bad + ['{"page_url":"ok"}'])
    assert valid_rows(dec, SCHEMA, keep=("offset",)).count() == 1
    dl = {r["offset"]: r["error"] for r in split_dead_letters(dec).collect()}
    df = spark.createDataFrame([(i, p) for i, p in enumerate(bad + ['{"page_url":"ok"}'])], "offset long, value string")
    assert {r["offset"]: r["error"] for r in dead_letters(df, SCHEMA, keep=("offset",)).collect()} == dl
    assert [r["offset"] for r in decode_valid(df, SCHEMA, keep=("offset",)).collect()] == [len(bad)]
    assert len(dl) == len(bad)
    assert dl[0] == ERR_MALFORMED and dl[1] == ERR_MALFORMED
    assert dl[3] == ERR_NOT_OBJECT and dl[4] == ERR_NOT_OBJECT and dl[7] == ERR_NOT_OBJECT
    assert dl[8] == ERR_NULL


def test_iso_local_timestamps(spark):
    df = spark.createDataFrame([("2025-03-15T10:11:12",), ("2025-03-15T10:11:12.123456",), ("2025-03-15T10:11:12.123456789",),
                                ("2025-03-15 10:11:12",), ("2025-03-15T10:11:12Z",), ("junk",)], "s string")
    got = [r[0] for r in df.select(parse_iso_local("s").cast("timestamp_ntz")).collect()]
    assert got[0].isoformat() == "2025-03-15T10:11:12"
    assert got[1].isoformat() == "2025-03-15T10:11:12.123456"
    assert got[2] == got[1] and got[3:] == [None, None, None]


def test_encode_decode_round_trip(spark):
    from tidewater.sources import bindings as B
    from tidewater.sources.broker import envelope
    from tests.conftest import SF_SMALL
    payload = B.family_payload(spark, SF_SMALL, "sensor_data")
    env = envelope(payload, "sensor_data")
    back = decode_valid(env, SENSOR_PAYLOAD).drop("key", "topic", "partition") \
        .withColumnRenamed("offset", "event_id") \
        .withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz"))
    assert back.exceptAll(payload.select(*back.columns)).count() == 0
    assert payload.select(*back.columns).exceptAll(back).count() == 0


def test_hour_trunc_ignores_session_zone(spark):
    import datetime as dt
    from tidewater.functions.timefn import day_trunc, hour_trunc
    df = spark.createDataFrame([(dt.datetime(2024, 3, 10, 2, 30, 5, 7),), (None,)], "t timestamp_ntz")
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")  # 02:30 is in the DST gap
    try:
        got = df.select(hour_trunc("t").alias("h"), day_trunc("t").alias("d")).collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert got[0]["h"] == dt.datetime(2024, 3, 10, 2) and got[0]["d"] == dt.datetime(2024, 3, 10)
    assert got[1]["h"] is None


def test_duplicate_keys_keep_last_value(spark):
    assert spark.conf.get("spark.sql.variant.allowDuplicateKeys") == "true"
    df = spark.createDataFrame([(1, '{"page_url":"a","page_url":"b","time_spent":3}')], "offset long, value string")
    rows = decode_valid(df, SCHEMA, keep=("offset",)).collect()
    assert [(r["page_url"], r["time_spent"]) for r in rows] == [("b", 3)]
    assert dead_letters(df, SCHEMA, keep=("offset",)).count() == 0


def test_counter_counts_only_decodable_messages(spark):
    from tidewater.streaming.windows import decodable_messages
    vals = ['{"sensor_id":"s1"}', "{}", '{"message":5}', "{bad", "", "null", "[1]", "5", None]
    df = spark.createDataFrame(list(enumerate(vals)), "offset long, value string")
    assert sorted(r["offset"] for r in decodable_messages(df).collect()) == [0, 1, 2]


def test_zone_window_offset_aligns_to_local_hours(spark):
    from tidewater.functions.timefn import zone_window_offset
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        got = {}
        for tz in ("UTC", "Asia/Kolkata", "Asia/Kathmandu", "America/St_Johns", "GMT+05:45"):
            spark.conf.set("spark.sql.session.timeZone", tz)
            got[tz] = zone_window_offset(spark, 3600)
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert got == {"UTC": "0 seconds", "Asia/Kolkata": "1800 seconds", "Asia/Kathmandu": "900 seconds",
                   "America/St_Johns": "1800 seconds", "GMT+05:45": "900 seconds"}
