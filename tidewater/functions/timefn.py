"""Time helpers.  Timestamps are TIMESTAMP_NTZ at rest and TIMESTAMP while a
stream needs an event-time column (watermarks reject NTZ).  The casts between
the two use the session zone in both directions, so they round-trip exactly."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: ISO-8601 local date-time, fraction optional (it is omitted when 0).
ISO_LOCAL_PATTERN = "yyyy-MM-dd'T'HH:mm:ss[.SSSSSSSSS]"
ISO_LOCAL_WRITE_PATTERN = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def col_(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_iso_local(s) -> Column:
    """ISO-8601 local text, up to nine fraction digits (cut to microseconds) -> TIMESTAMP;
    anything else (space separator, zone suffix, junk) -> NULL instead of an error."""
    return F.try_to_timestamp(col_(s), F.lit(ISO_LOCAL_PATTERN))


def format_iso_local(ts) -> Column:
    return F.date_format(col_(ts), ISO_LOCAL_WRITE_PATTERN)


def to_event_time(ts) -> Column:
    """NTZ -> TIMESTAMP, for watermarks and event-time windows."""
    return col_(ts).cast("timestamp")


def to_rest(ts) -> Column:
    """TIMESTAMP -> NTZ, before a sink or a comparison."""
    return col_(ts).cast("timestamp_ntz")


def hour_trunc(ts) -> Column:
    """Hour truncation of an NTZ timestamp, built from its fields so no time zone
    is involved (date_trunc would round-trip through the session zone and shift
    wall-clock hours that fall in a daylight-saving gap)."""
    c = col_(ts)
    return F.make_timestamp_ntz(F.year(c), F.month(c), F.dayofmonth(c), F.hour(c), F.lit(0), F.lit(0))


def hour_sql(column: str) -> str:
    """:func:`hour_trunc` as SQL text."""
    return (f"make_timestamp_ntz(year({column}), month({column}), dayofmonth({column}), "
            f"hour({column}), 0, 0)")


def day_trunc(ts) -> Column:
    return F.to_date(col_(ts)).cast("timestamp_ntz")


def event_date(ts) -> Column:
    """Materialised day(event_time) partition value (Parquet tables have no hidden transforms)."""
    return F.to_date(col_(ts))


def event_hour(ts) -> Column:
    """Hours since a fixed local origin.  Parquet files skip by the range of an integer column;
    by that of a timestamp without zone Spark does not let them."""
    origin = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.floor(F.timestamp_diff("SECOND", origin, col_(ts).cast("timestamp_ntz")) / 3600).cast("int")


def zone_window_offset(spark, duration_s: int) -> str:
    """``startTime`` that aligns ``window(ts, duration)`` to wall-clock boundaries
    of the session zone.  Windows are epoch (UTC) aligned; a zone whose offset is
    not a multiple of the duration (e.g. +05:30 for hourly windows) needs this
    shift.  Whole-hour daylight-saving changes keep the alignment."""
    import datetime as dt
    import re
    name = spark.conf.get("spark.sql.session.timeZone")
    try:
        from zoneinfo import ZoneInfo
        off = ZoneInfo(name).utcoffset(dt.datetime(2024, 1, 1))
        secs = int(off.total_seconds())
    except Exception:  # noqa: BLE001 - e.g. "GMT+05:30" / "+05:30"
        m = re.search(r"([+-])(\d{1,2}):?(\d{2})?", name or "")
        secs = 0 if not m else (1 if m.group(1) == "+" else -1) * (int(m.group(2)) * 3600 + int(m.group(3) or 0) * 60)
    # local boundary L = UTC instant U + offset; L on the grid <=> U = -offset (mod duration)
    return f"{(-secs) % duration_s} seconds"
