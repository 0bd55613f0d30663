"""Rows along a space-filling curve, so that files and row groups hold narrow ranges of
several columns at once and a scan's min/max statistics skip most of them."""

from __future__ import annotations

import os
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, TimestampNTZType, TimestampType

BITS = 6  # of each column's place: 64 ranges of about equally many rows
TEXT_BYTES = 7


def _number(df: DataFrame, name: str, prefix: int) -> Column:
    """A number in the order of the column's values (strings: by seven bytes after what all
    values have in common; longer ones tie, which costs skipping only)."""
    kind, c = df.schema[name].dataType, F.col(name)
    if isinstance(kind, StringType):
        part = F.substring(c.cast("binary"), prefix + 1, TEXT_BYTES)
        return F.conv(F.rpad(F.hex(part), 2 * TEXT_BYTES, "0"), 16, 10).cast("double")
    if isinstance(kind, (TimestampType, TimestampNTZType)):
        return F.unix_micros(c.cast("timestamp")).cast("double")
    return c.cast("double")


def _hilbert_steps() -> tuple[list[int], list[int]]:
    """For each state (2 * flipped + swapped) and next pair of bits, the curve's digit and the
    state after it: a quadrant whose second bit is 0 is swapped, and flipped if its first is 1."""
    digits, states = [], []
    for state in range(4):
        for pair in range(4):
            x, y = (pair >> 1) ^ (state >> 1), (pair & 1) ^ (state >> 1)
            x, y = (y, x) if state & 1 else (x, y)
            digits.append((3 * x) ^ y)
            states.append(state if y else state ^ (2 * x + 1))
    return digits, states


def _hilbert(x: Column, y: Column, bits: int) -> Column:
    """The place of (x, y) on the Hilbert curve, which has no jumps: a run of it has a small
    range in both columns."""
    digits, states = (F.array(*[F.lit(v) for v in t]) for t in _hilbert_steps())
    key, state = F.lit(0).cast("long"), F.lit(0)
    for b in reversed(range(bits)):
        one = F.lit(1).cast("long")
        pair = (F.shiftright(x, b).bitwiseAND(one) * 2 + F.shiftright(y, b).bitwiseAND(one)).cast("int")
        at = state * 4 + pair
        key = key * 4 + F.get(digits, at)
        state = F.get(states, at)
    return key


def curve_key(df: DataFrame, columns: Sequence[str], bits: int = BITS) -> Column:
    """A row's place on a curve through the quantile ranges of its columns: the Hilbert curve
    for two columns, interleaved bits for more.  Aggregates over ``df`` find the quantiles;
    NULLs come first."""
    texts = [c for c in columns if isinstance(df.schema[c].dataType, StringType)]
    ends = df.agg(F.lit(0), *[f(c) for c in texts for f in (F.min, F.max)]).first()[1:] if texts else ()
    common = {c: len(os.path.commonprefix([(ends[2 * i] or "").encode(), (ends[2 * i + 1] or "").encode()]))
              for i, c in enumerate(texts)}
    numbers = [_number(df, c, common.get(c, 0)) for c in columns]
    shares = [i / (1 << bits) for i in range(1, 1 << bits)]
    edges = df.agg(*[F.percentile_approx(n, shares, 1_000) for n in numbers]).first()
    places = []
    for n, e in zip(numbers, edges):
        found = F.array(*[F.lit(x) for x in sorted(set(e or []))]).cast("array<double>")
        places.append(F.coalesce(F.size(F.filter(found, lambda x: x <= n)), F.lit(0)).cast("long"))
    if len(places) == 2:
        return _hilbert(*places, bits)
    key = F.lit(0).cast("long")
    for b in range(bits):
        for i, p in enumerate(places):
            bit = F.shiftright(p, b).bitwiseAND(F.lit(1).cast("long"))
            key = key.bitwiseOR(F.shiftleft(bit, b * len(places) + i))
    return key


def write_clustered(df: DataFrame, path: str, partitions: Sequence[str], columns: Sequence[str], rows_per_file: int) -> None:
    """Overwrite ``path``: rows in curve order inside each partition, in files of about
    ``rows_per_file`` rows.  Ranges of (partition, curve place) are dealt to tasks by their
    number of rows, so a hot day is many tasks' work and a quiet one adds a file only."""
    files = max(1, -(-df.count() // rows_per_file))
    placed = df.withColumn("_place", curve_key(df, columns))
    order = [*partitions, "_place", *columns]
    (placed.repartitionByRange(files, *order).sortWithinPartitions(*order).drop("_place")
     .write.mode("overwrite").option("maxRecordsPerFile", rows_per_file).partitionBy(*partitions).parquet(path))
