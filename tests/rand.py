"""Deterministic per-row randomness from a row id and a salt.

``xxhash64(id, salt)`` instead of ``rand(seed)``: rand depends on how rows are
partitioned, so a re-run on another cluster layout (or a recomputed lost
partition) would draw different values.  Hash draws depend only on the row."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

_M = 1 << 31


def uniform(id_col: Column, salt: int, lo: float = 0.0, hi: float = 1.0) -> Column:
    u = F.pmod(F.xxhash64(id_col, F.lit(salt)), F.lit(_M)).cast("double") / float(_M)
    return F.lit(lo) + u * F.lit(hi - lo)


def randint(id_col: Column, salt: int, lo: int, hi: int) -> Column:
    """Uniform integer in [lo, hi]."""
    return (F.lit(lo) + F.floor(uniform(id_col, salt) * F.lit(hi - lo + 1))).cast("int")


def choice(id_col: Column, salt: int, values: Sequence) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), randint(id_col, salt, 1, len(values)))


def hex_digits(id_col: Column, salt: int, n: int) -> Column:
    h = F.lower(F.hex(F.xxhash64(id_col, F.lit(salt))))
    return F.substring(F.lpad(h, 16, "0"), 1, n)


def uuid_like(id_col: Column, salt: int) -> Column:
    """8-4-4-4-12 lowercase hex, version nibble 4."""
    a, b = hex_digits(id_col, salt, 16), hex_digits(id_col, salt + 7919, 16)
    return F.concat_ws("-", F.substring(a, 1, 8), F.substring(a, 9, 4),
                       F.concat(F.lit("4"), F.substring(a, 14, 3)),
                       F.substring(b, 1, 4), F.substring(b, 5, 12))


def ipv4(id_col: Column, salt: int) -> Column:
    return F.concat_ws(".", *[randint(id_col, salt + i, 1 if i == 0 else 0, 255).cast("string")
                              for i in range(4)])


def maybe_null(id_col: Column, salt: int, value: Column, p_null: float) -> Column:
    """``value`` with probability 1 - p_null, else NULL."""
    return F.when(uniform(id_col, salt) >= F.lit(p_null), value)
