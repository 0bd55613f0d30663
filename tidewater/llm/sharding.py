"""Sharding by a permutation-filled lookup table.

Each shard has a preference order over the slots of a table of prime size M: it starts at
``offset`` and steps by ``skip`` (both from the md5 of its name), which visits every slot
because M is prime.  Shards take turns; at each turn a shard claims its first preferred
slot that is still free.  Shares therefore differ by one slot at most, and adding or
removing a shard moves few slots besides its own.  A row's slot is the md5 of its key
modulo M; the broadcast table gives its shard in constant time, without a shuffle.

Only DataFrame and SQL functions are used.  Bound: the table has M rows, M is a
parameter and at most ``MAX_SLOTS``; shards at most M.

Edge cases: a null key counts as a key of its own (the text of a null key differs from
that of an empty one).  Rows with one key go to one shard, in any number, and cost nothing
more, as no row is moved.  Empty tables give no rows.  The placement columns are returned
beside the caller's, under free names if theirs clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

MAX_SLOTS = 16_381
SLOTS = 4_093  # prime
SHARDS = 32


def digest(text: Column) -> Column:
    """The first 60 bits of the md5 of a text."""
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")


def is_prime(n: int) -> bool:
    return n > 1 and all(n % d for d in range(2, int(n**0.5) + 1))


def lookup_table(spark: SparkSession, shards: int = SHARDS, slots: int = SLOTS) -> DataFrame:
    """(slot, shard), one row per slot."""
    if not (is_prime(slots) and 1 <= shards <= slots <= MAX_SLOTS):
        raise ValueError(f"slots must be a prime up to {MAX_SLOTS}, and shards 1 to slots")
    ints = lambda n: F.sequence(F.lit(0), F.lit(n - 1))
    shard = F.col("id").cast("string")
    # gathered by an aggregate, so that the wishes are computed before the turns, once
    wishes = (spark.range(shards).select(
        "id", (digest(F.concat(F.lit("offset-"), shard)) % slots).alias("offset"),
        (digest(F.concat(F.lit("skip-"), shard)) % (slots - 1) + 1).alias("skip"))
        .select("id", F.transform(ints(slots), lambda j: (
            (F.col("offset") + j * F.col("skip")) % slots).cast("int")).alias("wish"))
        .agg(F.array_sort(F.collect_list(F.struct("id", "wish")))["wish"].alias("wishes")))
    turns = wishes.select(F.aggregate(
        ints(slots), F.array().cast("array<int>"),
        lambda claimed, turn: F.concat(claimed, F.array(
            F.array_except(F.col("wishes")[turn % shards], claimed)[0]))).alias("claimed"))
    return (turns.select(F.posexplode("claimed").alias("turn", "slot"))
            .select("slot", (F.col("turn") % shards).cast("int").alias("shard")))


def place(df: DataFrame, key: Column, shards: int = SHARDS, slots: int = SLOTS,
          slot_col: str = "slot", shard_col: str = "shard") -> DataFrame:
    """``df`` with the slot and shard of each row's ``key``."""
    from tidewater.llm.common import free_name
    slot_col = free_name(df.columns, slot_col)
    shard_col = free_name([*df.columns, slot_col], shard_col)
    text = F.coalesce(F.concat(F.lit("k"), key.cast("string")), F.lit("null"))
    table = lookup_table(df.sparkSession, shards, slots).select(
        F.col("slot").alias(slot_col), F.col("shard").alias(shard_col))
    placed = df.withColumn(slot_col, (digest(text) % slots).cast("int"))
    return placed.join(F.broadcast(table), slot_col).select(*df.columns, slot_col, shard_col)
