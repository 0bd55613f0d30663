"""Small helpers shared by the training-data operators."""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

import tidewater
from tidewater.session import shared_root

HOT_ROWS = 100_000  # of one key, from which a join broadcasts what the key meets


def importable(spark: SparkSession) -> None:
    """Lets the session's Python workers import this package from where the driver has it,
    wherever the driver was started.  Where workers have other folders, ship it with
    ``--py-files``."""
    env, root = spark.sparkContext.environment, os.path.dirname(os.path.dirname(os.path.abspath(tidewater.__file__)))
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([*paths, root])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of ``sf_dir``, for a query that runs this package's code in workers."""
    importable(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def free_name(taken, base: str) -> str:
    """A column name that none of ``taken`` has (names compare without case)."""
    low, name = {c.lower() for c in taken}, base
    while name.lower() in low:
        name += "_"
    return name


def fold(key: Column, mod: int) -> Column:
    """crc32 of the key's text, modulo ``mod``; a null key counts as the empty text."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % mod


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` written once to the shared checkpoint folder: later steps neither repeat
    the work nor lose it with an executor."""
    shared_root(df.sparkSession)
    return df.checkpoint()


def join_counted(rows: DataFrame, found: DataFrame, key: str, count: str, total: int) -> DataFrame:
    """``rows`` (``total`` of them) with the columns of ``found``, which has one row a key and says
    in ``count`` how many rows hold it.  Keys of many rows are joined by broadcast, so that no key
    gathers its rows in one task: at most a million keys, as each holds a millionth of all rows."""
    many = max(HOT_ROWS, total // 1_000_000)
    hot = F.broadcast(found.where(F.col(count) > many))
    rest = rows.join(hot.select(key), key, "left_anti").join(found.where(F.col(count) <= many), key)
    return rows.join(hot, key).unionByName(rest).drop(count)


def keep_where(docs: DataFrame, verdict: Column) -> DataFrame:
    """The rows whose ``verdict`` (often a UDF) is true, with the columns of ``docs`` only."""
    flag = free_name(docs.columns, "_keep")
    return docs.withColumn(flag, verdict).where(F.col(flag)).drop(flag)


def hash_share(key: Column, group: Column, wanted: dict, counts: dict) -> Column:
    """Whether a row's hash is low enough to be among the ``wanted[g]`` least of its group of
    ``counts[g]`` rows: keeps about three times as many, so that ranking them is little
    work, and nearly surely all of those."""
    share = F.lit(None).cast("double")
    for g, n in counts.items():
        share = F.when(group == g, min(1.0, (3 * wanted[g] + 50) / max(n, 1))).otherwise(share)
    return F.shiftrightunsigned(key, 11) / float(1 << 53) < share


def within_reach(length: Column, group: Column, shortest: dict, limit: int) -> Column:
    """Whether a row is short enough to learn from: ``limit`` characters, or for a group without
    such rows as many as its shortest row has (``shortest``: group -> that length)."""
    far = {g: n for g, n in shortest.items() if n > limit}
    reach = F.lit(limit)
    for g, n in far.items():
        reach = F.when(group == g, n).otherwise(reach)
    return length <= reach
