"""SimHash near-duplicates by bit-sliced comparison.

Fingerprints: words are runs of bytes other than ASCII white space, A-Z lower-cased; each
run of ``shingle`` words (the whole text, if shorter) is hashed with XXH64, and a bit is
set if more than half the hashes have it.  Fingerprints link at ``radius`` or fewer
differing bits; a group is what links reach.

Search: copies share a fingerprint, so only distinct fingerprints are compared.  The 64
bits are cut into blocks; two fingerprints within the radius agree on all but ``radius``
blocks, so for each choice of the other blocks those with equal bits there meet in a
bucket.  The number of blocks follows the number of fingerprints; any number is exact.  A
bucket above ``BUCKET`` rows is split into parts that meet pairwise in different tasks.
Within a task the fingerprints are stored as 64 bit planes; each word operation advances
64 comparisons, a carry-save counter holds the distances, and words in which all 64 exceed
the radius are abandoned.  A task returns a spanning forest of the links, never all pairs,
and stars of minima join the forests to groups.

Edge cases: null or word-free text has fingerprint zero and links like any other.  Null
ids are grouped but never represent a group that has another id.  Repeated rows link to
each other.  Empty tables give no rows.  Very long texts are hashed in pieces.  Extra columns
play no part in ``near_duplicates``; ``deduplicate`` keeps them.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F

from tidewater.llm.common import checkpointed, free_name, join_counted

SHINGLE, SEED, RADIUS = 3, 42, 3
BUCKET = 8_192  # rows that one task compares at most, twice over
MOST_CROWDED = 1_000_000  # buckets above BUCKET whose counts are broadcast
TASK_ROWS = 1 << 18
_PIECE = 1 << 16


def fingerprint_of(text: str | None, shingle: int = SHINGLE) -> int:
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    whole, digest = b" ".join(words), xxhash.xxh64_intdigest
    ends = np.cumsum([len(w) + 1 for w in words])
    first = [0, *ends[:max(0, len(words) - shingle)].tolist()]
    last = (ends[shingle - 1:] - 1).tolist() or [len(whole)]
    total, counts = len(first), np.zeros(64, dtype=np.int64)
    for i in range(0, total, _PIECE):
        hashes = np.array([digest(whole[a:b], SEED) for a, b in zip(first[i:i + _PIECE], last[i:i + _PIECE])],
                          dtype=np.uint64)
        bits = np.unpackbits(hashes.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
        counts += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(counts * 2 > total).tobytes(), "big", signed=True)


def fingerprint(text: Column, shingle: int = SHINGLE) -> Column:
    """The fingerprint as a signed 64-bit integer."""

    @F.pandas_udf("long")
    def prints(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([fingerprint_of(t, shingle) for t in texts], dtype="int64")

    return prints(text)


def masks(blocks: int, radius: int) -> list[int]:
    """For each choice of ``blocks - radius`` blocks, the mask of their bits, signed."""
    cuts = [64 * i // blocks for i in range(blocks + 1)]
    block = [((1 << (b - a)) - 1) << a for a, b in zip(cuts, cuts[1:])]
    return [sum(c) - ((sum(c) >> 63) << 64) for c in combinations(block, blocks - radius)]


def blocks_for(rows: int, radius: int) -> int:
    """As many blocks as make a bucket of evenly spread fingerprints hold about 64."""
    blocks = radius + 1
    while 64 * (blocks - radius) // blocks < 48 and rows >> (64 * (blocks - radius) // blocks) > 64:
        blocks += 1
    return blocks


def planes_of(prints: np.ndarray) -> np.ndarray:
    """(64, words): plane p holds bit p of all fingerprints, 64 rows a word."""
    words = -(-len(prints) // 64)
    rows = np.zeros((words * 64, 8), dtype=np.uint8)
    rows[:len(prints)] = prints.astype("<u8").view(np.uint8).reshape(-1, 8)
    bits = np.unpackbits(rows, axis=1, bitorder="little")
    return np.packbits(bits.T.copy(), axis=1, bitorder="little").view("<u8")


def shifted(planes: np.ndarray, by: int) -> np.ndarray:
    """Planes in which row i holds row i + by."""
    words, bits = divmod(by, 64)
    moved = np.zeros_like(planes)
    kept = planes[..., words:]
    moved[..., :kept.shape[-1]] = kept >> np.uint64(bits)
    if bits:
        moved[..., :max(0, kept.shape[-1] - 1)] |= kept[..., 1:] << np.uint64(64 - bits)
    return moved


def near(planes: np.ndarray, by: int, valid: np.ndarray, radius: int) -> np.ndarray:
    """Rows i (of the ``valid`` ones, a bit each) whose row i + by differs in at most
    ``radius`` bits."""
    alive = np.flatnonzero(valid)
    over = ~valid[alive]
    counter = [np.zeros_like(over) for _ in range(max(1, radius.bit_length()))]
    apart = shifted(planes, by)
    for p in range(0, 64, 2):
        x, y = (planes[q, alive] ^ apart[q, alive] for q in (p, p + 1))
        half = counter[0] ^ x
        carry = (counter[0] & x) | (half & y)
        counter[0] = half ^ y
        for k in range(1, len(counter)):
            counter[k], carry = counter[k] ^ carry, counter[k] & carry
        over |= carry
        if p % 8 == 6:
            live = over != np.uint64(0xFFFFFFFFFFFFFFFF)
            if not live.all():
                alive, over = alive[live], over[live]
                counter = [c[live] for c in counter]
                if not len(alive):
                    break
    spread = lambda w: np.unpackbits(w.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    word, bit = np.nonzero(spread(np.ascontiguousarray(~over)))
    distance = sum((spread(np.ascontiguousarray(c))[word, bit].astype(np.int64) << k) for k, c in enumerate(counter))
    return (alive[word] * 64 + bit)[distance <= radius]


def forest(prints: np.ndarray, sizes: np.ndarray, radius: int) -> np.ndarray:
    """For rows in runs (``sizes``: the length of each row's run), the row that stands for
    those that a row reaches by links inside runs."""
    root = np.arange(len(prints))
    rows = np.arange(len(prints))
    place = rows - run_starts(sizes)
    by, planes = 1, None
    while True:
        if planes is None or by & (by - 1) == 0:  # at powers of two, leave out the runs that are done
            stay = sizes[rows] > by
            if not stay.any():
                return root
            rows = rows[stay]
            planes = planes_of(prints[rows])
        left = np.zeros(planes.shape[1] * 64, dtype=np.uint8)
        left[:len(rows)] = place[rows] + by < sizes[rows]
        i = near(planes, by, np.packbits(left, bitorder="little").view("<u8"), radius)
        a, b = rows[i], rows[i] + by
        apart = root[a] != root[b]
        if apart.any():
            for x, y in zip(a[apart].tolist(), b[apart].tolist()):
                while root[x] != x:
                    x = root[x]
                while root[y] != y:
                    y = root[y]
                root[max(x, y)] = min(x, y)
            while (root != (higher := root[root])).any():
                root = higher
        by += 1


def run_starts(sizes: np.ndarray) -> np.ndarray:
    """For each row, the first row of its run."""
    starts, at = np.zeros(len(sizes), dtype=np.int64), 0
    while at < len(sizes):
        starts[at:at + sizes[at]] = at
        at += sizes[at]
    return starts


def links(prints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Edges (u, v) of a forest that joins all fingerprints (column fp, distinct) within
    the radius of each other."""
    cuts = masks(blocks_for(prints.count(), radius), radius)
    keyed = prints.select("fp", F.explode(F.array(*[
        F.struct(F.lit(t).alias("t"), F.col("fp").bitwiseAND(F.lit(m).cast("long")).alias("key"))
        for t, m in enumerate(cuts)])).alias("k")).select("fp", "k.t", "k.key")
    # buckets of one part need no count; the others are few: each holds more than BUCKET rows
    crowded = checkpointed(keyed.groupBy("t", "key").count().where(F.col("count") > BUCKET))
    crowded = F.broadcast(crowded) if crowded.count() <= MOST_CROWDED else crowded
    parts = F.coalesce(F.ceil(F.col("count") / BUCKET), F.lit(1).cast("long"))
    part = F.pmod(F.xxhash64("fp"), parts)
    others = F.when(parts == 1, F.array(F.lit(0).cast("long"))).otherwise(
        F.filter(F.sequence(F.lit(0).cast("long"), parts - 1), lambda j: j != part))
    dealt = (keyed.join(crowded, ["t", "key"], "left").select("fp", "t", "key", part.alias("p"), F.explode(others).alias("q"))
             .select("fp", "t", "key", F.least("p", "q").alias("a"), F.greatest("p", "q").alias("b"))
             .repartition("t", "key", "a", "b").sortWithinPartitions("t", "key", "a", "b"))

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []
        rows = 0

        def edges(frame: pd.DataFrame) -> pd.DataFrame:
            keys = frame[["t", "key", "a", "b"]].to_numpy()
            start = np.flatnonzero(np.concatenate([[True], (keys[1:] != keys[:-1]).any(axis=1)]))
            lengths = np.diff(np.append(start, len(keys)))
            fps = frame["fp"].to_numpy()
            root = forest(fps.view(np.uint64), np.repeat(lengths, lengths), radius)
            moved = np.flatnonzero(root != np.arange(len(root)))
            return pd.DataFrame({"u": fps[moved], "v": fps[root[moved]]})

        for frame in batches:
            held.append(frame)
            rows += len(frame)
            if rows >= TASK_ROWS:
                whole = pd.concat(held)
                keys = whole[["t", "key", "a", "b"]].to_numpy()
                last = np.flatnonzero((keys != keys[-1]).any(axis=1))
                done = int(last[-1]) + 1 if len(last) else 0  # the last run may go on
                if done:
                    yield edges(whole.iloc[:done])
                held, rows = [whole.iloc[done:]], len(whole) - done
        if rows:
            yield edges(pd.concat(held))

    return dealt.mapInPandas(compare, "u long, v long").distinct()


def stars(edges: DataFrame) -> DataFrame:
    """(node, root) for each node of ``edges`` (u, v) that is not its group's least node.
    Alternates large and small stars; every step keeps at most as many edges."""

    def to_least(both: DataFrame, rows: int) -> DataFrame:
        least = both.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n"))
        return join_counted(both, least, "u", "n", rows).withColumn("m", F.least("u", "m"))

    def state(e: DataFrame):
        return e.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()

    edges = checkpointed(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    before = None
    while (now := state(edges)) != before:
        before = now
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = checkpointed(to_least(both, 2 * now[0]).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        small = to_least(large, now[0]).select(F.explode(F.array(F.struct("u", F.col("m").alias("v")),
                                                         F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
        edges = checkpointed(small.select("e.*").where("u != v").distinct())
    return edges.select(F.col("u").alias("fp"), F.col("v").alias("root"))


def groups(prints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(fp, root, component_id, n) for each distinct fingerprint of ``prints`` (doc_id, fp): the
    group's least fingerprint and least id, and the fingerprint's rows."""
    distinct = checkpointed(prints.groupBy("fp").agg(F.min("doc_id").alias("least"), F.count("*").alias("n")))
    roots = stars(links(distinct.select("fp"), radius))
    rooted = distinct.join(roots, "fp", "left").select("fp", "least", "n", F.coalesce("root", "fp").alias("root"))
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    return checkpointed(rooted.join(least, "root").select("fp", "root", "component_id", "n"))


def near_duplicates(docs: DataFrame, radius: int = RADIUS, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, fp, component_id) for every row of ``docs`` (doc_id, text)."""
    prints = checkpointed(docs.select("doc_id", fingerprint(F.col("text"), shingle).alias("fp")))
    return join_counted(prints, groups(prints, radius), "fp", "n", prints.count()).select("doc_id", "fp", "component_id")


def deduplicate(docs: DataFrame, radius: int = RADIUS, shingle: int = SHINGLE) -> DataFrame:
    """One row of each group, that of the least id; columns unchanged.  Rows of one id and
    one text are told apart by their other columns, and of equal rows one stays."""
    k1, k2 = free_name(docs.columns, "_k1"), free_name(docs.columns, "_k2")
    content = (F.xxhash64("doc_id", "text"), F.hash("doc_id", "text"))
    slim = checkpointed(docs.select("doc_id", content[0].alias("k1"), content[1].alias("k2"),
                                    fingerprint(F.col("text"), shingle).alias("fp")))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "k1", "k2"))
    kept = (join_counted(slim, groups(slim, radius), "fp", "n", slim.count()).groupBy("root")
            .agg(first.alias("first")).select(F.col("first.k1").alias(k1), F.col("first.k2").alias(k2)).distinct())
    keyed = docs.withColumns({k1: content[0], k2: content[1]}).join(kept, [k1, k2])
    rank = free_name(keyed.columns, "_rank")
    one = Window.partitionBy(k1, k2).orderBy(F.xxhash64(*docs.columns))
    return keyed.withColumn(rank, F.row_number().over(one)).where(F.col(rank) == 1).select(*docs.columns)
