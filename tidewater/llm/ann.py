"""Approximate nearest neighbours by multiprobe p-stable hashing, for the inner product.

Vectors are divided by the largest norm and get one more component that makes all of them
unit vectors; queries are normalised.  Then the largest inner product is the least
Euclidean distance.  A table hashes a vector with ``k`` Gaussian projections cut into cells
of one width.  A query visits its own bucket and those reached by moving some
projections one cell up or down, in the order of the estimated success, the sum of squared
distances to the cell walls.  The candidates of all tables are merged and ranked by the
inner product of the original vectors in double precision.

The index is tuned on a bounded sample: ``TUNING`` queries, whose exact neighbours one pass
over all rows finds, and ``OTHERS`` rows.  For each number of tables, k and width it takes the
least number of probes (up to ``PROBES``) with which the sample's recall reaches ``TARGET``, and
of those settings the one with the least work: inner products, a row met in several tables
counted in each, and ``PROBE_COST`` of them for a probe.  Easy data get several tables of small buckets; data whose neighbours are hardly
nearer than other rows get one or two, as each further table finds mostly rows that another
has found.  Where no setting reaches ``TARGET``, or every candidate is asked for, there is one
bucket.  Every row is indexed.

On Spark: buckets are dealt to parts (table, group of buckets); a part holding too many
rows is salted, and its queries go to each salt.  A task holds the rows of one part and
streams the queries past it, bucket by bucket as matrix products; it returns the best
``n + 1`` of each query.  Vectors of floats cross the shuffle as floats and are widened in the
task, which changes no digit.  Equal vectors are indexed once, and of their rows the ``n + 1``
with the least ids stand for all, as no result can hold more: exact, whatever the number.

Edge cases: vectors that are null, empty, zero or hold null or non-finite components, and
rows without id, take no part.  Rows equal in id and vector count once.  Ties go to the
smaller id.  Vectors that take part must have one length; others raise.  Empty tables give
no rows.  Extra columns play no part.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from math import ceil

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import FloatType

from tidewater.llm.common import checkpointed

TABLES, WIDTHS, MOST_K = (1, 2, 3, 4, 6), (0.8, 1.2, 1.6, 2.0, 2.6), 8
PROBES, PROBE_COST, TARGET, TUNING, OTHERS = 512, 2, 0.97, 64, 1_000
PARTS, PART_ROWS, CHUNK = 4, 65_536, 1_024
SEED = 7


def usable(vector: Column) -> Column:
    """No null, NaN or infinite component, and one other than zero."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    return F.coalesce(F.forall(vector, finite) & F.exists(vector, lambda x: x != 0), F.lit(False))


def norm2(vector: Column) -> Column:
    return F.aggregate(vector, F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))


def probe_sequence(place: np.ndarray, probes: int) -> list[tuple[int, ...]]:
    """The first ``probes`` moves of a point's cell, likeliest first; ``place``: where in
    its cell each projection lies, 0 to 1."""
    k = len(place)
    if not k:
        return [()]
    cost = np.concatenate([place, 1 - place]) ** 2
    order = np.argsort(cost, kind="stable")
    cost, order = cost[order].tolist(), order.tolist()
    found, heap = [(0,) * k], [(cost[0], (0,))]
    while heap and len(found) < probes:
        total, chosen = heapq.heappop(heap)
        sides = [order[a] for a in chosen]
        if len({s % k for s in sides}) == len(sides):  # not both up and down
            move = [0] * k
            for s in sides:
                move[s % k] = -1 if s < k else 1
            found.append(tuple(move))
        last = chosen[-1]
        if last + 1 < 2 * k:
            heapq.heappush(heap, (total - cost[last] + cost[last + 1], (*chosen[:-1], last + 1)))
            heapq.heappush(heap, (total + cost[last + 1], (*chosen, last + 1)))
    return found


class Hashing:
    """The tables' projections, for vectors of ``dims`` components and norms up to ``scale``."""

    def __init__(self, dims: int, scale: float, k: int, probes: int = 1, tables: int = 1, width: float = WIDTHS[-1]):
        rng = np.random.default_rng(SEED)
        self.axes = rng.standard_normal((max(TABLES), 16, dims + 1))[:tables, :k]
        self.shift = rng.uniform(0, 1, (max(TABLES), 16))[:tables, :k]
        self.mix = rng.integers(1, 1 << 62, (max(TABLES), 16))[:tables, :k] | 1
        self.scale, self.k, self.probes, self.tables, self.width = scale, k, probes, tables, width

    def cells(self, vectors: np.ndarray, query: bool) -> np.ndarray:
        """(tables, rows, k) real-valued cells."""
        vectors = vectors.astype(np.float64)
        x = vectors / (np.linalg.norm(vectors, axis=1, keepdims=True) if query else self.scale)
        rest = np.zeros(len(x)) if query else np.sqrt(np.maximum(0, 1 - (x * x).sum(axis=1)))
        x = np.column_stack([x, rest])
        return np.stack([x @ a.T / self.width + s for a, s in zip(self.axes, self.shift)])

    def keys(self, table: int, cells: np.ndarray) -> np.ndarray:
        """A bucket's number from whole cells (rows, k)."""
        h = (cells.astype(np.int64) * self.mix[table]).sum(axis=1)
        return (h ^ (h >> 31)) & 0x7FFFFFFFFFFFFFFF

    def probed(self, table: int, cells: np.ndarray) -> np.ndarray:
        """The keys that one query (its real cells) visits."""
        base = np.floor(cells)
        return np.unique(self.keys(table, base + np.array(probe_sequence(cells - base, self.probes))))


def ranks(mine: np.ndarray, theirs: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """At which place of its query's probe sequence each row is met: ``mine`` (queries, k) and
    ``theirs`` (rows, k) are real-valued cells, ``owner`` (ascending) gives a row's query.
    ``PROBES`` where the first ``PROBES`` moves do not meet it."""
    base = np.floor(mine)
    steps = np.stack([np.zeros_like(mine), (mine - base) ** 2, (1 - mine + base) ** 2], axis=2)
    every = np.zeros((len(mine), 1))
    for j in range(mine.shape[1]):
        every = (every[:, :, None] + steps[:, None, j]).reshape(len(mine), -1)
        if every.shape[1] > PROBES:  # a sum beyond the first PROBES stays beyond them
            every = np.partition(every, PROBES - 1, axis=1)[:, :PROBES]
    every.sort(axis=1)
    move = np.floor(theirs) - base[owner]
    own = steps[owner]
    cost = np.zeros(len(theirs))
    for j in range(mine.shape[1]):  # in the same order, so that equal moves give equal sums
        cost += np.where(move[:, j] == 0, 0, np.where(move[:, j] < 0, own[:, j, 1], own[:, j, 2]))
    cost[(np.abs(move) > 1).any(axis=1)] = np.inf
    cuts = np.searchsorted(owner, np.arange(len(mine) + 1))
    place = [np.searchsorted(every[q], cost[a:b]) for q, (a, b) in enumerate(zip(cuts, cuts[1:]))]
    return np.where(np.isinf(cost), PROBES, np.minimum(np.concatenate(place), PROBES))


def tuned(queries: np.ndarray, near: list[np.ndarray], others: np.ndarray, dims: int, scale: float, rows: int) -> Hashing:
    """The setting that finds TARGET of the sample queries' true neighbours (``near``) among ``rows``
    rows with the least work, estimated on the sample rows ``others``."""
    owner = np.repeat(np.arange(len(near)), [len(x) for x in near])
    every = np.repeat(np.arange(len(near)), len(others))
    best, found = np.inf, Hashing(dims, scale, 0)
    for width in WIDTHS:
        for k in range(1, MOST_K + 1):
            h = Hashing(dims, scale, k, PROBES, max(TABLES), width)
            mine, theirs, rest = h.cells(queries, True), h.cells(np.concatenate(near), False), h.cells(others, False)
            wanted = np.stack([ranks(m, x, owner) for m, x in zip(mine, theirs)])
            if np.mean(wanted.min(axis=0) < PROBES) < TARGET:
                continue
            met = np.stack([ranks(m, np.tile(x, (len(near), 1)), every) for m, x in zip(mine, rest)])
            for tables in TABLES:
                first = np.sort(wanted[:tables].min(axis=0))
                probes = int(first[min(len(first) - 1, ceil(TARGET * len(first)))]) + 1
                work = (met[:tables] < probes).sum(axis=0).mean() * rows + PROBE_COST * probes * tables
                if probes <= PROBES and work < best:
                    best, found = work, Hashing(dims, scale, k, probes, tables, width)
    return found


def best_of(query: np.ndarray, row: np.ndarray, score: np.ndarray, n: int) -> np.ndarray:
    """The places of each query's ``n`` best, ties to smaller rows."""
    order = np.lexsort((row, -score, query))
    q = query[order]
    start = np.maximum.accumulate(np.where(np.concatenate([[True], q[1:] != q[:-1]]), np.arange(len(q)), 0))
    return order[np.arange(len(q)) - start < n]


class Part:
    """The indexed rows of one part, by bucket."""

    def __init__(self, ids: np.ndarray, keys: np.ndarray, vectors: np.ndarray):
        order = np.argsort(keys, kind="stable")
        self.ids, self.vectors = ids[order], vectors[order]
        self.keys, self.starts = np.unique(keys[order], return_index=True)
        self.ends = np.append(self.starts[1:], len(keys))

    def search(self, vectors: np.ndarray, visits: list[np.ndarray], n: int):
        """(query number, row id, score) of each query's ``n`` best in the buckets it visits."""
        query = np.repeat(np.arange(len(visits)), [len(v) for v in visits])
        key = np.concatenate(visits)
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        met = self.keys[at] == key
        query, at = query[met], at[met]
        order = np.argsort(at, kind="stable")
        buckets, starts = np.unique(at[order], return_index=True)
        worst = np.full(len(visits), -np.inf)
        slack = 1e-12 * np.linalg.norm(vectors, axis=1) * np.linalg.norm(self.vectors, axis=1).max()  # of the product's last bits
        held, pending = [], 0

        def settle():
            nonlocal held, pending
            q, r, s = (np.concatenate(c) for c in zip(*held))
            keep = best_of(q, self.ids[r], s, n)
            q, r, s = q[keep], r[keep], s[keep]
            held, pending = [(q, r, s)], 0
            counts = np.bincount(q, minlength=len(worst))
            least = np.full(len(worst), np.inf)
            np.minimum.at(least, q, s)
            worst[counts >= n] = least[counts >= n]

        for b, qs in zip(buckets, np.split(query[order], starts[1:])):
            for x in range(self.starts[b], self.ends[b], 4096):
                rows = slice(x, min(x + 4096, self.ends[b]))
                score = vectors[qs] @ self.vectors[rows].T
                cut = worst[qs]
                if score.shape[1] > n:  # a block's own n best bound what it can add
                    cut = np.maximum(cut, np.partition(score, -n, axis=1)[:, -n])
                i, j = np.nonzero(score >= (cut - slack[qs])[:, None])
                for y in range(0, len(i), 32_768):
                    q, r = qs[i[y:y + 32_768]], j[y:y + 32_768] + x
                    # the product's last bits depend on its shape; those of this sum do not
                    held.append((q, r, (vectors[q] * self.vectors[r]).sum(axis=1)))
                    pending += len(q)
                    if pending > 100_000:
                        settle()
        if not held:
            return query[:0], self.ids[:0], np.zeros(0)
        settle()
        q, r, s = held[0]
        return q, self.ids[r], s


def nearest(vectors: DataFrame, is_query: Column, n: int = 20) -> DataFrame:
    """The ``n`` rows of ``vectors`` (vec_id, embedding) with the largest inner product for
    each row that ``is_query`` marks, itself left out: query_id, rank, vec_id, score."""
    spark = vectors.sparkSession
    single = vectors.schema["embedding"].dataType.elementType == FloatType()
    kind, packing = ("array<float>", np.float32) if single else ("array<double>", np.float64)
    rows = (vectors.withColumn("_query", F.coalesce(is_query, F.lit(False))).where(F.col("vec_id").isNotNull() & usable(F.col("embedding")))
            .select(F.col("vec_id").cast("long").alias("vec_id"), "_query", F.col("embedding").cast(kind).alias("embedding"))
            .distinct())
    rows = checkpointed(rows)
    equal = Window.partitionBy("embedding").orderBy("vec_id")
    members = checkpointed(rows.select("vec_id", "embedding").withColumn("place", F.row_number().over(equal))
                           .where(F.col("place") <= n + 1)
                           .withColumn("rep", F.first("vec_id").over(equal)))
    index = members.where("place = 1").select("rep", "embedding")
    queries = rows.where("_query").select(F.col("vec_id").alias("query_id"), "embedding")
    size, scale, dims = index.agg(F.count("*"), F.sqrt(F.max(norm2(F.col("embedding")))),
                                  F.max(F.size("embedding"))).first()
    shape = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    if not size:
        return shape
    hashing = fit(index, queries, n, dims, scale, size)
    shared = spark.sparkContext.broadcast(hashing)
    groups = max(PARTS, ceil(size / PART_ROWS))  # large parts, as queries go to each that they visit

    def indexed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        h = shared.value
        for frame in batches:
            x = np.stack(frame["embedding"])
            packed = [v.astype(packing).tobytes() for v in x]
            for t, cells in enumerate(h.cells(x, False)):
                key = h.keys(t, np.floor(cells))
                yield pd.DataFrame({"t": t, "g": key % groups, "id": frame["rep"], "vector": packed,
                                    "keys": list(key[:, None])})

    def probing(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        h = shared.value
        for frame in batches:
            x = np.stack(frame["embedding"])
            for t, cells in enumerate(h.cells(x, True)):
                out = []
                for query, vector, own in zip(frame["query_id"], x, cells):
                    keys = h.probed(t, own)
                    for g in np.unique(keys % groups):
                        out.append((t, g, query, vector.astype(packing).tobytes(), keys[keys % groups == g]))
                yield pd.DataFrame(out, columns=["t", "g", "id", "vector", "keys"])

    schema = "t int, g long, id long, vector binary, keys array<long>"
    stored, asked = index.mapInPandas(indexed, schema), queries.mapInPandas(probing, schema)
    # one row a part: tables * (size / PART_ROWS), 16 bytes each
    parts = stored.groupBy("t", "g").count().select("t", "g", F.ceil(F.col("count") / (2 * PART_ROWS)).alias("salts"))
    parts = F.broadcast(parts) if hashing.tables * groups <= 1_000_000 else parts
    dealt = (stored.join(parts, ["t", "g"]).select("t", "g", F.pmod(F.xxhash64("id"), "salts").alias("s"), F.lit(0).alias("q"), "id", "vector", "keys")
             .union(asked.join(parts, ["t", "g"]).select("t", "g", F.explode(F.sequence(F.lit(0).cast("long"), F.col("salts") - 1)).alias("s"),
                                                         F.lit(1).alias("q"), "id", "vector", "keys"))
             .repartition(2 * hashing.tables * groups, "t", "g", "s").sortWithinPartitions("t", "g", "s", "q"))

    def searched(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, held, part = None, [], None
        for frame in batches:
            for own, rows_ in frame.groupby(["t", "g", "s", "q"], sort=True):
                if own[:3] != now:
                    now, held, part = own[:3], [], None
                if own[3] == 0:
                    held.append(rows_[["id", "vector", "keys"]])
                    continue
                if part is None and held:
                    own_rows = pd.concat(held)
                    held = []
                    part = Part(own_rows["id"].to_numpy(), np.concatenate(own_rows["keys"].tolist()),
                                unpacked(own_rows["vector"], packing))
                if part is None:
                    continue
                for at in range(0, len(rows_), CHUNK):
                    some = rows_.iloc[at:at + CHUNK]
                    q, rep, score = part.search(unpacked(some["vector"], packing), some["keys"].tolist(), n + 1)
                    yield pd.DataFrame({"query_id": some["id"].to_numpy()[q], "rep": rep, "score": score})

    found = dealt.mapInPandas(searched, "query_id long, rep long, score double")
    classes = Window.partitionBy("query_id").orderBy(F.desc("score"), "rep")
    merged = (found.groupBy("query_id", "rep").agg(F.max("score").alias("score"))
              .withColumn("rank", F.row_number().over(classes)).where(F.col("rank") <= n + 1).drop("rank"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (merged.join(members.select("rep", "vec_id"), "rep").where("vec_id != query_id")
            .withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n)
            .select("query_id", "rank", "vec_id", "score"))


def unpacked(vectors: pd.Series, packing: type) -> np.ndarray:
    return np.frombuffer(b"".join(vectors), dtype=packing).reshape(len(vectors), -1).astype(np.float64)


def exact(index: DataFrame, ids: np.ndarray, queries: np.ndarray, n: int) -> pd.DataFrame:
    """The true ``n`` best rows of a few queries: query (its number), rep, score, embedding.
    One pass over ``index``; every task returns at most n rows a query."""
    shared = index.sparkSession.sparkContext.broadcast((ids, queries))

    def best(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ids, queries = shared.value
        held = None
        for frame in batches:
            x, rep = np.stack(frame["embedding"]).astype(np.float64), frame["rep"].to_numpy()
            score = queries @ x.T
            score[ids[:, None] == rep[None, :]] = -np.inf
            q = np.repeat(np.arange(len(queries)), min(n, len(x)))
            r = np.argpartition(-score, min(n, len(x)) - 1, axis=1)[:, :n].ravel()
            found = q, rep[r], score[q, r], x[r]
            held = found if held is None else tuple(map(np.concatenate, zip(held, found)))
            keep = best_of(*held[:3], n)
            held = tuple(h[keep] for h in held)
        if held is not None:
            q, rep, score, x = (h[held[2] > -np.inf] for h in held)
            yield pd.DataFrame({"query": q, "rep": rep, "score": score, "embedding": list(x)})

    order = Window.partitionBy("query").orderBy(F.desc("score"), "rep")
    return (index.mapInPandas(best, "query int, rep long, score double, embedding array<double>")
            .withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n).toPandas())


def fit(index: DataFrame, queries: DataFrame, n: int, dims: int, scale: float, size: int) -> Hashing:
    if size <= n + 1:  # every candidate is asked for: no projection, one bucket
        return Hashing(dims, scale, 0)
    sample = queries.orderBy(F.xxhash64("query_id"), "query_id").limit(TUNING).toPandas()
    if not len(sample):
        return Hashing(dims, scale, 1)
    x = np.stack(sample["embedding"]).astype(np.float64)
    others = index.orderBy(F.xxhash64("rep"), "rep").limit(OTHERS).toPandas()
    true = exact(index, sample["query_id"].to_numpy(), x, n)
    near = {q: np.stack(own["embedding"]) for q, own in true.groupby("query")}
    known = sorted(near)
    return tuned(x[known], [near[q] for q in known], np.stack(others["embedding"]).astype(np.float64), dims, scale, size)
