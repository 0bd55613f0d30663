"""Centroid clustering over a VA-file: exact integer k-means whose assignments are mostly
made on few-bit approximations.

A vector's components become integers, and each integer the number of its cell among
2^``bits`` cells of its dimension, cut by the dimension's quantiles.  The VA-file holds the
packed cells beside the vectors.  For each round, tables give for every (dimension, cell,
centroid) the least and the largest squared difference; their sums over the dimensions are
an interval that holds the distance of the vector to that centroid.  A centroid whose
interval begins above the least upper end cannot be the nearest.  Where one is left, the
vector is assigned on its cells alone; where intervals overlap, the full vector is fetched
and the exact distances to the centroids left decide, ties to the smaller number.  Results
are exact whatever the cells.

On Spark: the VA-file is one Parquet table in the shared folder, a vector beside its cells,
so that a fetch is a read of the same row and needs no join or shuffle; the vector goes to
the Python worker only where it is asked for.  Sums of a round are partial aggregates; no
more than a row per cluster is shuffled by a task or reaches the driver.  Bounds: k and the
dimensions are parameters; cell limits and tables hold dims x 2^bits x k numbers.

Edge cases: vectors that are null, of another length or hold null or non-finite components
take no part.  Integers are kept within +-2^27 (components of +-2,097,152 at scale 64), as
squared distances beyond do not fit a long; sums that do not fit are cut to the largest
long.  Rows without id are clustered but never seed.  Repeated rows count each time and may
seed twice; of one id's rows the smaller vector seeds first.  Fewer vectors than k give as
many centroids.  Empty tables give no rows.  Extra columns play no part.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tidewater.llm.common import checkpointed
from tidewater.session import run_dir

BITS, QUANTILES, LIMIT = 6, 128, 1 << 27
CHUNK = 4_096
LONG_MAX = (1 << 63) - 1


def integer_vectors(vectors: DataFrame, vec_id: Column, vector: Column, dims: int, scale: int) -> DataFrame:
    """(vec_id, v): the vectors that take part, as floor(scale * component)."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    whole = lambda x: F.floor(F.greatest(F.least(x.cast("double") * scale, F.lit(float(LIMIT))), F.lit(-float(LIMIT))))
    rows = vectors.select(vec_id.alias("vec_id"), vector.alias("x"))
    kept = rows.where((F.size("x") == dims) & F.forall("x", finite))
    return kept.select("vec_id", F.transform("x", lambda x: whole(x).cast("int")).alias("v"))


@dataclass
class Cells:
    """``low`` and ``high``: least and largest integer of each cell, (dims, cells)."""
    low: np.ndarray
    high: np.ndarray
    bits: int

    def pack(self, v: np.ndarray) -> np.ndarray:
        """The cells of vectors (n, dims), ``bits`` bits each, as rows of bytes."""
        numbers = np.empty(v.shape, dtype=np.uint8)
        for d in range(v.shape[1]):
            numbers[:, d] = np.searchsorted(self.low[d], v[:, d], side="right") - 1
        shifts = np.arange(self.bits - 1, -1, -1, dtype=np.uint8)
        return np.packbits((numbers[:, :, None] >> shifts & 1).reshape(len(v), -1), axis=1)

    def unpack(self, packed: np.ndarray) -> np.ndarray:
        dims = len(self.low)
        bits = np.unpackbits(packed, axis=1, count=dims * self.bits).reshape(len(packed), dims, self.bits)
        return bits @ (1 << np.arange(self.bits - 1, -1, -1)).astype(np.uint8)


def cell_starts(quantiles: np.ndarray, n: int) -> list[int]:
    """The least integers of at most ``n`` cells.  Their density follows the square root of
    the values' density times their distance from the median, which makes the expected
    width of a distance interval least (a cell of width w adds some 2 w |x - c| to it)."""
    left, right = quantiles[:-1].astype(float), quantiles[1:].astype(float)
    width, middle = right - left, np.abs((left + right) / 2 - np.median(quantiles))
    share = np.concatenate([[0], np.cumsum(np.sqrt(width * np.maximum(middle, 1)))])  # density is 1 / width
    cuts = np.interp(np.arange(1, n) * share[-1] / n, share, quantiles) if share[-1] else []
    return sorted({int(quantiles[0]), *[int(np.ceil(c)) for c in cuts]})


def fit_cells(ints: DataFrame, dims: int, bits: int) -> Cells | None:
    """Cells from the quantiles of each dimension over all vectors; None if there are none."""
    n, shares = 1 << bits, [i / QUANTILES for i in range(QUANTILES + 1)]
    at = [F.get("v", F.lit(d)) for d in range(dims)]
    row = ints.agg(F.array(*[F.min(c) for c in at]).alias("low"), F.array(*[F.max(c) for c in at]).alias("high"),
                   F.array(*[F.percentile_approx(c, shares, 1_000) for c in at]).alias("quantiles")).first()
    if row["low"][0] is None:
        return None
    low, high = np.empty((dims, n), dtype=np.int64), np.empty((dims, n), dtype=np.int64)
    for d, (least, most, quantiles) in enumerate(zip(row["low"], row["high"], row["quantiles"])):
        starts = cell_starts(np.array([least, *quantiles[1:-1], most]), n)
        ends = [s - 1 for s in starts[1:]] + [most]
        free = n - len(starts)  # cells that no integer of the table falls into
        low[d], high[d] = starts + [LIMIT + 1] * free, ends + [LIMIT + 1] * free
    return Cells(low, high, bits)


def write_va_file(ints: DataFrame, cells: Cells) -> DataFrame:
    """vec_id, v and the packed cells, written once and read back."""
    dims = len(cells.low)

    @F.arrow_udf("binary")
    def packed(v: pa.Array) -> pa.Array:
        rows = cells.pack(v.flatten().to_numpy(zero_copy_only=False).reshape(-1, dims))
        return pa.array([r.tobytes() for r in rows], pa.binary())

    spark, path = ints.sparkSession, run_dir(ints.sparkSession, "va_file")
    ints.withColumn("cells", packed("v")).write.parquet(path)
    return spark.read.parquet(path)


def interval_tables(cells: Cells, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and largest squared difference, each (dims, cells, k)."""
    c = centroids.T[:, None, :]
    low, high = c - cells.low[:, :, None], c - cells.high[:, :, None]
    outside = np.where(low < 0, low, np.where(high > 0, high, 0))
    return outside**2, np.maximum(low**2, high**2)


def candidates(cells: Cells, tables, packed: np.ndarray) -> np.ndarray:
    """(n, k): whether the centroid may be the nearest by the intervals."""
    numbers = cells.unpack(packed)
    least, most = (np.zeros((len(packed), tables[0].shape[2]), dtype=np.int64) for _ in range(2))
    for d in range(numbers.shape[1]):
        least += tables[0][d, numbers[:, d]]
        most += tables[1][d, numbers[:, d]]
    return least <= most.min(axis=1, keepdims=True)


def nearest(v: np.ndarray, centroids: np.ndarray, left: np.ndarray) -> np.ndarray:
    """Of the centroids left (n, k) the nearest, ties to the smaller number."""
    row, k = np.nonzero(left)
    distance = np.full(left.shape, LONG_MAX, dtype=np.int64)
    for at in range(0, len(row), CHUNK):
        r, c = row[at:at + CHUNK], k[at:at + CHUNK]
        distance[r, c] = ((v[r].astype(np.int64) - centroids[c]) ** 2).sum(axis=1)
    return distance.argmin(axis=1)


def assigned(va: DataFrame, cells: Cells, centroids: np.ndarray) -> DataFrame:
    """``va`` with ``cluster`` and ``fetched`` (whether the full vector was asked for)."""
    tables, (k, dims) = interval_tables(cells, centroids), centroids.shape
    width = (k + 7) // 8

    def bytes_matrix(a: pa.Array) -> np.ndarray:
        return np.frombuffer(b"".join(a.to_pylist()), dtype=np.uint8).reshape(len(a), -1)

    @F.arrow_udf("struct<cluster:int,left:binary>")
    def on_cells(packed: pa.Array) -> pa.Array:
        clusters, masks = [], []
        for at in range(0, len(packed), CHUNK):
            left = candidates(cells, tables, bytes_matrix(packed.slice(at, CHUNK)))
            clear = left.sum(axis=1) == 1
            clusters.append(np.where(clear, left.argmax(axis=1), -1))
            masks += [None if c else m.tobytes() for c, m in zip(clear, np.packbits(left, axis=1))]
        number = np.concatenate(clusters) if clusters else np.empty(0, dtype=np.int64)
        return pa.StructArray.from_arrays([pa.array(number, pa.int32()), pa.array(masks, pa.binary())], ["cluster", "left"])

    @F.arrow_udf("int")
    def on_vectors(left: pa.Array, v: pa.Array) -> pa.Array:
        asked = np.flatnonzero(left.is_valid().to_numpy(zero_copy_only=False))
        out = np.full(len(left), -1, dtype=np.int32)
        if len(asked):
            mask = np.unpackbits(bytes_matrix(left.drop_null()), axis=1, count=k).astype(bool)
            full = v.drop_null().flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)
            out[asked] = nearest(full, centroids, mask)
        return pa.array(out, pa.int32())

    x = va.withColumn("found", on_cells("cells"))
    overlap = F.col("found.left").isNotNull()
    x = x.withColumn("exact", on_vectors(F.col("found.left"), F.when(overlap, F.col("v"))))
    return x.withColumns({"cluster": F.when(overlap, F.col("exact")).otherwise(F.col("found.cluster")),
                          "fetched": overlap}).drop("found", "exact")


def seeds(ints: DataFrame, k: int, seed: int) -> np.ndarray:
    """The vectors of the k least sha256 digests of ``<seed>:<vec_id>``."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    rows = ints.where(F.col("vec_id").isNotNull()).select(digest.alias("digest"), "v").orderBy("digest", "v").limit(k).collect()
    return np.array([r["v"] for r in rows], dtype=np.int64)


def moved(rows: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """Each centroid at the floor of its vectors' exact mean; empty ones stay."""
    k, dims = centroids.shape
    sums = rows.groupBy("cluster").agg(F.count(F.lit(1)).alias("n"), F.array(*[
        F.sum(F.get("v", F.lit(d))) for d in range(dims)]).alias("total")).collect()  # at most k rows
    out = centroids.copy()
    for r in sums:
        out[r["cluster"]] = [t // r["n"] for t in r["total"]]
    return out


def cluster(vectors: DataFrame, vec_id: Column, vector: Column, k: int = 16, rounds: int = 3, dims: int = 64,
            scale: int = 64, seed: int = 1, bits: int = BITS) -> DataFrame:
    """vec_id, cluster, distance (squared, to the final centroid), centroid_sha256,
    cluster_inertia and inertia of every vector that takes part."""
    spark = vectors.sparkSession
    ints = integer_vectors(vectors, vec_id, vector, dims, scale)
    centroids, cells = seeds(ints, k, seed), fit_cells(ints, dims, bits)
    table = "cluster int, centroid array<long>, centroid_sha256 string"
    if cells is None or not len(centroids):
        return spark.createDataFrame([], f"vec_id {ints.schema['vec_id'].dataType.simpleString()}, cluster int, distance long, "
                                         "centroid_sha256 string, cluster_inertia long, inertia long")
    va = write_va_file(ints, cells)
    for _ in range(rounds):
        centroids = moved(assigned(va, cells, centroids), centroids)
    final = spark.createDataFrame([(i, c.tolist(), hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest())
                                   for i, c in enumerate(centroids)], table)
    rows = assigned(va, cells, centroids).join(F.broadcast(final), "cluster")
    square = F.aggregate(F.zip_with("v", "centroid", lambda a, b: (a - b) * (a - b)), F.lit(0).cast("long"), lambda s, x: s + x)
    rows = checkpointed(rows.select("vec_id", "cluster", square.alias("distance"), "centroid_sha256"))
    fits = lambda c: F.least(c, F.lit(LONG_MAX).cast("decimal(38,0)")).cast("long")
    sums = rows.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(28,0)")).cast("decimal(38,0)").alias("d"))
    whole = sums.agg(F.sum("d").cast("decimal(38,0)").alias("all"))
    sums = sums.select("cluster", fits(F.col("d")).alias("cluster_inertia"), fits(whole.scalar()).alias("inertia"))
    return rows.join(F.broadcast(sums), "cluster").select(
        "vec_id", "cluster", "distance", "centroid_sha256", "cluster_inertia", "inertia")
