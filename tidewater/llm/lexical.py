"""Ranked lexical search by bag deduplication.

Terms are runs of letters, digits and non-ASCII characters, A-Z lower-cased.  Every document
is reduced to its bag: the terms that occur in some item, with their frequencies, and the
number m its length gives.  Documents of one bag and one m score alike for every item, so
they form a class: classes are found by a hash of bag and m and verified by comparing both.
A class is scored once, against all items at a time, and then expanded to its members by
ascending id; of a class no more members are carried than a result holds.

score = sum over the item's terms, repeats included, of
w * ((10^9 * tf) div (1000 * tf + 8 * m)), with w = floor(1000 * ln((2 N + 2) / (2 df + 1)))
and m = 25 + (75 * n * N) div L; N: documents with a term, L: their terms, n: the
document's terms, df: documents holding the term.  All counts are over all documents and
whole texts; document frequencies are needed for the items' terms only.

On Spark: one map pass makes the bags, which are written once (Parquet, shared folder).
Statistics are partial aggregates.  Classes come from one shuffle of the bags, limited to
the least ids of a class before it; classes in crowded ranges of the hash (counted exactly)
are limited by salted groups first, so that no class fills a task.  A task keeps the best
of each item and returns no more than a result's rows of it.  Bound: the items' texts are
broadcast as a vocabulary; they are taken in blocks of at most ``BLOCK_BYTES`` (and at least
one item), each searched against all documents, so any number of items is exact.

Edge cases: a null or term-free text has no terms: it is not counted in N and never
returned.  A null or term-free item, or one without a match, returns no rows.  Items are
rows: repeated ids are ranked one by one, a null id as well.  Documents are rows, too:
repeated rows tie and take ranks of their own; rows without id come after those with one.
Empty tables give no rows.  Extra columns play no part.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import reduce
from math import floor, log

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from tidewater.llm.decontam import fold_bytes
from tidewater.session import run_dir

BLOCK_BYTES = 2 << 20
SLICE = 1 << 20
RANGES, CROWDED, SALTS = 1 << 16, 1_000, 64
CELLS = 1 << 21  # scores or postings held at a time
EXACT = 1 << 53


def term_counts(text: str | None) -> Counter:
    """Each term (as UTF-8) and its occurrences; long texts are counted in slices."""
    folded, counts, at = fold_bytes(text or ""), Counter(), 0
    while at < len(folded):
        end = folded.find(b" ", at + SLICE)
        end = len(folded) if end < 0 else end
        counts.update(folded[at:end].split())
        at = end
    return counts


def item_blocks(items: DataFrame, item_id: Column, text: Column, block_bytes: int) -> Iterator[list[tuple]]:
    """Blocks of (item_id, term counts), each of a size that a worker can hold."""
    rows = items.select(item_id.alias("item_id"), text.alias("text"))
    size = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    blocks = -(-size // block_bytes)
    block = F.pmod(F.xxhash64("item_id", "text"), F.lit(max(blocks, 1)))
    for b in range(blocks):
        found = [(r["item_id"], term_counts(r["text"])) for r in rows.where(block == b).toLocalIterator()]
        yield [(i, c) for i, c in found if c]


def bags(docs: DataFrame, doc_id: Column, text: Column, vocabulary: dict[bytes, int]) -> DataFrame:
    """doc_id, n (all terms), terms (numbers, ascending) and their frequencies, of documents
    with a term; written once."""
    spark, path = docs.sparkSession, run_dir(docs.sparkSession, "term_bags")
    shared = spark.sparkContext.broadcast(vocabulary)

    @F.arrow_udf("struct<n:long,terms:array<int>,tfs:array<int>>")
    def bag(texts: pa.Array) -> pa.Array:
        known, n, ends, terms, tfs = shared.value, [], [0], [], []
        for t in texts:
            counts = term_counts(t.as_py())
            held = sorted((known[w], k) for w, k in counts.items() if w in known)
            n.append(counts.total())
            terms += [w for w, _ in held]
            tfs += [k for _, k in held]
            ends.append(len(terms))
        lists = [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(x, pa.int32())) for x in (terms, tfs)]
        return pa.StructArray.from_arrays([pa.array(n, pa.int64()), *lists], ["n", "terms", "tfs"])

    # filtered after the write: a filter before it would make the bags twice
    docs.select(doc_id.alias("doc_id"), bag(text).alias("b")).select("doc_id", "b.*").write.parquet(path)
    return spark.read.parquet(path).where(F.col("n") > 0)


def least_members(rows: DataFrame, k: int, *salt: str) -> DataFrame:
    """The ``k`` rows of least id in each class (and salt); limited before the shuffle, too."""
    same = Window.partitionBy("h", "m", "terms", "tfs", *salt).orderBy(F.col("doc_id").asc_nulls_last())
    return rows.withColumn("place", F.row_number().over(same)).where(F.col("place") <= k).drop("place")


def classes(bagged: DataFrame, docs_with_terms: int, all_terms: int, k: int, crowded: int = CROWDED) -> DataFrame:
    """m, terms, tfs and the ``k`` least ids (ascending) of each class that shares a term
    with the items."""
    # decimals: the product of a length and a count of documents may pass 64 bits
    m = F.expr(f"25 + cast(75 as decimal(38,0)) * n * {docs_with_terms} div {all_terms}").cast("long")
    rows = bagged.where(F.size("terms") > 0).withColumn("m", m).drop("n")
    rows = rows.withColumn("h", F.xxhash64("m", "terms", "tfs"))
    at = F.shiftrightunsigned("h", 48)
    counts = rows.groupBy(at.alias("range")).count().collect()  # at most RANGES rows
    bar = sum(r["count"] for r in counts) // RANGES + crowded
    full = [r["range"] for r in counts if r["count"] > bar]
    if full:
        ranges = F.broadcast(rows.sparkSession.createDataFrame([(r,) for r in full], "range long"))
        salted = rows.join(ranges, at == F.col("range"), "left_semi").withColumn(
            "salt", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)))
        rows = rows.join(ranges, at == F.col("range"), "left_anti").unionByName(least_members(salted, k, "salt").drop("salt"))
    return (least_members(rows, k).groupBy("h", "m", "terms", "tfs").agg(F.collect_list("doc_id").alias("ids"),
                                                                       F.count_if(F.col("doc_id").isNull()).alias("nulls"))
            .select("m", "terms", "tfs", F.concat(F.array_sort("ids"), F.array_repeat(
                F.lit(None).cast(rows.schema["doc_id"].dataType), F.col("nulls").cast("int"))).alias("members")))


class Scorer:
    """The items' weighted terms as postings: of term t, items ``item[start[t]:start[t + 1]]``."""

    def __init__(self, items: list[Counter], vocabulary: dict[bytes, int], weight: np.ndarray):
        found = sorted((vocabulary[w], i, k) for i, c in enumerate(items) for w, k in c.items())
        term, item, times = np.array(found, dtype=np.int64).T
        self.n_items, self.item = len(items), item
        self.worth = times * weight[term]
        self.start = np.searchsorted(term, np.arange(len(weight) + 1))
        most = int(np.bincount(item, weights=self.worth.astype(float), minlength=len(items)).max())
        self.floats_exact = most * 10**6 < EXACT

    def scores(self, m: np.ndarray, ends: np.ndarray, terms: np.ndarray, tfs: np.ndarray) -> np.ndarray:
        """(classes, items); ``ends``: where each class's terms end."""
        owner = np.repeat(np.arange(len(m)), np.diff(ends, prepend=0))
        gain = (1_000_000_000 * tfs) // (1000 * tfs + 8 * m[owner])
        n = self.start[terms + 1] - self.start[terms]
        posting = np.arange(n.sum()) + np.repeat(self.start[terms] - np.concatenate([[0], np.cumsum(n)[:-1]]), n)
        cell = np.repeat(owner, n) * self.n_items + self.item[posting]
        points = np.repeat(gain, n) * self.worth[posting]
        if self.floats_exact:
            total = np.bincount(cell, weights=points, minlength=len(m) * self.n_items).astype(np.int64)
        else:
            total = np.zeros(len(m) * self.n_items, dtype=np.int64)
            np.add.at(total, cell, points)
        return total.reshape(len(m), self.n_items)

    def batches(self, m, ends, terms, tfs) -> Iterator[tuple[int, np.ndarray]]:
        """(first class, scores), a bounded number of scores and postings at a time."""
        n = np.concatenate([[0], np.cumsum(self.start[terms + 1] - self.start[terms])])
        starts, at = np.concatenate([[0], ends[:-1]]), 0
        while at < len(m):
            upto = min(at + max(1, CELLS // self.n_items), max(at + 1, int(np.searchsorted(n[ends], n[starts[at]] + CELLS))))
            part = slice(starts[at], ends[upto - 1])
            yield at, self.scores(m[at:upto], ends[at:upto] - starts[at], terms[part], tfs[part])
            at = upto


class Best:
    """The ``k`` best (score, ascending id) of each item among the classes seen."""

    def __init__(self, n_items: int, k: int):
        self.k, self.found, self.bar = k, [[] for _ in range(n_items)], np.ones(n_items, dtype=np.int64)

    @staticmethod
    def order(row):
        return -row[0], row[1] is None, row[1] if row[1] is not None else 0

    def add(self, scores: np.ndarray, members: list[list]) -> None:
        first = [self.order((0, ids[0])) for ids in members]
        place = np.empty(len(first), dtype=np.int64)
        place[sorted(range(len(first)), key=first.__getitem__)] = np.arange(len(first))
        items = np.flatnonzero((scores >= self.bar).any(axis=0))
        for i in items:
            rows = np.flatnonzero(scores[:, i] >= self.bar[i])
            rows = rows[np.lexsort((place[rows], -scores[rows, i]))][:self.k]  # of tied classes those of least ids
            new = [(int(scores[r, i]), d) for r in rows for d in members[r]]
            self.found[i] = sorted(self.found[i] + new, key=self.order)[:self.k]
            if len(self.found[i]) == self.k:
                self.bar[i] = self.found[i][-1][0]


def search_block(docs: DataFrame, doc_id: Column, text: Column, items: list[tuple], k: int, crowded: int) -> DataFrame | None:
    """item (its number in the block), doc_id, score: the results of some items."""
    vocabulary = {w: t for t, w in enumerate(sorted(set().union(*[c for _, c in items])))}
    bagged = bags(docs, doc_id, text, vocabulary)
    held, length = bagged.agg(F.count(F.lit(1)), F.sum("n")).first()
    if not held:
        return None
    df = dict(bagged.select(F.explode("terms").alias("t")).groupBy("t").count().collect())  # a number for each item term
    weight = np.array([floor(1000 * log((2 * held + 2) / (2 * df.get(t, 0) + 1))) for t in range(len(vocabulary))], dtype=np.int64)
    shared = docs.sparkSession.sparkContext.broadcast(Scorer([c for _, c in items], vocabulary, weight))
    found = classes(bagged, held, length, k, crowded)
    id_type = found.schema["members"].dataType.elementType

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer, top, kind = shared.value, Best(shared.value.n_items, k), None
        for b in batches:
            lists = [b.column(c) for c in ("terms", "tfs")]
            ends = np.cumsum(lists[0].value_lengths().to_numpy())
            m, (terms, tfs) = b.column("m").to_numpy(), [x.flatten().to_numpy().astype(np.int64) for x in lists]
            kind, members = b.column("members").type.value_type, b.column("members").to_pylist()
            for at, scores in scorer.batches(m, ends, terms, tfs):
                top.add(scores, members[at:at + len(scores)])
        rows = [(i, d, s) for i, f in enumerate(top.found) for s, d in f]
        if rows:
            i, d, s = zip(*rows)
            yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(d, kind), pa.array(s, pa.int64())],
                                             names=["item", "doc_id", "score"])

    return found.mapInArrow(best, f"item int, doc_id {id_type.simpleString()}, score long")


def search(docs: DataFrame, doc_id: Column, text: Column, items: DataFrame, item_id: Column, item_text: Column,
           k: int = 10, block_bytes: int = BLOCK_BYTES, crowded: int = CROWDED) -> DataFrame:
    """item_id, rank, doc_id, score: each item's ``k`` best documents with a score above 0,
    equal scores by ascending id."""
    spark = docs.sparkSession
    id_types = [df.select(c.alias("c")).schema["c"].dataType.simpleString() for df, c in ((items, item_id), (docs, doc_id))]
    results = []
    for block in item_blocks(items, item_id, item_text, block_bytes):
        found = search_block(docs, doc_id, text, block, k, crowded) if block else None
        if found is not None:
            results.append(ranked(spark, found, [i for i, _ in block], id_types[0], k))
    if not results:
        return spark.createDataFrame([], f"item_id {id_types[0]}, rank int, doc_id {id_types[1]}, score long")
    return reduce(DataFrame.unionByName, results)


def ranked(spark: SparkSession, found: DataFrame, ids: list, id_type: str, k: int) -> DataFrame:
    best_first = Window.partitionBy("item").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    names = spark.createDataFrame(list(enumerate(ids)), f"item int, item_id {id_type}")
    rows = found.withColumn("rank", F.row_number().over(best_first)).where(F.col("rank") <= k)
    return rows.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score")  # names: a block's items
