"""Language-model scoring by deleted interpolation.

Tokens: words (runs of bytes other than ASCII white space, A-Z lower-cased) and one end.
P(w | v) = a * c(v w) / c(v) + b * c(w) / N + (1 - a - b) / (V + 1), where (a, b) depend on
the bucket of log2 c(v).  The weights are learned by expectation-maximisation on held-out
counts: a seventh of the learning documents is held out, the others are counted, and every
held-out token enters, by bucket, with its two maximum-likelihood estimates rounded to an
eighth of an octave.  Scoring then uses the counts of all learning documents.

On Spark: each task gathers its documents in blocks of about ``BLOCK_BYTES`` of text, which
are written, compressed, to the shared checkpoint folder.  A block sends each shard of the
key space its sorted distinct n-gram keys (hashes) with its own counts, packed in one
binary value; shards add up the counts of all blocks and send each block the totals in the
order it asked, so frequent n-grams cross the shuffle once a block.  The totals are
checkpointed too; learning and scoring join them to the blocks.  Nothing of the corpus but
the weights' histogram, of fixed size, is collected.  The number of shards follows the size
of the input.

Edge cases: null counts as the empty text: one token, the end.  Null ids hash like others.
Very long texts and words are read whole, in slices.  Repeated rows are scored, and
counted, each.  Result columns whose names the caller's columns have get free names.
Without learning documents N and V are zero and every token has the probability 1.  Empty
tables give no rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from math import ceil

import numpy as np
import pandas as pd
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from tidewater.llm.common import checkpointed, free_name

BLOCK_BYTES, SHARD_BYTES = 16 << 20, 8 << 20
TASK_BYTES, SHARDS_PER_TASK = 32 << 20, 4  # of texts; tasks hold one block or shard at a time
RESULTS = ("n_tokens", "n_known", "train_tokens", "base_score", "score")
SLICE = 1 << 20
STEPS, OCTAVES = 8, 48  # per octave; estimates below 2^-48 share the last cell
CELLS = STEPS * OCTAVES + 1
BUCKETS = 48
LEAST = 1e-6  # of the uniform share, so that no text has probability zero
EM_ROUNDS = 100

KEPT, DELETED, OTHER = 0, 1, 2  # what a document is to learning: counted, held out, none
BEGIN, END = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD1B54A32D192ED03)
_BASE = 0x5851F42D4C957F2D
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def mixed(x: np.ndarray) -> np.ndarray:
    """Bits spread over 64 (splitmix)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The hash base and its inverse, modulo 2^64, to the powers 0 to n."""
    grow = lambda b: np.concatenate([[np.uint64(1)], np.cumprod(np.full(n, b, dtype=np.uint64))])
    return grow(_BASE), grow(pow(_BASE, -1, 1 << 64))


_POWERS = powers(0)


def word_hashes(data: bytes) -> np.ndarray:
    """A 64-bit hash of each word: its bytes as digits to an odd base, mixed."""
    global _POWERS
    if len(data) >= len(_POWERS[0]):
        _POWERS = powers(max(2 * SLICE, len(data)))
    up, down = _POWERS
    codes = np.frombuffer(data, dtype=np.uint8)
    edges = np.diff(np.concatenate([[True], _SPACE[codes], [True]]).astype(np.int8))
    start, end = np.flatnonzero(edges == -1), np.flatnonzero(edges == 1)
    total = np.concatenate([[np.uint64(0)], np.cumsum((codes.astype(np.uint64) + np.uint64(1)) * up[:len(codes)])])
    return mixed((total[end] - total[start]) * down[start] + (end - start).astype(np.uint64))


def slices(data: bytes) -> Iterator[bytes]:
    """``data`` cut at white space into pieces of about SLICE bytes."""
    at = 0
    while len(data) - at > SLICE:
        cut = max(data.rfind(bytes([c]), at, at + SLICE) for c in b"\t\n\x0b\x0c\r ")
        if cut <= at:  # one long word: up to the next white space
            cut = min((k for c in b"\t\n\x0b\x0c\r " if (k := data.find(bytes([c]), at + SLICE)) >= 0), default=len(data))
        yield data[at:cut]
        at = cut
    yield data[at:]


def tokens(texts) -> tuple[np.ndarray, np.ndarray]:
    """The token hashes of all texts (bytes), ends included, and the tokens of each text."""
    parts, sizes, held, waiting = [], [], [], 0

    def flush():
        # several short texts in one pass: a separator word stands for the end
        parts.append(word_hashes(b" ".join(held)))
        held.clear()

    for text in texts:
        data = text.lower()
        for piece in slices(data):
            held.append(piece)
            waiting += len(piece)
            if waiting >= SLICE:
                flush()
                waiting = 0
        held.append(_END_WORD)
    flush()
    flat = np.concatenate(parts)
    ends = np.flatnonzero(flat == _END_HASH)
    flat[ends] = END
    sizes = np.diff(np.concatenate([[-1], ends]))
    return flat, sizes


_END_WORD = b"\x00\xff\x00"  # no valid text holds it
_END_HASH = word_hashes(_END_WORD)[0]


class Block:
    """The n-grams of some texts: ``uni`` and ``bi`` are sorted distinct keys."""

    def __init__(self, texts, shard_bits: int):
        self.width = max(48, 64 - shard_bits) if shard_bits > 16 else 48
        drop = np.uint64(max(0, 16 - shard_bits))
        flat, self.sizes = tokens(texts)
        ends = np.cumsum(self.sizes)
        context = np.concatenate([[BEGIN], flat[:-1]]) if len(flat) else flat
        context[ends[:-1]] = BEGIN
        # the context of a text's first word counts once a text, as its end does
        self.uni, self.word = np.unique(flat >> drop, return_inverse=True)
        self.bi, self.pair = np.unique(mixed(context * np.uint64(3) + flat) >> drop, return_inverse=True)
        end = np.searchsorted(self.uni, END >> drop)
        before = np.concatenate([[0], self.word[:-1]]) if len(flat) else self.word
        before[ends[:-1]] = end
        if len(flat):
            before[0] = end
        self.before = before  # c(begin) = c(end): as many as texts

    def counts(self, index: np.ndarray, keys: np.ndarray, of_text: np.ndarray) -> np.ndarray:
        """How often each key occurs in the texts marked in ``of_text``."""
        return np.bincount(index[np.repeat(of_text, self.sizes)], minlength=len(keys))


def pack(keys: np.ndarray) -> bytes:
    """Sorted keys as differences, in as many bytes as the largest needs."""
    steps = np.diff(keys, prepend=np.uint64(0)).astype("<u8")
    size = max(1, (int(steps.max()).bit_length() + 7) // 8)
    return bytes([size]) + np.ascontiguousarray(steps.view(np.uint8).reshape(-1, 8)[:, :size]).tobytes()


def unpack(data: bytes) -> np.ndarray:
    size = data[0]
    rows = np.zeros((len(data) // size, 8), dtype=np.uint8)
    rows[:, :size] = np.frombuffer(data, dtype=np.uint8, offset=1).reshape(-1, size)
    return np.cumsum(rows.view("<u8").ravel(), dtype=np.uint64)


def pack_counts(counts: np.ndarray) -> bytes:
    return zlib.compress(counts.astype("<u4" if not len(counts) or counts.max() < 1 << 32 else "<u8").tobytes(), 1)


def unpack_counts(data: bytes, n: int) -> np.ndarray:
    raw = zlib.decompress(data)
    return np.frombuffer(raw, dtype="<u8" if n and len(raw) == 8 * n else "<u4").astype(np.int64)


def gathered(batches: Iterator[pd.DataFrame], returned: int, block_bytes: int) -> Iterator[pd.DataFrame]:
    """Rows (deleted, role, text, c0, c1, ...) as blocks, one row each; deleted documents
    have blocks of their own, so that learning reads only those."""
    task, made = TaskContext.get().partitionId(), 0
    columns = [f"c{k}" for k in range(returned)]
    held: dict[bool, list] = {False: [], True: []}
    size = {False: 0, True: 0}

    def block(deleted: bool) -> pd.DataFrame:
        nonlocal made
        rows, texts = held[deleted], [r[1] for r in held[deleted]]
        out = {"block": (task << 32) + made, "deleted": deleted, "bytes": size[deleted],
               "data": zstandard.compress(b"".join(texts), 3), "sizes": [len(t) for t in texts], "roles": [r[0] for r in rows],
               **{c: [r[2 + k] for r in rows] for k, c in enumerate(columns)}}
        made += 1
        held[deleted], size[deleted] = [], 0
        return pd.DataFrame({name: [value] for name, value in out.items()})

    for frame in batches:
        frame = frame.astype(object).where(frame.notna(), None)
        for deleted, role, text, *own in frame[["deleted", "role", "text", *columns]].itertuples(index=False, name=None):
            held[deleted].append((role, (text or "").encode("utf-8", "surrogatepass"), *own))
            size[deleted] += len(held[deleted][-1][1])
            if size[deleted] >= block_bytes:
                yield block(deleted)
    for deleted in (False, True):
        if held[deleted]:
            yield block(deleted)


def texts_of(data: bytes, sizes) -> list[bytes]:
    raw, ends = zstandard.decompress(data), np.cumsum(sizes).tolist()
    return [raw[a:b] for a, b in zip([0, *ends], ends)]


def ask(frame: pd.DataFrame, shard_bits: int) -> Iterator[pd.DataFrame]:
    """The blocks' keys and counts, a row for each shard and kind of key."""
    for block, deleted, data, sizes, roles in frame[["block", "deleted", "data", "sizes", "roles"]].itertuples(index=False, name=None):
        b, learned = Block(texts_of(data, sizes), shard_bits), np.asarray(roles) != OTHER
        rows = []
        for kind, index, keys in (("uni", b.word, b.uni), ("bi", b.pair, b.bi)):
            counts, shard = b.counts(index, keys, learned), keys >> np.uint64(b.width)
            cuts = np.flatnonzero(np.diff(shard)) + 1
            low = keys & np.uint64((1 << b.width) - 1)
            for s, k, c in zip(shard[np.concatenate([[0], cuts]).astype(int)].tolist(), np.split(low, cuts), np.split(counts, cuts)):
                rows.append((block, deleted, kind, s, len(k), pack(k), pack_counts(c)))
        yield pd.DataFrame(rows, columns=["block", "deleted", "kind", "shard", "n", "keys", "counts"])


def answer(frame: pd.DataFrame) -> pd.DataFrame:
    """The totals of one shard's keys, for each block in its own order; the row of block -1
    has the shard's distinct and summed counts."""
    sizes, deleted = frame["n"].tolist(), frame["deleted"].to_numpy()
    found, index = np.unique(np.concatenate([unpack(k) for k in frame["keys"]]), return_inverse=True)
    each = np.concatenate([unpack_counts(c, n) for c, n in zip(frame["counts"], sizes)])
    out = np.repeat(deleted, sizes)
    kept, gone = (np.bincount(index[m], weights=each[m], minlength=len(found)).astype(np.int64) for m in (~out, out))
    every, kind, shard = kept + gone, frame["kind"].iloc[0], frame["shard"].iloc[0]
    rows, at = [], 0
    for block, d, n in zip(frame["block"].tolist(), deleted, sizes):
        i = index[at:at + n]
        rows.append((block, d, kind, shard, n, pack_counts(kept[i]) if d else None, pack_counts(every[i]), 0, 0, 0, 0))
        at += n
    rows.append((-1, False, kind, shard, 0, None, None, int((kept > 0).sum()), int(kept.sum()),
                 int((every > 0).sum()), int(every.sum())))
    return pd.DataFrame(rows, columns=["block", "deleted", "kind", "shard", "n", "kept", "every",
                                       "v_kept", "n_kept", "v_every", "n_every"])


ANSWER = ("block long, deleted boolean, kind string, shard long, n long, kept binary, every binary, "
          "v_kept long, n_kept long, v_every long, n_every long")


def totals(answers: pd.DataFrame, kind: str, column: str) -> np.ndarray:
    """A block's totals in the order of its sorted keys."""
    own = answers[answers["kind"] == kind].sort_values("shard")
    parts = [unpack_counts(c, n) for c, n in zip(own[column], own["n"])]
    return np.concatenate(parts) if parts else np.zeros(0, dtype=np.int64)


def bucket_of(counts: np.ndarray) -> np.ndarray:
    return np.minimum(np.frexp(counts.astype(np.float64))[1], BUCKETS - 1)


def cell_of(p: np.ndarray) -> np.ndarray:
    """Cell of an estimate: its distance below 1 in steps; the last cell holds zero."""
    with np.errstate(divide="ignore"):
        return np.where(p > 0, np.minimum(np.round(-np.log2(p) * STEPS), CELLS - 2), CELLS - 1).astype(np.int64)


def cell_values() -> np.ndarray:
    return np.append(2.0 ** (-np.arange(CELLS - 1) / STEPS), 0.0)


def ratio(a: np.ndarray, b) -> np.ndarray:
    return np.divide(a, b, out=np.zeros(len(a)), where=np.asarray(b) > 0)


def learn(histogram: np.ndarray, v: int, rounds: int = EM_ROUNDS) -> np.ndarray:
    """(BUCKETS, 3) weights of bigram, unigram and uniform share, by EM on
    ``histogram[bucket, bigram cell, unigram cell]`` held-out tokens."""
    p = cell_values()
    parts = np.stack(np.broadcast_arrays(p[:, None], p[None, :], np.full((1, 1), 1.0 / (v + 1))))
    weights = np.empty((BUCKETS, 3))
    everything = histogram.sum(axis=0)
    for k in range(BUCKETS):
        events = histogram[k] if histogram[k].any() else everything
        at = np.nonzero(events)
        n, each = events[at], parts[:, at[0], at[1]]
        w = np.full(3, 1 / 3)
        for _ in range(rounds if len(n) else 0):
            share = w[:, None] * each
            share = (share / share.sum(axis=0)) @ n
            w = share / share.sum()
        if k == 0:  # contexts never seen have no bigrams
            w = np.array([0, w[0] + w[1], w[2]])
        w[2] = max(w[2], LEAST)
        weights[k] = w / w.sum()
    return weights


class InterpolatedModel:
    """Counts of ``docs`` (doc_id, text, learn), gathered on Spark, and the learned weights.
    ``returned``: the columns that ``score`` gives back."""

    def __init__(self, docs: DataFrame, returned: list[str], block_bytes: int = BLOCK_BYTES, shard_bytes: int = SHARD_BYTES):
        self.returned, kinds = returned, [docs.schema[c].dataType.simpleString() for c in returned]
        role = F.when(~F.col("learn"), OTHER).when(F.pmod(F.xxhash64("doc_id"), F.lit(7)) == 3, DELETED).otherwise(KEPT)
        rows = docs.select((role == DELETED).alias("deleted"), role.alias("role"), "text",
                           *[F.col(c).alias(f"c{k}") for k, c in enumerate(returned)])
        self.blocks = checkpointed(rows.mapInPandas(
            lambda batches: gathered(batches, len(returned), block_bytes),
            "block long, deleted boolean, bytes long, data binary, sizes array<long>, roles array<int>"
            + "".join(f", c{k} array<{t}>" for k, t in enumerate(kinds))))
        size = self.blocks.agg(F.coalesce(F.sum("bytes"), F.lit(0))).first()[0]
        self.shard_bits = bits = max(0, ceil(size / shard_bytes) - 1).bit_length()
        asked = self.blocks.select("block", "deleted", "data", "sizes", "roles").mapInPandas(
            lambda batches: (part for frame in batches for part in ask(frame, bits)),
            "block long, deleted boolean, kind string, shard long, n long, keys binary, counts binary")
        # tasks by the input's size: some shards, or some blocks, each, whatever the session's partitions
        self.tasks = -(-size // TASK_BYTES) or 1
        shards = max(1, 2 * (1 << bits) // SHARDS_PER_TASK)
        self.answers = checkpointed(asked.repartition(shards, "kind", "shard").groupBy("kind", "shard").applyInPandas(answer, ANSWER))
        uni = self.answers.where("block = -1 AND kind = 'uni'").agg(*[
            F.coalesce(F.sum(c), F.lit(0)) for c in ("v_kept", "n_kept", "v_every", "n_every")]).first()
        self.v_kept, self.n_kept, self.v, self.n = uni
        self.weights = self.learned()

    def joined(self, which: str, totals: str, columns: list[str], fn, schema: str) -> DataFrame:
        """``fn(block frame, answers frame)`` for each block that ``which`` selects."""
        ours = self.blocks.where(which).select("block", "data", "sizes", *columns).repartition(self.tasks, "block")
        theirs = self.answers.where(f"block >= 0 AND {which}").select("block", "kind", "shard", "n", totals).repartition(self.tasks, "block")
        return ours.groupBy("block").cogroup(theirs.groupBy("block")).applyInPandas(fn, schema)

    def learned(self) -> np.ndarray:
        bits, n_kept = self.shard_bits, self.n_kept

        def events(frame: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
            b = Block(texts_of(frame["data"].iloc[0], frame["sizes"].iloc[0]), bits)
            uni, bi = totals(answers, "uni", "kept"), totals(answers, "bi", "kept")
            before = uni[b.before]
            cell = (bucket_of(before) * CELLS + cell_of(ratio(bi[b.pair], before))) * CELLS + cell_of(
                ratio(uni[b.word], max(n_kept, 1)))
            found, n = np.unique(cell, return_counts=True)
            return pd.DataFrame({"cell": found, "n": n})

        cells = (self.joined("deleted", "kept", [], events, "cell long, n long")
                 .groupBy("cell").agg(F.sum("n").alias("n")))
        histogram = np.zeros(BUCKETS * CELLS * CELLS)
        for row in cells.toLocalIterator():  # at most BUCKETS * CELLS^2 cells, whatever the corpus
            histogram[row["cell"]] = row["n"]
        return learn(histogram.reshape(BUCKETS, CELLS, CELLS), self.v_kept)

    def score(self) -> DataFrame:
        """For every document the returned columns and n_tokens, n_known, train_tokens,
        base_score (add-one unigrams) and score, in log10."""
        bits, weights, n, v = self.shard_bits, self.weights, self.n, self.v
        columns = [f"c{k}" for k in range(len(self.returned))]

        def scored(frame: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
            block = frame.iloc[0]
            b = Block(texts_of(block["data"], block["sizes"]), bits)
            uni, bi = totals(answers, "uni", "every"), totals(answers, "bi", "every")
            one, before = uni[b.word], uni[b.before]
            w = weights[bucket_of(before)]
            p = w[:, 0] * ratio(bi[b.pair], before) + w[:, 1] * ratio(one, max(n, 1)) + w[:, 2] / (v + 1)
            at = np.concatenate([[0], np.cumsum(b.sizes)[:-1]]).astype(np.int64)
            return pd.DataFrame({
                **{c: pd.Series(list(block[c]), dtype=object) for c in columns}, "n_tokens": b.sizes,
                "n_known": np.add.reduceat((one > 0).astype(np.int64), at), "train_tokens": n,
                "base_score": np.add.reduceat(np.log10((one + 1) / (n + v + 1)), at),
                "score": np.add.reduceat(np.log10(p), at)})

        kinds = [self.blocks.schema[c].dataType.elementType.simpleString() for c in columns]
        out = self.joined("true", "every", columns, scored, "".join(f"{c} {t}, " for c, t in zip(columns, kinds))
                          + "n_tokens long, n_known long, train_tokens long, base_score double, score double")
        return out.toDF(*self.returned, *[free_name(self.returned, c) for c in RESULTS])
