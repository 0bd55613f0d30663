"""Benchmark decontamination with one Aho-Corasick automaton.

Texts are lower-cased (A-Z) and reduced to words of letters, digits and non-ASCII
characters.  Every ``window`` consecutive words of a test item is a pattern; an item with
fewer words is one pattern.  The automaton is over words, each spelt as two or three letters
that stand for its number: some twenty or thirty nodes a pattern whatever the words' lengths,
and a text's words are scanned once.  Normalising keeps every byte in place, so a match maps
back to the original text.

Memory: each Python worker builds the automaton once and keeps it (1 MB of items, 150,000
patterns: 155 MB and 1 s).  Items of more than ``GROUP_WORDS`` words go in groups, each with
an automaton of its own; they are then built in turn for every batch of texts, one alive at
a time, which costs time only.  The items' words are broadcast: their texts may hold
``max_bytes`` (64 MB).  More is searched in parts: :func:`decontaminate` does so by itself,
:func:`benchmark_hits` raises ValueError.  Nothing is cut off.

Edge cases: null or word-free text: no words, no hits.  Null or word-free items, and items
without an id: no pattern.  Repeated items count once per item id.  Empty tables: no rows,
or no hits.  Repeated documents are judged one by one.  Columns of the documents play no
part beyond the text, so clashing names cannot matter.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import repeat
from weakref import WeakKeyDictionary

import ahocorasick
import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from tidewater.llm.common import keep_where

WINDOW = 10
GROUP_WORDS, BASE = 150_000, 64
MAX_BYTES = 64 << 20

HITS = ("n_words long, n_hit long, items array<string>, "
        "spans array<struct<start:long,end:long>>")

_KEEP = set(b"0123456789abcdefghijklmnopqrstuvwxyz") | set(range(0x80, 0x100))
_FOLD = bytes(b + 32 if 65 <= b <= 90 else (b if b in _KEEP else 32) for b in range(256))


def fold_bytes(text: str) -> bytes:
    """Lower-case words kept, every other byte a blank; as long as the text in UTF-8."""
    return text.encode("utf-8", "surrogatepass").translate(_FOLD)


class ItemGroup:
    """The words of some test items, spelt by number: ``size`` letters a word, the first of
    them from an alphabet of its own, so that matches begin where words begin.  Few letters
    keep the automaton's nodes small and its steps quick.  This is what is broadcast."""

    def __init__(self, items: list[tuple[str, list[bytes]]]):
        words = sorted({w for _, ws in items for w in ws})
        self.size = next(k for k in range(2, 9) if len(words) <= BASE**k)
        self.spelling = {w: self.spelt_number(i) for i, w in enumerate(words)}
        self.unknown = "\0" * self.size
        self.items = [(item_id, self.spelt(ws)) for item_id, ws in items]

    def spelt_number(self, i: int) -> str:
        places = [i // BASE**k % BASE for k in reversed(range(self.size))]
        return chr(1 + places[0]) + "".join(chr(1 + BASE + p) for p in places[1:])

    def spelt(self, words: list[bytes]) -> str:
        return "".join(map(self.spelling.get, words, repeat(self.unknown)))

    def automaton(self, window: int):
        """Over the windows' letters; a pattern's value: its words, ids of its items."""
        found: dict[str, set] = {}
        for item_id, text in self.items:
            n = min(window * self.size, len(text))
            for i in range(0, len(text) - n + 1, self.size):
                found.setdefault(text[i:i + n], set()).add(item_id)
        auto = ahocorasick.Automaton()
        while found:  # the patterns leave as the automaton grows
            pattern, ids = found.popitem()
            auto.add_word(pattern, (len(pattern) // self.size, tuple(ids)))
        auto.make_automaton()
        return auto


def item_groups(items, group_words: int = GROUP_WORDS) -> list[ItemGroup]:
    """Groups of (item_id, text) pairs, an item to a group."""
    groups, held, size = [], [], 0
    for item_id, text in items:
        words = fold_bytes(text or "").split()
        if item_id is None or not words:
            continue
        if held and size + len(words) > group_words:
            groups.append(ItemGroup(held))
            held, size = [], 0
        held.append((str(item_id), words))
        size += len(words)
    return [*groups, ItemGroup(held)] if held else groups


# the automaton that this worker has built last, until its group, a broadcast value, is let go
_HELD: WeakKeyDictionary[ItemGroup, tuple[int, object]] = WeakKeyDictionary()


def held_automaton(group: ItemGroup, window: int):
    if group not in _HELD or _HELD[group][0] != window:
        _HELD.clear()
        _HELD[group] = window, group.automaton(window)
    return _HELD[group][1]


def text_spans(text: str, folded: bytes, hit: np.ndarray) -> list[dict]:
    """Runs of hit words as [start, end) character offsets in the original text."""
    raw = text.encode("utf-8", "surrogatepass")
    at = [m.span() for m in re.finditer(rb"[^ ]+", folded)]
    edges = np.flatnonzero(np.diff(np.concatenate([[0], hit, [0]])))
    spans, chars, seen = [], 0, 0
    for first, after in zip(edges[::2], edges[1::2]):
        ends = []
        for b in (at[first][0], at[after - 1][1]):
            chars += len(raw[seen:b].decode("utf-8", "surrogatepass"))
            seen = b
            ends.append(chars)
        spans.append({"start": ends[0], "end": ends[1]})
    return spans


class Judged:
    """What is known of one text: its words, marks of hit ones, ids of items found."""

    def __init__(self, text: str | None):
        self.text = text or ""
        self.folded = fold_bytes(self.text)
        self.marks, self.items, self.n_words = None, set(), None

    def scan(self, auto, group: ItemGroup) -> None:
        words = self.folded.split()
        self.n_words = len(words)
        for last, (n, ids) in auto.iter(group.spelt(words)):
            end = last // group.size
            if self.marks is None:
                self.marks = np.zeros(len(words) + 1, dtype=np.int64)
            self.marks[end + 1 - n] += 1
            self.marks[end + 1] -= 1
            self.items.update(ids)

    def row(self) -> tuple[int, int, list[str], list[dict]]:
        n = len(self.folded.split()) if self.n_words is None else self.n_words
        if self.marks is None:
            return n, 0, [], []
        hit = (np.cumsum(self.marks[:-1]) > 0).astype(np.int8)
        return n, int(hit.sum()), sorted(self.items), text_spans(self.text, self.folded, hit)


def benchmark_hits(text: Column, benchmark: DataFrame, window: int = WINDOW, max_bytes: int = MAX_BYTES,
                   group_words: int = GROUP_WORDS) -> Column:
    """A struct per text: words, hit words, ids of the items found (as text, sorted) and
    the hit passages as character offsets.  ``benchmark``: item_id, text."""
    spark = benchmark.sparkSession
    items = benchmark.select("item_id", "text")
    size = items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    if size > max_bytes:
        raise ValueError(f"the test items hold {size} bytes; one search takes {max_bytes}")
    shared = [spark.sparkContext.broadcast(g) for g in item_groups(items.toLocalIterator(), group_words)]

    @F.pandas_udf(HITS)
    def hits(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            judged = [Judged(t) for t in texts]
            for group in shared:
                auto = held_automaton(group.value, window)
                for j in judged:
                    j.scan(auto, group.value)
            yield pd.DataFrame([j.row() for j in judged], columns=["n_words", "n_hit", "items", "spans"])

    return hits(text)


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, max_bytes: int = MAX_BYTES) -> DataFrame:
    """The documents that hold no passage of the benchmark, columns unchanged.  A benchmark
    beyond ``max_bytes`` is searched in parts by the items' hash, one filter after the other."""
    size = benchmark.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    parts = 1 if size <= max_bytes else -(-2 * size // max_bytes)  # half full, as hashes spread
    part = F.pmod(F.xxhash64("item_id", "text"), F.lit(parts))
    for p in range(parts):
        own = benchmark if parts == 1 else benchmark.where(part == p)
        hits = benchmark_hits(F.col("text"), own, window, max(size, max_bytes))
        docs = keep_where(docs, hits["n_hit"] == 0)
    return docs
