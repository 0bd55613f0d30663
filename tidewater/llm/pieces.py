"""SentencePiece encoding and decoding over a table of distinct chunks.

In the normalised text every blank is a marker.  If no piece of the vocabulary holds a
marker after another character, no merge crosses from a character to a marker: the text
falls into chunks, each a run of markers and the word after it, that are segmented alone.
Each worker keeps a table of distinct chunks; the library segments and decodes each chunk
of a batch that is not yet in it, once, and the ids of a text are joined back by position.
A full table starts anew, which costs time only; a worker that
goes on to another job drops it.  No rows are moved between tasks.

``ids`` are little-endian unsigned 32-bit integers in a binary value; ``unpack_ids`` gives
an array.

Edge cases: null counts as the empty text, which has no ids besides begin and end.  The
marker character itself counts as a blank, as in the library.  Texts and words of any
length are encoded whole.  Rows are judged one by one, repeated ones each; extra columns play
no part, empty tables give no rows.
"""

from __future__ import annotations

import re
import struct
from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pandas as pd
import sentencepiece
from pyspark.sql import Column, SparkSession, functions as F

MARK = "▁"
CHUNKS_KEPT, CHUNK_CHARS, BATCH_CHARS = 150_000, 64, 1_000_000
_chunks = re.compile(r" +[^ ]*").findall


class ChunkCodec:
    def __init__(self, path: str):
        self.model = sp = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [sp.id_to_piece(i) for i in range(sp.get_piece_size())]
        if any(MARK in p.lstrip(MARK) for p in pieces):
            raise ValueError("a piece of this model crosses a whitespace marker")
        if sp.normalize(" a  b ") != f"{MARK}{MARK}a{MARK}{MARK}b{MARK}" or sp.normalize("Ａ") != f"{MARK}Ａ":
            raise ValueError("a model with identity normalisation and a dummy prefix is needed")
        self.begin, self.end = (struct.pack("<I", i) for i in (sp.bos_id(), sp.eos_id()))
        self.mark = [sp.piece_to_id(MARK)]  # a chunk of one marker: the library has no ids for ""
        self.table: dict[str, tuple[bytes, str]] = {}

    def learn(self, chunks: set[str]) -> dict[str, tuple[bytes, str]]:
        """The entries of ``chunks``; those not in the table are segmented."""
        table = self.table
        new = [c for c in chunks if c not in table]
        # a chunk's first marker is the prefix that the library adds and takes away
        ids = [i or self.mark for i in self.model.encode([c[1:] for c in new], num_threads=1)]
        made = {c: (np.array(i, dtype="<u4").tobytes(), c if c[1:] == d else " " + d)  # one string where they are equal
                for c, i, d in zip(new, ids, self.model.decode(ids, num_threads=1) if new else [])}
        if len(table) + len(made) > CHUNKS_KEPT:
            made |= {c: table[c] for c in chunks if c in table}
            table.clear()
        short = {c: e for c, e in made.items() if len(c) <= CHUNK_CHARS}
        if len(short) <= CHUNKS_KEPT:
            table.update(short)
        return made

    def __call__(self, texts: list[str]) -> Iterator[tuple[bytes, str]]:
        """(ids with begin and end, decoded text) of each text."""
        cut = [_chunks(" " + t.replace(MARK, " ")) if t else [] for t in texts]
        made, table = self.learn(set().union(*cut)), self.table
        for chunks in cut:
            entries = [table.get(c) or made[c] for c in chunks]
            yield (b"".join([self.begin, *[e[0] for e in entries], self.end]),
                   "".join([e[1] for e in entries])[1:])


class WorkersCodec:
    """The codec of a model file, made where it is used.  Broadcast, a worker keeps it for the
    tasks of one job and lets go of it, table and all, with the next job's."""

    def __init__(self, path: str):
        self.path = path

    @cached_property
    def codec(self) -> ChunkCodec:
        return ChunkCodec(self.path)


def by_size(texts: list[str]) -> Iterator[list[str]]:
    """The texts in slices of about BATCH_CHARS, so that a batch of long texts stays small."""
    part, size = [], 0
    for t in texts:
        part.append(t or "")
        size += len(part[-1])
        if size >= BATCH_CHARS:
            yield part
            part, size = [], 0
    if part:
        yield part


def round_trip(text: Column, path: str) -> Column:
    """A struct per text: ids (binary, begin and end included) and decoded (what the ids
    decode to).  ``path``: the model file, at the same place on every worker."""
    shared = SparkSession.active().sparkContext.broadcast(WorkersCodec(path))

    @F.pandas_udf("ids binary, decoded string")
    def coded(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        of = shared.value.codec
        for texts in batches:
            for part in by_size(list(texts)):
                yield pd.DataFrame(list(of(part)), columns=["ids", "decoded"])

    return coded(text)


def unpack_ids(ids: Column) -> Column:
    """Packed ids as an array of integers."""

    @F.pandas_udf("array<long>")
    def unpacked(packed: pd.Series) -> pd.Series:
        return packed.map(lambda b: None if b is None else np.frombuffer(b, dtype="<u4").astype("int64"))

    return unpacked(ids)
