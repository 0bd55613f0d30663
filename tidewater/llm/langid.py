"""Language identification with a string kernel.

Kernel: two texts are as alike as the number of distinct character n-grams of each length
in ``LENGTHS`` that both hold, summed over the lengths (a blended spectrum of presences),
divided by the geometric mean of either's own number.  Texts are lower-cased and every run
of characters other than letters is one blank.  The kernel is approximated by ``LANDMARKS``
texts (Nyström): a text's features are its kernel values with the landmarks times the
inverse square root of the landmarks' own kernel matrix.  Ridge regression on them learns
one function for each language against the rest, each language's rows weighing the same
together.  All of this is linear in a text's
presences of the landmarks' n-grams, so batches are scored as products of presence
matrices with one weight matrix.

Bound: landmarks and regression use at most ``sample`` labelled rows of up to
``sample_chars`` characters, an equal number of each language, those with the least
hashes; a language without such rows is learned from its shortest text.  More than
``MAX_LANGUAGES`` languages raise ValueError.  Scoring reads every text
whole, in slices.

Edge cases: a text that is null or has no letter is ``und`` with score 0.  Ties go to the
first language in order.  Null languages are not learned from; without any, all is
``und``.  Repeated rows are scored each.  Empty tables give no rows, extra columns play no part.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from tidewater.llm.common import hash_share, importable, within_reach

LENGTHS = (1, 2, 3)
LANDMARKS, SAMPLE, SAMPLE_CHARS = 240, 2_400, 20_000
MAX_LANGUAGES = 200
UNDETERMINED = "und"
SHARPNESS = 4.0  # of the score's softmax over the languages' functions
SLICE, BATCH = 1 << 18, 64
_others = re.compile(r"[\W\d_]+").sub
_CHAR = 21  # bits of a code point
_BLANKS = np.array([0x20, 0x20 << _CHAR | 0x20, 0x20 << 2 * _CHAR | 0x20 << _CHAR | 0x20])  # n-grams without a letter


def grams(text: str | None) -> np.ndarray:
    """The distinct n-grams of a text as sorted integers; empty if it has no letter.  A
    length is marked by the leading code point: shorter n-grams have zeros in front."""
    found, letters, text = np.zeros(0, dtype=np.int64), False, text or ""
    for at in range(0, len(text), SLICE):
        part = _others(" ", text[max(0, at - 2):at + SLICE].lower())  # two characters more: n-grams over the cut
        letters = letters or any(map(str.isalpha, part))
        cut = slice_grams(f" {part} " if len(text) <= SLICE else part)
        found = np.union1d(found, cut) if at else np.sort(cut)
    return found if letters else found[:0]


def slice_grams(part: str) -> np.ndarray:
    c = np.frombuffer(part.encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.int64)
    three = np.unique(c[:-2] << 2 * _CHAR | c[1:-1] << _CHAR | c[2:])
    return np.concatenate([np.unique(c), np.unique(c[:-1] << _CHAR | c[1:]), three])


class LanguageModel:
    """``vocabulary``: the landmarks' n-grams, sorted; ``weights``: a column a language."""

    def __init__(self, languages: list[str], texts: list[np.ndarray], labels: np.ndarray,
                 landmarks: int = LANDMARKS, ridge: float = 1e-2):
        self.languages = languages
        chosen = np.concatenate([np.flatnonzero(labels == k)[:max(1, landmarks // len(languages))]
                                 for k in range(len(languages))])
        self.vocabulary = np.unique(np.concatenate([texts[i] for i in chosen]))
        own = self.presence([texts[i] for i in chosen])
        own /= np.sqrt([len(texts[i]) for i in chosen])[:, None]
        value, vector = np.linalg.eigh((own @ own.T).astype(np.float64))
        usable = value > 1e-6 * value[-1]
        root = vector[:, usable] / np.sqrt(value[usable]) @ vector[:, usable].T
        to_features = own.T.astype(np.float64) @ root  # presences, normalised, to Nyström features
        z = np.concatenate([self.normalised(texts[i:i + BATCH]) @ to_features for i in range(0, len(texts), BATCH)])
        y = np.where(labels[:, None] == np.arange(len(languages)), 1.0, -1.0)
        weight = len(z) / len(languages) / np.bincount(labels, minlength=len(languages))[labels]
        self.offset = np.full(len(languages), 2 / len(languages) - 1)  # the weighted mean of y
        weighted = z * weight[:, None]
        solved = np.linalg.solve(weighted.T @ z + ridge * len(z) / len(languages) * np.eye(z.shape[1]), weighted.T @ (y - self.offset))
        self.weights = (to_features @ solved).astype(np.float32)

    def presence(self, texts: list[np.ndarray]) -> np.ndarray:
        out = np.zeros((len(texts), len(self.vocabulary)), dtype=np.float32)
        for row, found in zip(out, texts):
            at = np.minimum(np.searchsorted(self.vocabulary, found), len(self.vocabulary) - 1)
            row[at[self.vocabulary[at] == found]] = 1
        return out

    def normalised(self, texts: list[np.ndarray], presence: np.ndarray | None = None) -> np.ndarray:
        presence = self.presence(texts) if presence is None else presence
        return presence / np.sqrt([max(1, len(t)) for t in texts])[:, None].astype(np.float32)

    def predict(self, texts) -> Iterator[tuple[str, float, float]]:
        held: list[np.ndarray] = []
        for text in texts:
            held.append(grams(text))
            if len(held) == BATCH:
                yield from self._predict(held)
                held = []
        if held:
            yield from self._predict(held)

    def _predict(self, texts: list[np.ndarray]) -> Iterator[tuple[str, float, float]]:
        presence = self.presence(texts)
        known = presence @ (~np.isin(self.vocabulary, _BLANKS)).astype(np.float32)
        known /= [max(1, len(t) - np.isin(_BLANKS, t).sum()) for t in texts]
        value = SHARPNESS * (self.normalised(texts, presence) @ self.weights + self.offset)
        value = np.exp(value - value.max(axis=1, keepdims=True))
        value /= value.sum(axis=1, keepdims=True)
        for found, k, p, share in zip(texts, value.argmax(axis=1), value.max(axis=1), known):
            yield (self.languages[k], float(p), float(share)) if len(found) else (UNDETERMINED, 0.0, 0.0)


def fit(docs: DataFrame, sample: int = SAMPLE, sample_chars: int = SAMPLE_CHARS) -> LanguageModel | None:
    """A model of ``docs`` (doc_id, text, lang); None without any labelled text."""
    importable(docs.sparkSession)
    known, length = docs.where("lang IS NOT NULL AND text IS NOT NULL"), F.length("text")
    found = (known.groupBy("lang").agg(F.count_if(length <= sample_chars).alias("short"), F.min(length).alias("shortest"))
             .orderBy("lang").limit(MAX_LANGUAGES + 1).collect())
    if not found:
        return None
    if len(found) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    counts = {r["lang"]: max(1, r["short"]) for r in found}
    known = known.where(within_reach(length, F.col("lang"), {r["lang"]: r["shortest"] for r in found}, sample_chars))
    each = max(1, sample // len(counts))
    key = F.xxhash64("doc_id", "lang")
    by = Window.partitionBy("lang").orderBy(key, "doc_id")
    ids = (known.where(hash_share(key, F.col("lang"), dict.fromkeys(counts, each), counts)).select("doc_id", "lang").distinct()
           .withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= each))

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in batches:
            yield frame[["lang", "rank"]].assign(grams=frame["text"].map(grams))

    rows = (known.join(F.broadcast(ids), ["doc_id", "lang"]).select("lang", "rank", "text")
            .mapInPandas(read, "lang string, rank int, grams array<long>").where(F.size("grams") > 0).toPandas())
    if not len(rows):
        return None
    rows = rows.iloc[np.lexsort([rows["grams"].map(len), rows["lang"], rows["rank"]])]
    languages = sorted(set(rows["lang"]))
    return LanguageModel(languages, [np.asarray(g) for g in rows["grams"]], rows["lang"].map(languages.index).to_numpy())


def language(text: Column, model: LanguageModel | None, docs: DataFrame) -> Column:
    """A struct per text: lang_pred, score and known, the share of its n-grams with a letter
    that the landmarks have.  ``docs`` gives the session."""
    if model is None:
        return F.struct(F.lit(UNDETERMINED).alias("lang_pred"), F.lit(0.0).alias("score"), F.lit(0.0).alias("known"))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("lang_pred string, score double, known double")
    def predicted(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            yield pd.DataFrame(list(shared.value.predict(texts)), columns=["lang_pred", "score", "known"])

    return predicted(text)
