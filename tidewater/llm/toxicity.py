"""Toxicity by class-conditional Kneser-Ney models.

Each class, toxic and ordinary, has a Kneser-Ney model of the characters of words (order
``ORDER``, word ends included).  Only the highest order counts the classes apart; all lower
orders are continuation counts of both classes together, so an expression that is rare in a
class falls back on what the classes share, and text that neither knows says nothing.  A
word's log-likelihood ratio is summed over its characters.  A text is compared over its
whole length and over its most toxic stretches of some lengths, each normalised by the
words in it; a logistic curve, fitted on labelled texts that the models have not seen,
turns these means into a score.

Bound: models and curve are fitted on a sample of at most ``sample`` toxic and
``2 * sample`` ordinary labelled rows of up to ``sample_chars`` characters, those with the
least hashes; a class without such rows is learned from its shortest labelled text.  The curve sees each of them through a model of the other folds, the final
model counts all; its intercept is moved by the log of the classes' sampled shares, so
scores follow the classes' ratio among all labels.  Scoring reads every text whole.

Edge cases: null, empty or word-free text gets the score of a text that says nothing.
Null labels, and labels but 0 and 1, are not learned from.  Without labels of both classes
(empty tables) every score is 0.  Repeated rows are scored each; a repeated label counts
once.  Extra columns play no part.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from tidewater.llm.common import checkpointed, hash_share, importable, within_reach

ORDER, DISCOUNT = 6, 0.75
SAMPLE, SAMPLE_CHARS = 2_500, 20_000
STRETCHES = (1, 3, 10, 40)  # words
FOLDS = 4
WORDS_KEPT, WORD_CHARS = 200_000, 64
_words = re.compile(r"[^\W\d_]+").findall
_BEFORE, _AFTER = "\x01" * (ORDER - 1), "\x02"


def words_of(text: str | None) -> list[str]:
    return _words((text or "").lower())


def windows(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The n-grams of padded words, a row each, and the number of each word."""
    sizes = np.array([len(w) + 1 for w in words], dtype=np.int64)
    codes = np.frombuffer("".join([_BEFORE + w + _AFTER for w in words]).encode("utf-32-le", "surrogatepass"), dtype="<u4")
    rows = np.lib.stride_tricks.sliding_window_view(codes, ORDER)
    word = np.repeat(np.arange(len(words)), sizes)
    return rows[np.arange(len(word)) + word * (ORDER - 1)], word


def keys(rows: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each row."""
    h = np.full(len(rows), rows.shape[1], dtype=np.uint64)
    for column in rows.T:
        h = (h ^ column.astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
    return h


def grouped(values: np.ndarray, index: np.ndarray, size: int) -> np.ndarray:
    return np.bincount(index, weights=values, minlength=size)


def shared_backoff(rows: np.ndarray) -> np.ndarray:
    """The Kneser-Ney probability of each row's last character after all but its first, from
    continuation counts; ``rows`` are the distinct n-grams of both classes."""
    levels, grams = [], rows
    for k in range(ORDER - 1, 0, -1):
        _, first, index, count = np.unique(keys(grams[:, 1:]), return_index=True, return_inverse=True, return_counts=True)
        grams = grams[first][:, 1:]
        levels.append((grams, index, count))
    p = np.full(len(grams), 1.0 / (len(grams) + 1))
    for grams, index, count in reversed(levels):
        _, prefix = np.unique(keys(grams[:, :-1]), return_inverse=True)
        total, kinds = grouped(count, prefix, len(grams)), np.bincount(prefix, minlength=len(grams))
        p = (count - DISCOUNT + DISCOUNT * kinds[prefix] * p) / total[prefix]
        p = p[index]
    return p


def gram_counts(words) -> tuple[list[str], np.ndarray]:
    """The distinct n-grams of words and how often each occurs."""
    found, times = np.unique(np.array(words, dtype=object), return_counts=True)
    rows, word = windows(found.tolist())
    _, first, index = np.unique(keys(rows), return_index=True, return_inverse=True)
    grams = rows[first].tobytes().decode("utf-32-le", "surrogatepass")
    return [grams[i:i + ORDER] for i in range(0, len(grams), ORDER)], grouped(times[word], index, len(first)).astype(np.int64)


def codes(grams) -> np.ndarray:
    """N-grams as rows of code points."""
    return np.frombuffer("".join(grams).encode("utf-32-le", "surrogatepass"), dtype="<u4").reshape(-1, ORDER)


class ToxicityModel:
    """Log-likelihood ratios of n-grams and, for n-grams not seen, of their contexts."""

    def __init__(self, rows: np.ndarray, ordinary: np.ndarray, toxic: np.ndarray):
        """Distinct n-grams, as :func:`codes`, and their counts in either class."""
        found, order = np.unique(keys(rows), return_index=True)
        rows, n_of = rows[order], (ordinary[order], toxic[order])
        backoff = shared_backoff(rows)
        contexts, context = np.unique(keys(rows[:, :-1]), return_inverse=True)
        ratio, held_back = np.zeros(len(found)), np.zeros(len(contexts))
        for n, sign in zip(n_of, (-1, 1)):
            total, kinds = grouped(n, context, len(contexts)), grouped(n > 0, context, len(contexts))
            rest = np.divide(DISCOUNT * kinds, total, out=np.ones(len(contexts)), where=total > 0)
            p = np.maximum(n - DISCOUNT, 0) / np.maximum(total, 1)[context] + rest[context] * backoff
            ratio += sign * np.log(p)
            held_back += sign * np.log(rest)
        self.grams, self.ratio = found, ratio.astype(np.float32)
        self.contexts, self.held_back = contexts, held_back.astype(np.float32)
        self.curve = np.zeros(len(STRETCHES) + 3)
        self.centre, self.spread = np.zeros(len(self.curve) - 1), np.ones(len(self.curve) - 1)

    def of_words(self, words: list[str]) -> list[float]:
        if not words:
            return []
        rows, word = windows(words)
        out = np.zeros(len(rows))
        for table, values, k in ((self.contexts, self.held_back, keys(rows[:, :-1])), (self.grams, self.ratio, keys(rows))):
            at = np.minimum(np.searchsorted(table, k), len(table) - 1)
            out = np.where(table[at] == k, values[at], out)
        return np.bincount(word, weights=out, minlength=len(words)).tolist()

    def features(self, ratios: np.ndarray) -> list[float]:
        """Mean over the text, the largest means over stretches, and the length."""
        if not len(ratios):
            return [0.0] * (len(STRETCHES) + 2)
        total = np.concatenate([[0.0], np.cumsum(ratios)])
        best = [float((total[s:] - total[:-s]).max()) / s if (s := min(k, len(ratios))) else 0.0 for k in STRETCHES]
        return [float(ratios.mean()), *best, float(np.log(len(ratios)))]

    def fit_curve(self, features: np.ndarray, toxic: np.ndarray, ridge: float = 1.0, rounds: int = 50) -> None:
        self.centre, self.spread = features.mean(axis=0), features.std(axis=0) + 1e-9
        x = np.column_stack([np.ones(len(features)), (features - self.centre) / self.spread])
        w, flat = np.zeros(x.shape[1]), np.diag([1e-6] + [ridge] * (x.shape[1] - 1))
        for _ in range(rounds):  # Newton's method
            p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
            step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + flat, x.T @ (toxic - p) - flat @ w)
            w = w + step
            if np.abs(step).max() < 1e-8:
                break
        self.curve = w

    def score(self, features: np.ndarray) -> np.ndarray:
        z = self.curve[0] + (features - self.centre) / self.spread @ self.curve[1:]
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


class WordRatios(dict):
    """word -> ratio, filled a batch at a time; starts anew when full."""

    def __init__(self, model: ToxicityModel):
        super().__init__()
        self.model = model

    def features(self, texts) -> np.ndarray:
        out, part, size = [], [], 0
        for text in texts:
            part.append(words_of(text))
            size += len(part[-1])
            if size > 200_000:
                out += self._features(part)
                part, size = [], 0
        return np.array(out + self._features(part)).reshape(-1, len(STRETCHES) + 2)

    def _features(self, texts: list[list[str]]) -> list[list[float]]:
        seen = set().union(*texts)
        if len(self) > WORDS_KEPT:
            self.clear()
        new = [w for w in seen if w not in self]
        made = dict(zip(new, self.model.of_words(new)))
        self.update(made)
        rows = [self.model.features(np.array(list(map(self.__getitem__, t)))) for t in texts]
        for w in new:
            if len(w) > WORD_CHARS:
                del self[w]
        return rows


def sampled(docs: DataFrame, labels: DataFrame, sample: int, sample_chars: int) -> tuple[DataFrame, dict[int, float]]:
    """(text, toxic, rank) of the bounded sample; ranks count within a class.  The rows are
    chosen by id, so no text is shuffled; the chosen ids, 3 * sample at most, are broadcast.
    Beside it the share of each class's labels that the sample has."""
    lengths = docs.where("text IS NOT NULL").groupBy("doc_id").agg(F.min(F.length("text")).alias("length"))
    known = labels.where("toxic IN (0, 1)").select("doc_id", "toxic").distinct().join(lengths, "doc_id")
    wanted, key = {0: 2 * sample, 1: sample}, F.xxhash64("doc_id", "toxic")
    found = known.groupBy("toxic").agg(F.count_if(F.col("length") <= sample_chars).alias("short"),
                                       F.min("length").alias("shortest")).collect()  # two rows
    counts, shortest = {r["toxic"]: max(1, r["short"]) for r in found}, {r["toxic"]: r["shortest"] for r in found}
    known = known.where(within_reach(F.col("length"), F.col("toxic"), shortest, sample_chars)).drop("length")
    by = Window.partitionBy("toxic").orderBy(key, "doc_id")
    ids = (known.where(hash_share(key, F.col("toxic"), wanted, counts)).withColumn("rank", F.row_number().over(by))
           .where(F.col("rank") <= F.when(F.col("toxic") == 1, wanted[1]).otherwise(wanted[0])))
    shares = {y: min(1.0, wanted[y] / n) for y, n in counts.items()}
    chosen = docs.join(F.broadcast(ids), "doc_id").where(within_reach(F.length("text"), F.col("toxic"), shortest, sample_chars))
    return chosen.select("text", "toxic", "rank"), shares


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, sample_chars: int = SAMPLE_CHARS) -> ToxicityModel | None:
    """A model of ``labels`` (doc_id, toxic) for ``docs`` (doc_id, text); None if a class is
    missing.  What the driver gets is bounded by the sample."""
    importable(docs.sparkSession)
    chosen, shares = sampled(docs.select("doc_id", "text"), labels, sample, sample_chars)
    rows = checkpointed(chosen.select("text", F.col("toxic").cast("int"), (F.col("rank") % FOLDS).alias("fold")))

    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in batches:
            for (toxic, fold), texts in frame.groupby(["toxic", "fold"])["text"]:
                words = [w for t in texts for w in words_of(t)]
                if words:
                    grams, n = gram_counts(words)
                    yield pd.DataFrame({"gram": grams, "toxic": toxic, "fold": fold, "n": n})

    cells = [(y, k) for y in (0, 1) for k in range(FOLDS)]
    counts = (rows.mapInPandas(counted, "gram string, toxic int, fold int, n long").groupBy("gram")
              .agg(*[F.sum(F.when((F.col("toxic") == y) & (F.col("fold") == k), F.col("n")).otherwise(0)).alias(f"n{y}{k}")
                     for y, k in cells]).toPandas())

    grams = codes(counts.pop("gram"))
    n = counts.to_numpy(dtype=np.int64).reshape(-1, 2, FOLDS)
    del counts  # the driver's memory is small

    def model_of(folds) -> ToxicityModel | None:
        ordinary, toxic = n[:, 0, folds].sum(axis=1), n[:, 1, folds].sum(axis=1)
        seen = ordinary + toxic > 0
        return ToxicityModel(grams[seen], ordinary[seen], toxic[seen]) if ordinary.any() and toxic.any() else None

    model = model_of([*range(FOLDS)])
    if model is None:
        return None
    shared = docs.sparkSession.sparkContext.broadcast([model_of([j for j in range(FOLDS) if j != k]) for k in range(FOLDS)])

    def measured(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ratios = [None if m is None else WordRatios(m) for m in shared.value]
        for frame in batches:
            for fold, own in frame.groupby("fold"):
                if ratios[fold] is not None:
                    yield pd.DataFrame({"toxic": own["toxic"], "x": list(ratios[fold].features(own["text"]))})

    seen = rows.mapInPandas(measured, "toxic int, x array<double>").toPandas()
    if seen["toxic"].nunique() == 2:
        seen = seen.iloc[np.lexsort([*np.stack(seen["x"]).T, seen["toxic"]])]
        model.fit_curve(np.stack(seen["x"]), seen["toxic"].to_numpy())
        model.curve[0] += np.log(shares[0] / shares[1])
    shared.destroy()
    return model


def toxicity(text: Column, model: ToxicityModel | None, docs: DataFrame) -> Column:
    """The score of each text, 0 to 1.  ``docs`` gives the session."""
    if model is None:
        return F.lit(0.0)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def scores(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        ratios = WordRatios(shared.value)
        for texts in batches:
            yield pd.Series(model_score(ratios, texts), dtype="float64")

    return scores(text)


def model_score(ratios: WordRatios, texts) -> np.ndarray:
    return ratios.model.score(ratios.features(texts)) if len(texts) else np.zeros(0)
