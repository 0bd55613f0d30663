"""Ranked lexical search against a plain version; blocks, salts and slices forced."""

import math
import re
from collections import Counter

import numpy as np
import pandas as pd
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from tests.llm import fixtures
from tidewater.llm import lexical
from tidewater.llm.queries import QUERIES


def words(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", lowered)


def plain(docs, items, k=10):
    """(item_id, rank, doc_id, score) by definition."""
    bags = [(i, Counter(words(t)), len(words(t))) for i, t in docs]
    held = sum(n > 0 for _, _, n in bags)
    length = sum(n for _, _, n in bags)
    df = Counter(w for _, b, _ in bags for w in b)
    out = []
    for item_id, text in items:
        scored = []
        for i, b, n in bags:
            if n:
                m = 100 - 75 + (75 * n * held) // length
                s = sum(math.floor(1000 * math.log((2 * held + 2) / (2 * df[w] + 1))) * ((1000000000 * b[w]) // (1000 * b[w] + 8 * m))
                        for w in words(text) if b[w])
                if s > 0:
                    scored.append((-s, i is None, i or 0, i))
        out += [(item_id, rank, i, -s) for rank, (s, _, _, i) in enumerate(sorted(scored, key=lambda x: x[:3])[:k], 1)]
    return sorted(out, key=repr)


def result(spark, docs, items, **how):
    d = spark.createDataFrame([(i, t, "own", 1.0) for i, t in docs], "doc_id long, text string, rank string, score double")
    q = spark.createDataFrame([(i, t, "own") for i, t in items], "item_id long, text string, doc_id string")
    got = lexical.search(d, F.col("doc_id"), F.col("text"), q, F.col("item_id"), F.col("text"), **how)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    return sorted(map(tuple, got.collect()), key=repr)


DOCS = [r[:2] for r in fixtures.documents()] + [
    *[(200 + i, "north river " + "amber " * (i % 3)) for i in range(60)], *[(None, "north river") for _ in range(15)],
    (300, "Über ÜBER über Straße straße"), (301, "A1 b2\x00c3 a1"), (302, "...")]
ITEMS = [(1, "north river amber"), (1, "north river amber"), (2, "north north NORTH stone"), (3, None), (4, "... !"), (None, "river light"),
         (5, "Über straße a1"), (6, "unheard words"), (7, fixtures.prose(3, 43)), (8, "a moron; an idiot"), (9, "日本 🎉 ⅷ")]


@pytest.mark.parametrize("how", [{}, {"block_bytes": 30}, {"crowded": 0, "k": 3}, {"k": 200}])
def test_by_definition(spark, how):
    assert result(spark, DOCS, ITEMS, **how) == plain(DOCS, ITEMS, how.get("k", 10))


def test_empty_tables(spark):
    assert result(spark, [], ITEMS) == [] and result(spark, DOCS, []) == [] and result(spark, [(1, None)], ITEMS) == []


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 20)), st.lists(st.sampled_from("a b c A é 1 -".split()), max_size=6)), max_size=25),
       st.lists(st.tuples(st.integers(0, 3), st.lists(st.sampled_from("a b c é x".split()), max_size=4)), max_size=4), st.integers(1, 4))
def test_random_with_ties(spark, docs, items, k):
    docs, items = [(i, " ".join(w)) for i, w in docs], [(i, " ".join(w)) for i, w in items]
    assert result(spark, docs, items, k=k, crowded=1) == plain(docs, items, k)


def test_text_in_slices_and_postings_in_batches(monkeypatch):
    text = fixtures.prose(5, 400) + " é" * 30
    monkeypatch.setattr(lexical, "SLICE", 7)
    assert lexical.term_counts(text) == Counter(w.encode() for w in words(text))
    vocabulary = {w: i for i, w in enumerate(sorted({w.encode() for w in words(text)}))}
    scorer = lexical.Scorer([lexical.term_counts(text), Counter({b"river": 3})], vocabulary, np.arange(len(vocabulary)) + 1)
    rng = np.random.default_rng(1)
    lists = [np.sort(rng.choice(len(vocabulary), n, replace=False)) for n in (5, 1, 9, 30, 2)]
    m, ends, terms = np.array([25, 90, 7_000, 31, 100]), np.cumsum([len(x) for x in lists]), np.concatenate(lists)
    tfs = rng.integers(1, 50, len(terms))
    whole = scorer.scores(m, ends, terms, tfs)
    scorer.floats_exact = False
    assert (scorer.scores(m, ends, terms, tfs) == whole).all()
    monkeypatch.setattr(lexical, "CELLS", 6)
    parts = list(scorer.batches(m, ends, terms, tfs))
    assert len(parts) > 2 and (np.vstack([s for _, s in parts]) == whole).all()


def test_classes_are_scored_once(spark):
    docs = spark.createDataFrame([(i, "north river") for i in range(5000)] + [(9000, "river north"), (9001, "river")], "doc_id long, text string")
    bagged = lexical.bags(docs, F.col("doc_id"), F.col("text"), {b"north": 0, b"river": 1})
    found = lexical.classes(bagged, 5002, 10_003, 10).collect()
    assert sorted(r["members"] for r in found) == [list(range(10)), [9001]]
    # the texts are passed over once: the bags are read back from their table
    assert "Python" not in bagged._jdf.queryExecution().executedPlan().toString()


def test_query(spark):
    docs, items = (pd.read_parquet(f"{SF_SMALL}/{n}.parquet") for n in ("documents", "benchmark"))
    want = plain(list(zip(docs["doc_id"], docs["text"])), list(zip(items["item_id"], items["text"])))
    assert sorted(map(tuple, QUERIES["op11_lexical_search"](spark, SF_SMALL).collect()), key=repr) == want
