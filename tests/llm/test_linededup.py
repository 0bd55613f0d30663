"""Line deduplication against a plain version, with hot lines forced and not."""

import hashlib
import re
from collections import defaultdict

import pandas as pd
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from tests.llm import fixtures
from tidewater.llm import linededup
from tidewater.llm.queries import QUERIES


def key(line):
    return re.sub("[A-Z]", lambda m: m[0].lower(), line.strip(" \t\n\x0b\x0c\r"))


def plain(rows, min_chars=10):
    """(doc_id, n_lines, n_dropped, kept text) of (doc_id, text) rows."""
    holders = defaultdict(set)
    order = lambda i: (i is None, i or 0)
    for i, t in rows:
        for line in (t or "").split("\n"):
            holders[key(line)].add(order(i))
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if len(key(x)) < min_chars or min(holders[key(x)]) == order(i)]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=repr)


LONG = "one line that many documents share"
AWKWARD = [
    (5, f"{LONG}\nown line of five\n{LONG}"), (3, f"  {LONG.upper()}\t\nown line of three\n\n"), (3, f"{LONG}\nother text of three"),
    (None, f"{LONG}\nonly without an id"), (None, "only without an id"), (None, None), (8, None), (9, ""), (10, "\n\n\n"),
    (11, "short\nshort\nÉclair no é\nécLAIR NO É"), (12, "Éclair no é\nécLAIR NO É"), (5, f"{LONG}\nown line of five\n{LONG}"),
    (13, "\n".join(f"line number {i % 700}" for i in range(2000))), (14, "\n".join(f"line number {i}" for i in range(600, 900))),
    (15, "x" * 300_000 + "\n" + LONG), (16, "\x00 nul inside it\n" + LONG), (17, "\x00 nul inside it"),
    *[(100 + i, f"{LONG}\n{'ab' * (i % 5)} tail {i % 40:04d}\nline number {i}") for i in range(300)]]


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "own", "own") for i, t in rows], "doc_id long, text string, n_lines string, keep string")


def result(docs, **how):
    out = linededup.deduplicate(docs, **how)
    assert out.columns == [*docs.columns, "n_lines_", "n_dropped"]
    return sorted([(r["doc_id"], r["n_lines_"], r["n_dropped"], r["text"] or "") for r in out.collect()], key=repr)


@pytest.mark.parametrize("how", [{}, {"hot_rows": 5, "rows_per_task": 20}, {"hot_rows": 0}])
def test_awkward(spark, how):
    assert result(frame(spark, AWKWARD), **how) == plain(AWKWARD)


def test_null_text_stays_null_and_empty_table(spark):
    out = linededup.deduplicate(frame(spark, [(1, None), (2, "")])).collect()
    assert sorted((r["doc_id"], r["text"]) for r in out) == [(1, None), (2, "")]
    assert linededup.deduplicate(frame(spark, AWKWARD).where("false")).count() == 0


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 6)), st.lists(st.sampled_from(
    ["ab", "AB ", "abc", " abc\t", "", "é\x0b", "É", "日本語"]), max_size=8)), max_size=12), st.integers(0, 3))
def test_random(spark, docs, hot):
    rows = [(i, "\n".join(lines) if lines else None) for i, lines in docs]
    assert result(frame(spark, rows), min_chars=2, hot_rows=hot, rows_per_task=3) == plain(rows, 2)


def test_bitmaps_are_compressed(spark):
    rows = [(1, f"{LONG}"), (2, "\n".join([f"own line number {i}" for i in range(6400)] + [LONG]))]
    maps = linededup.keep_bitmaps(frame(spark, rows), F.col("doc_id"), F.col("text")).collect()
    assert [(m["doc"], [tuple(w) for w in m["keep"]]) for m in maps] == [(2, [(100, ~1)])]


def test_hot_line_fills_no_task(spark):
    rows = spark.range(20_000).select(F.col("id").alias("doc_id"), F.lit(LONG).alias("text"))
    entries = linededup.line_entries(rows, F.col("doc_id"), F.col("text"))
    total, hot = linededup.hot_lines(entries)
    assert total == 20_000 and [r["keeper"] for r in hot.collect()] == [0]
    kept = linededup.dropped_entries(entries, rows_per_task=1000)
    sizes = [r["count"] for r in kept.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == 19_999 and max(sizes) < 3_000


def test_query(spark):
    docs = pd.read_parquet(f"{SF_SMALL}/documents.parquet")
    want = sorted([(i, n, d, hashlib.sha256(t.encode()).hexdigest()) for i, n, d, t in plain(list(zip(docs["doc_id"], docs["text"])))], key=repr)
    got = QUERIES["op13_line_dedup"](spark, SF_SMALL)
    assert sorted(map(tuple, got.collect()), key=repr) == want and sum(w[2] for w in want) > 0
    text = got._jdf.queryExecution().executedPlan().toString()
    assert not any(word in text for word in ("Python", "Pandas", "Arrow", "CartesianProduct", "NestedLoop"))


def test_query_on_awkward_tables(spark, tmp_path):
    folder = fixtures.tables(tmp_path)
    want = sorted([(i, n, d, hashlib.sha256(t.encode()).hexdigest()) for i, n, d, t in plain([r[:2] for r in fixtures.documents()])], key=repr)
    assert sorted(map(tuple, QUERIES["op13_line_dedup"](spark, folder).collect()), key=repr) == want
