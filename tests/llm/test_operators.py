"""The operators' own interfaces: real outputs, parameters, forced splits."""

import hashlib

import numpy as np
import pandas as pd
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm import brute, fixtures
from tidewater.llm import ann, bpe_count, common, decontam, interp_lm, langid, pieces, sharding, simhash, toxicity, urlfilter

EXTRA = [c for c in fixtures.CLASHING]


@pytest.fixture(scope="module")
def awkward(tmp_path_factory):
    return fixtures.tables(tmp_path_factory.mktemp("awkward"))


@pytest.fixture(scope="module")
def empty(tmp_path_factory):
    return fixtures.tables(tmp_path_factory.mktemp("empty"), empty=True)


def test_spans_map_to_the_original(spark):
    text = "Über alles:  ALPHA-bravo é\ncharlie delta, x alpha bravo"
    docs = spark.createDataFrame([(1, text), (2, "clean")], "doc_id long, text string")
    bench = spark.createDataFrame([(7, "alpha bravo É Charlie delta".replace("É", "é"))], "item_id long, text string")
    hits = docs.select(decontam.benchmark_hits(F.col("text"), bench).alias("h")).select("h.*").collect()
    assert [text[s["start"]:s["end"]] for s in hits[0]["spans"]] == ["ALPHA-bravo é\ncharlie delta"]
    assert hits[0]["items"] == ["7"] and hits[1]["spans"] == []
    assert [r["doc_id"] for r in decontam.decontaminate(docs, bench).collect()] == [2]
    with pytest.raises(ValueError):
        decontam.benchmark_hits(F.col("text"), bench, max_bytes=3)


def test_items_in_groups_and_parts(spark):
    """Several automata in turn, and a benchmark searched in parts, against brute force."""
    items = [(i, fixtures.prose(i, 25)) for i in range(12)] + [(3, "alpha Bravo"), (12, fixtures.prose(1, 25)), (None, "of the"), (13, None)]
    texts = [fixtures.prose(i, 25) + " and " + fixtures.prose(50 + i, 30) for i in range(6)] + [None, "", "ALPHA, bravo; alpha bravo", fixtures.prose(70, 3000)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = [brute.contamination(t, items)[:3] for t in texts]
    for group_words in (1, 60, 10_000):
        hits = docs.select("doc_id", decontam.benchmark_hits(F.col("text"), bench, group_words=group_words).alias("h")).orderBy("doc_id").collect()
        assert [(r["h"]["n_words"], r["h"]["n_hit"], len(r["h"]["items"])) for r in hits] == want
        assert all(len(r["h"]["spans"]) > 0 for r, w in zip(hits, want) if w[1])
    assert len(decontam.item_groups(items, 60)) > 4
    clean = [i for i, w in enumerate(want) if not w[1]]
    for max_bytes in (200, 1 << 20):
        assert sorted(r["doc_id"] for r in decontam.decontaminate(docs, bench, max_bytes=max_bytes).collect()) == clean


def test_automaton_memory():
    """Two megabytes of items in groups: no automaton above some hundred megabytes."""
    rng = np.random.default_rng(1)
    words = np.array([f"{'abcdefghij'[i % 10]}{i}" for i in range(20_000)])
    items = [(i, " ".join(rng.choice(words, 500))) for i in range(560)]
    groups = decontam.item_groups(items)
    assert len(groups) == 2 and {g.size for g in groups} == {3}
    assert groups[0].automaton(10).get_stats()["total_size"] < 350e6


def test_url_rules_longest_host_and_block():
    trie = urlfilter.build_trie([("allow", "b.net", "/x/y"), ("block", "a.b.net", "/x"), ("allow", "c.org", ""),
                                 ("block", "c.org", ""), ("block", "d.org", "/en")])
    assert urlfilter.match(trie, "a.b.net", "/x/yz") == ("a.b.net/x", "block")
    assert urlfilter.match(trie, "b.net", "/x/yz") == ("b.net/x/y", "allow")
    assert urlfilter.match(trie, "b.net", "/x") is None
    assert urlfilter.match(trie, "z.c.org", "") == ("c.org", "block")
    assert urlfilter.match(trie, "d.org", "/english/1") == ("d.org/en", "block")
    for bad in (("deny", "a", "/"), ("allow", "", "/"), ("allow", "a", "en")):
        with pytest.raises(ValueError):
            urlfilter.build_trie([bad])


def plain_table(shards, slots):
    """The table by its definition: turns in order, each taking the first free wish."""
    import hashlib
    digest = lambda s: int(hashlib.md5(s.encode()).hexdigest()[:15], 16)
    taken, at = [None] * slots, [0] * shards
    for turn in range(slots):
        i = turn % shards
        offset, skip = digest(f"offset-{i}") % slots, digest(f"skip-{i}") % (slots - 1) + 1
        while taken[(offset + at[i] * skip) % slots] is not None:
            at[i] += 1
        taken[(offset + at[i] * skip) % slots] = i
    return taken


@pytest.mark.parametrize("shards,slots", [(1, 2), (3, 7), (7, 7), (10, 211)])
def test_lookup_table(spark, shards, slots):
    got = {r["slot"]: r["shard"] for r in sharding.lookup_table(spark, shards, slots).collect()}
    assert [got[s] for s in range(slots)] == plain_table(shards, slots)


def test_sharding_moves_little_and_keeps_names(spark, awkward):
    a, b = plain_table(10, 1009), plain_table(9, 1009)
    assert sum(x != y and x != 9 for x, y in zip(a, b)) < 0.35 * 1009
    docs = spark.read.parquet(f"{awkward}/documents.parquet")
    placed = sharding.place(docs, F.col("doc_id"))
    assert placed.columns == [*docs.columns, "slot_", "shard_"] and placed.count() == docs.count()
    plan = placed._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "BroadcastHashJoin" in plan
    for bad in ((3, 8), (9, 7), (0, 7)):
        with pytest.raises(ValueError):
            sharding.lookup_table(spark, *bad)


def test_piece_ids_unpack(spark):
    import public_tokenizers
    docs = spark.createDataFrame([("a b",), (None,)], "text string")
    coded = pieces.round_trip(F.col("text"), public_tokenizers.path("piece_bpe_32k.model"))
    got = docs.select(coded.alias("c")).select("c.decoded", pieces.unpack_ids(F.col("c.ids")).alias("ids")).collect()
    assert got[0]["decoded"] == "a b" and got[0]["ids"][0] == 1 and got[0]["ids"][-1] == 2
    assert got[1]["decoded"] == "" and got[1]["ids"] == [1, 2]


def test_workers_let_go_of_a_finished_jobs_tables(spark):
    """The codec and the automaton of a stage are gone when a worker runs the next one."""
    docs = spark.createDataFrame([(i, fixtures.prose(i, 40)) for i in range(64)], "doc_id long, text string").repartition(4)
    bench = docs.where("doc_id < 4").selectExpr("CAST(doc_id AS string) AS item_id", "text")
    assert decontam.decontaminate(docs, bench).count() < 64
    docs.select(pieces.round_trip(F.col("text"), public_tokenizers.path("piece_bpe_32k.model")).alias("c")).agg(F.max("c.ids")).collect()

    def held(batches):
        import gc
        gc.collect()
        for _ in batches:
            yield pd.DataFrame({"n": [sum(type(o).__name__ in ("ChunkCodec", "ItemGroup") for o in gc.get_objects()) + len(decontam._HELD)]})

    assert docs.mapInPandas(held, "n long").agg(F.max("n")).first()[0] == 0


def test_tables_start_anew_without_loss(monkeypatch):
    import public_tokenizers
    texts = [fixtures.prose(i, 60) for i in range(20)]
    path = public_tokenizers.path("piece_bpe_32k.model")
    want = list(pieces.ChunkCodec(path)(texts))
    monkeypatch.setattr(pieces, "CHUNKS_KEPT", 5)
    small = pieces.ChunkCodec(path)
    assert [row for t in texts for row in small([t])] == want
    full = bpe_count.Counter(public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN)
    want = [full(t) for t in texts]
    monkeypatch.setattr(bpe_count, "PIECES_KEPT", 3)
    small = bpe_count.Counter(public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN)
    assert [small(t) for t in texts] == want


@pytest.mark.parametrize("radius", [0, 1, 3, 6])
def test_bit_sliced_forest(radius):
    rng = np.random.default_rng(radius)
    base = rng.integers(0, 2**63, 150, dtype=np.int64)
    prints = np.unique(np.concatenate([base] + [base ^ (1 << rng.integers(0, 62, 150)) ^ (1 << rng.integers(0, 62, 150)) for _ in range(4)]))
    rng.shuffle(prints)
    cuts = np.sort(rng.choice(len(prints), 6, replace=False))
    sizes = np.concatenate([np.full(len(p), len(p)) for p in np.split(prints, cuts) if len(p)])
    root = simhash.forest(prints.view(np.uint64), sizes, radius)
    want, at = [], 0
    for part in np.split(prints, cuts):
        want += [at + r for r in brute.components([int(p) & (2**64 - 1) for p in part], radius)]
        at += len(part)
    assert root.tolist() == want


@pytest.mark.parametrize("blocks", [4, 5, 6, 7])
def test_masks_find_all_links(blocks):
    masks = simhash.masks(blocks, 3)
    rng = np.random.default_rng(0)
    for _ in range(300):
        flip = sum(1 << int(b) for b in rng.choice(64, 3, replace=False))
        flip -= (flip >> 63) << 64
        assert any(flip & m == 0 for m in masks)
    assert simhash.blocks_for(10, 3) == 4 < simhash.blocks_for(10**9, 3) <= simhash.blocks_for(10**12, 3)


def test_split_buckets_and_long_chains(spark, monkeypatch):
    monkeypatch.setattr(simhash, "BUCKET", 16)
    rng = np.random.default_rng(4)
    chain, p = [0], 0
    for b in list(range(48)) * 4:  # steps of one bit: one long chain in few buckets
        p ^= 1 << b
        chain.append(p)
    prints = list(dict.fromkeys(chain)) + [int(x) for x in rng.integers(-2**63, 2**63, 60)]
    docs = spark.createDataFrame([(i, p) for i, p in enumerate(prints)] + [(500 + i, prints[3]) for i in range(50)], "doc_id long, fp long")
    got = {r["fp"]: r["component_id"] for r in simhash.groups(docs).collect()}
    assert [got[p] for p in prints] == brute.components([p & (2**64 - 1) for p in prints])


def test_deduplicate_keeps_one_row_of_each_group(spark, awkward):
    docs = spark.read.parquet(f"{awkward}/documents.parquet")
    kept = simhash.deduplicate(docs)
    assert kept.columns == docs.columns
    rows = docs.select("doc_id", "text").collect()
    roots = brute.components([brute.fingerprint(r["text"]) for r in rows])
    assert kept.count() == len(set(roots))
    groups = {}
    for r, g in zip(rows, roots):
        groups.setdefault(g, []).append(r["doc_id"])
    want = sorted([min([i for i in g if i is not None], default=None) for g in groups.values()], key=repr)
    assert sorted([r["doc_id"] for r in kept.select("doc_id").collect()], key=repr) == want


def test_deduplicate_with_repeated_and_null_ids(spark):
    one, other = fixtures.prose(1, 300), " ".join(f"w{i}" for i in range(300))
    near = next(t for i in range(300) if 0 < (brute.fingerprint(one) ^ brute.fingerprint(t := one + " " + fixtures.WORDS[i % 16] * (i // 16 + 1))).bit_count() <= 3)
    schema = "doc_id long, text string"
    twice = spark.createDataFrame([(1, one), (2, one), (1, other), (3, other)], schema)
    assert sorted(map(tuple, simhash.deduplicate(twice).collect())) == sorted([(1, one), (1, other)])
    assert simhash.deduplicate(spark.createDataFrame([(None, one), (None, near)], schema)).count() == 1


def test_hubs_and_common_fingerprints_are_joined_apart(spark, monkeypatch):
    monkeypatch.setattr(common, "HOT_ROWS", 3)
    edges = [(i, 0) for i in range(1, 40)] + [(i, i + 1) for i in range(100, 110)] + [(110, 39)]
    got = {r["fp"]: r["root"] for r in simhash.stars(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {i: 0 for i in [*range(1, 40), *range(100, 111)]}
    docs = spark.createDataFrame([(i, "" if i % 3 else f"some text of number {i}") for i in range(60)], "doc_id long, text string")
    got = {r["doc_id"]: (r["fp"], r["component_id"]) for r in simhash.near_duplicates(docs).collect()}
    assert len(got) == 60 and all(got[i] == (0, 1) for i in range(60) if i % 3)
    kept = sorted(r["doc_id"] for r in simhash.deduplicate(docs).collect())
    assert kept == sorted({c for _, c in got.values()})


def test_ann_split_parts(spark, monkeypatch):
    monkeypatch.setattr(ann, "PART_ROWS", 20)
    monkeypatch.setattr(ann, "CHUNK", 4)
    rng = np.random.default_rng(1)
    x = rng.normal(size=(400, 8)) * rng.uniform(0.5, 2, (400, 1))
    x[200:260] = x[200] + 0.01 * rng.normal(size=(60, 8))
    vectors = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = ann.nearest(vectors, F.col("vec_id") % 20 == 0, n=5).toPandas()
    found = 0
    for q, own in got.groupby("query_id"):
        score = x @ x[q]
        score[q] = -np.inf
        found += len(set(np.argsort(-score, kind="stable")[:5]) & set(own["vec_id"]))
    assert found >= 0.9 * 100


@pytest.mark.parametrize("rows", [1, 2, 15, 21])
def test_ann_returns_all_candidates_of_a_small_table(spark, rows):
    rng = np.random.default_rng(rows)
    vectors = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(rng.normal(size=(rows, 8)))],
                                    "vec_id long, embedding array<float>")
    got = ann.nearest(vectors, F.col("vec_id") % 20 == 0).toPandas()
    assert len(got) == (rows - 1) * len(range(0, rows, 20))
    assert all(own["score"].is_monotonic_decreasing for _, own in got.sort_values("rank").groupby("query_id"))


def test_probe_sequence_is_in_order_of_cost():
    place = np.array([0.1, 0.6, 0.45])
    seen = ann.probe_sequence(place, 27)
    cost = [sum((p if m < 0 else 1 - p) ** 2 for p, m in zip(place, move) if m) for move in seen]
    assert len(set(seen)) == len(seen) == 27 and cost == sorted(cost) and seen[0] == (0, 0, 0)


def test_ranks_follow_the_probe_sequence(monkeypatch):
    monkeypatch.setattr(ann, "PROBES", 50)
    rng = np.random.default_rng(2)
    owner = np.sort(rng.integers(0, 3, 60))
    mine = rng.normal(size=(3, 4))
    theirs = mine[owner] + 0.5 * rng.normal(size=(60, 4))
    want = []
    for q, x in zip(owner, theirs):
        base = np.floor(mine[q])
        place = {m: r for r, m in enumerate(ann.probe_sequence(mine[q] - base, 50))}
        want.append(place.get(tuple((np.floor(x) - base).astype(int).tolist()), 50))
    assert ann.ranks(mine, theirs, owner).tolist() == want and len(set(want)) > 10


def test_tuning_takes_tables_and_widths_by_the_work():
    rng = np.random.default_rng(4)
    centre = rng.normal(size=(100, 16))
    for near, far in (0.05, 0.2), (1.0, 1.01):  # clear neighbours, and none to speak of
        x = centre[rng.integers(0, 100, 4000)] * (near < 1) + near * rng.normal(size=(4000, 16))
        queries, scale = x[:32], np.linalg.norm(x, axis=1).max()
        score = queries @ x.T
        true = [x[np.argsort(-s)[:20]] for s in score]
        h = ann.tuned(queries, true, x[1000:2000], 16, scale, 4000)
        met = lambda rows: np.stack([[np.isin(h.keys(t, np.floor(c)), h.probed(t, q)) for q in own]
                                     for t, (c, own) in enumerate(zip(h.cells(rows, False), h.cells(queries, True)))])
        found = np.mean([met(t)[:, i].any(axis=0).mean() for i, t in enumerate(true)])
        work = met(x).sum(axis=0).mean()
        assert found >= ann.TARGET - 0.005 and work < (0.5 if near < 1 else 1)


def test_language_grams():
    assert len(langid.grams(None)) == len(langid.grams("12 .,")) == 0
    long = fixtures.prose(1, 30) * 3
    whole = set(langid.grams(long).tolist())
    old, langid.SLICE = langid.SLICE, 50
    try:
        cut = set(langid.grams(long).tolist())
    finally:
        langid.SLICE = old
    assert len(whole ^ cut) <= 6  # the blanks put around a text that is one slice


def test_language_and_toxicity_without_labels(spark, empty, awkward):
    docs = spark.read.parquet(f"{awkward}/documents.parquet")
    none = docs.where("false")
    assert langid.fit(none) is None and toxicity.fit(docs, spark.read.parquet(f"{empty}/labels.parquet")) is None
    assert {r[0] for r in docs.select(langid.language(F.col("text"), None, docs)["lang_pred"]).collect()} == {"und"}
    assert {r[0] for r in docs.select(toxicity.toxicity(F.col("text"), None, docs)).collect()} == {0.0}


@pytest.mark.parametrize("counts", [(40, 40), (90, 10), (40, 0)])
def test_text_of_an_unlearned_script_goes(spark, counts):
    greek = str.maketrans("abcdefghijklmnopqrstuvwxyz", "αβγδεζηθικλμνξοπρστυφχψωάέ")
    texts = [(fixtures.prose(i, 40), "en") for i in range(counts[0])] + [(fixtures.prose(i, 40).translate(greek), "el") for i in range(counts[1])]
    rows = [(i, t, g) for i, (t, g) in enumerate(texts)] + [(1000, "ж", None), (1001, "мост через реку и старый камень", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert sorted(r["doc_id"] for r in corpus_pipeline.identify_language(spark, docs, "").collect()) == list(range(len(texts)))
    score = [s for _, s, *_ in langid.fit(docs).predict([rows[-1][1]])][0]
    assert abs(score - 1 / sum(n > 0 for n in counts)) < 0.1


def test_kneser_ney():
    grams, n = toxicity.gram_counts(["abab"] * 3 + ["bca"])
    assert dict(zip(grams, n))["\x01" * 5 + "a"] == 3 and sum(n) == 3 * 5 + 4
    more, m = toxicity.gram_counts(["abc"] * 2)
    every = sorted({*grams, *more})
    ordinary, toxic = (np.array([dict(zip(g, c)).get(x, 0) for x in every]) for g, c in ((grams, n), (more, m)))
    rows = toxicity.codes(every)
    p = toxicity.shared_backoff(rows)
    assert ((p > 0) & (p < 1)).all()
    tails, at = np.unique(rows[:, 1:], axis=0, return_index=True)
    _, prefix = np.unique(tails[:, :-1], axis=0, return_inverse=True)
    assert (np.bincount(prefix.ravel(), weights=p[at]) <= 1 + 1e-9).all()
    model = toxicity.ToxicityModel(rows, ordinary, toxic)
    score = dict(zip(["abc", "abab", "zzzz"], model.of_words(["abc", "abab", "zzzz"])))
    assert score["abc"] > 0 > score["abab"] and np.isfinite(score["zzzz"])


def test_toxicity_keeps_the_ratio_of_all_labels(spark):
    """A word that marks a text as toxic in three of ten cases, whatever the sample."""
    rows = [(i, fixtures.prose(i, 12) + (" moron" if i % 8 == 0 else ""), int(i % 80 in (0, 8, 16) or i % 80 == 1)) for i in range(4_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    marked = [t for _, t, _ in rows[::8]]
    all_of_them, fewer = (toxicity.model_score(toxicity.WordRatios(toxicity.fit(docs, docs, n)), marked).mean() for n in (4_000, 100))
    assert abs(all_of_them - 0.3) < 0.05 and abs(fewer - all_of_them) < 0.1


def test_lm_slices_words_and_blocks(spark, monkeypatch):
    texts = ["A b  c", "", None, "x\n a b c d é", "a" * 50 + " b", " "]
    raw = [(t or "").encode() for t in texts]
    flat, sizes = interp_lm.tokens(raw)
    assert sizes.tolist() == [len(brute.ascii_words(t)) + 1 for t in texts]
    monkeypatch.setattr(interp_lm, "SLICE", 4)
    again, same = interp_lm.tokens(raw)
    assert (flat == again).all() and (sizes == same).all()
    words = [w for t in texts for w in [*brute.ascii_words(t), None]]
    assert len(set(flat.tolist())) == len(set(words))
    monkeypatch.undo()
    docs = spark.createDataFrame([(i, fixtures.prose(i, 50 + i), i % 4 != 0) for i in range(60)], "doc_id long, text string, learn boolean")
    one = interp_lm.InterpolatedModel(docs.coalesce(1), ["doc_id"]).score().toPandas().sort_values("doc_id")
    many_model = interp_lm.InterpolatedModel(docs.withColumn("score", F.lit("own")), ["doc_id", "score"], block_bytes=900, shard_bytes=900)
    many = many_model.score()
    assert many.columns == ["doc_id", "score", "n_tokens", "n_known", "train_tokens", "base_score", "score_"]
    many = many.toPandas().drop(columns="score").rename(columns={"score_": "score"}).sort_values("doc_id")
    assert many_model.blocks.count() > 10 and many_model.shard_bits >= 4
    assert np.allclose(one["score"], many["score"]) and np.allclose(one["base_score"], many["base_score"])
    w = many_model.weights
    assert np.allclose(w.sum(axis=1), 1) and (w[:, 2] > 0).all() and w[0, 0] == 0


def test_lm_score_by_definition(spark):
    """The score recomputed from plain counts and the learned weights."""
    from collections import Counter
    from math import log10
    rows = [(i, fixtures.prose(i, 30 + i), i % 5 != 0) for i in range(40)]
    model = interp_lm.InterpolatedModel(spark.createDataFrame(rows, "doc_id long, text string, learn boolean"), ["doc_id"])
    one, two, ends = Counter(), Counter(), 0
    for _, t, learn in rows:
        if learn:
            ws = [*brute.ascii_words(t), None]
            one.update(ws)
            two.update(zip(["<"] + ws, ws))
            ends += 1
    n, v = sum(one.values()), len(one)
    assert (model.n, model.v) == (n, v)
    for r in model.score().collect():
        ws, total = [*brute.ascii_words(rows[r["doc_id"]][1]), None], 0.0
        for a, b in zip(["<"] + ws, ws):
            c = ends if a == "<" else one[a]
            x, y, z = model.weights[c.bit_length()]
            total += log10(x * (two[a, b] / c if c else 0) + y * one[b] / n + z / (v + 1))
        assert r["score"] == pytest.approx(total, rel=1e-9)


def test_em_finds_the_weights():
    rng = np.random.default_rng(0)
    histogram = np.zeros((interp_lm.BUCKETS, interp_lm.CELLS, interp_lm.CELLS))
    p2, p1 = interp_lm.cell_of(np.array([0.5, 0.0])), interp_lm.cell_of(np.array([0.01]))
    histogram[3, p2[0], p1[0]], histogram[3, p2[1], p1[0]] = 900, 100
    w = interp_lm.learn(histogram, 1000)[3]
    loss = lambda w: -(900 * np.log(w[0] * .5 + w[1] * .01 + w[2] / 1001) + 100 * np.log(w[1] * .01 + w[2] / 1001))
    del rng
    assert loss(w) <= min(loss([a, 1 - a - 1e-4, 1e-4]) for a in np.linspace(0.5, 0.99, 50)) + 0.5


STAGE_CASES = pytest.mark.parametrize("name,stage", corpus_pipeline.STAGES)


@STAGE_CASES
def test_stage_on_awkward_rows(spark, awkward, name, stage):
    docs = spark.read.parquet(f"{awkward}/documents.parquet")
    got = stage(spark, docs, awkward)
    if name == "sentencepiece":
        assert got.columns == ["doc_id", "ids", "n_tokens", "decoded_sha256"] and got.count() == docs.count()
    else:
        assert got.columns == docs.columns and 0 < got.count() < docs.count()


@STAGE_CASES
def test_stage_on_empty_tables(spark, empty, name, stage):
    assert stage(spark, spark.read.parquet(f"{empty}/documents.parquet"), empty).count() == 0


def test_pipeline_by_brute_force(spark, awkward):
    """Each stage's decisions against plain versions (the models' against their queries)."""
    docs = spark.read.parquet(f"{awkward}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars")
    kept, stages = docs, []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, kept = kept.collect(), stage(spark, kept, awkward).cache()
        stages.append(kept)
        after = kept.collect()
        ids = sorted([r["doc_id"] for r in after], key=repr)
        if name == "language_id":
            assert ids == sorted([r["doc_id"] for r in before if any(c.isalpha() for c in r["text"] or "")], key=repr)
        if name == "simhash_near_dedup":
            assert len(ids) == len(set(brute.components([brute.fingerprint(r["text"]) for r in before])))
        if name == "decontamination":
            bench = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{awkward}/benchmark.parquet").collect()]
            assert ids == sorted([r["doc_id"] for r in before if not brute.contamination(r["text"], bench)[1]], key=repr)
    final = corpus_pipeline.run(spark, awkward)
    assert final.columns == ["doc_id", "ids", "n_tokens", "decoded_sha256"]
    sp = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    want = []
    for r in kept.collect():
        ids = sp.encode(r["text"] or "", add_bos=True, add_eos=True)
        want.append((r["doc_id"], np.array(ids, dtype="<u4").tobytes(), len(ids), hashlib.sha256(sp.decode(ids).encode()).hexdigest()))
    assert sorted([(r[0], bytes(r[1]), *r[2:]) for r in final.collect()], key=repr) == sorted(want, key=repr)
    for stage in stages:
        stage.unpersist()
