"""The registered training-data queries: each operator over its whole table, with
production parameters.  ``QUERIES`` and ``ORACLE`` are added by ``__spark_entry__``."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from tidewater.llm import ann, bpe_count, decontam, interp_lm, langid, lexical, linededup, pieces, sharding, simhash, toxicity, urlfilter, vafile
from tidewater.llm.common import fold, table

URL_RULES = [("block", "net", "/"), ("allow", "example.net", "/en/"),
             ("block", "example.com", "/de/"), ("allow", "org", "/fr/")]


def op1_multiprobe_ann(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return ann.nearest(vectors, F.col("vec_id") % 20 == 0)


def op2_simhash(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return simhash.near_duplicates(docs).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op3_url_filter(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    verdict = urlfilter.url_verdict(spark, F.col("url"), URL_RULES)
    return pages.select("page_id", verdict.alias("v")).select("page_id", "v.*")


def op4_lookup_sharding(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id")
    return sharding.place(docs, F.col("doc_id"))


def op5_language_id(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", (fold(F.col("doc_id"), 4) == 2).alias("held_out"))
    model = langid.fit(docs.where(~F.col("held_out")).select("doc_id", "text", "lang"))
    return docs.select("doc_id", "held_out", langid.language(F.col("text"), model, docs).alias("l")).select(
        "doc_id", "held_out", "l.lang_pred", "l.score")


def op6_piece_codec(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = pieces.round_trip(F.col("text"), public_tokenizers.path("piece_bpe_32k.model"))
    return docs.select("doc_id", coded.alias("c")).select(
        "doc_id", (F.octet_length("c.ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("c.ids", 256).alias("ids_sha256"),
        F.sha2(F.col("c.decoded").cast("binary"), 256).alias("decoded_sha256"))


def op7_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic")
    model = toxicity.fit(docs, labels.where(fold(F.col("doc_id"), 5) != 0))
    return docs.select("doc_id", (fold(F.col("doc_id"), 5) == 0).alias("held_out"),
                       toxicity.toxicity(F.col("text"), model, docs).alias("score")).withColumn(
        "predicted", (F.col("score") >= 0.5).cast("int"))


def op8_token_count(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    n = bpe_count.token_count(F.col("text"), public_tokenizers.path("byte_bpe_50k.json"),
                              public_tokenizers.PATTERN)
    return docs.select("doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"),
                       n.alias("n_tokens")).withColumn("over_limit", F.col("n_tokens") > 1024)


def op9_decontamination(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    hits = decontam.benchmark_hits(F.col("text"), table(spark, sf_dir, "benchmark"))
    return docs.select("doc_id", hits.alias("h")).select(
        "doc_id", "h.n_words", "h.n_hit", F.size("h.items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "h.items").cast("binary"), 256).alias("items_sha256"),
        (F.col("h.n_hit") > 0).alias("contaminated"))


def op10_interpolated_lm(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", (fold(F.col("doc_id"), 7) == 2).alias("held_out"))
    model = interp_lm.InterpolatedModel(docs.withColumn("learn", ~F.col("held_out")), ["doc_id", "held_out"])
    return model.score()


def op11_lexical_search(spark, sf_dir):
    docs, items = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return lexical.search(docs, F.col("doc_id"), F.col("text"), items, F.col("item_id"), F.col("text"))


def op12_va_clusters(spark, sf_dir):
    return vafile.cluster(table(spark, sf_dir, "embeddings"), F.col("vec_id"), F.col("embedding"))


def op13_line_dedup(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return linededup.deduplicate(docs).select(
        "doc_id", "n_lines", "n_dropped",
        F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("kept_sha256"))


QUERIES = {f.__name__: f for f in (
    op1_multiprobe_ann, op2_simhash, op3_url_filter, op4_lookup_sharding, op5_language_id, op6_piece_codec,
    op7_toxicity, op8_token_count, op9_decontamination, op10_interpolated_lm,
    op11_lexical_search, op12_va_clusters, op13_line_dedup)}

SQUARE = "list_sum(list_transform(list_zip(v, c), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::BIGINT"
CLUSTER_ROUNDS = ",".join(f"""
a{i} AS (SELECT r, any_value(vec_id) AS vec_id, any_value(v) AS v, arg_min(k, (d, k)) AS k, min(d) AS d
  FROM (SELECT r, vec_id, v, k, {SQUARE} AS d FROM ints, c{i}) GROUP BY r),
m{i} AS (SELECT k, list((s - ((s % n) + n) % n) // n ORDER BY i)::BIGINT[] AS c
  FROM (SELECT k, i, sum(x) AS s, count(*) AS n FROM (SELECT k, unnest(v) AS x, unnest(range(64)) AS i FROM a{i}) GROUP BY k, i)
  GROUP BY k),
c{i + 1} AS (SELECT c{i}.k, coalesce(m{i}.c, c{i}.c) AS c FROM c{i} LEFT JOIN m{i} ON c{i}.k = m{i}.k)""" for i in range(3))

ORACLE = {
    "op3_url_filter": r"""
WITH parts AS (
  SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
  FROM pages),
split AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM parts),
rules(verdict, rhost, rpath) AS (VALUES ('block', 'net', '/'), ('allow', 'example.net', '/en/'),
                                        ('block', 'example.com', '/de/'), ('allow', 'org', '/fr/')),
fits AS (
  SELECT page_id, rhost || rpath AS rule, verdict,
         row_number() OVER (PARTITION BY page_id ORDER BY length(rhost || rpath) DESC, length(rhost) DESC) AS rn
  FROM (SELECT DISTINCT * FROM split) s JOIN rules
    ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath))
SELECT s.page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict
FROM split s LEFT JOIN fits f ON s.page_id = f.page_id AND rn = 1
""",
    "op4_lookup_sharding": f"""
WITH RECURSIVE
prefs AS (
  SELECT i AS shard, list_transform(range({sharding.SLOTS}),
         lambda j: (('0x' || md5('offset-' || i)[1:15])::BIGINT % {sharding.SLOTS}
                    + j * (('0x' || md5('skip-' || i)[1:15])::BIGINT % {sharding.SLOTS - 1} + 1)) % {sharding.SLOTS}) AS wish
  FROM range({sharding.SHARDS}) r(i)),
fill(turn, taken, slot) AS (
  SELECT 0, list_transform(range({sharding.SLOTS}), lambda x: false), NULL::BIGINT
  UNION ALL
  SELECT turn + 1, list_transform(taken, lambda v, i: v OR i = pick + 1), pick
  FROM (SELECT turn, taken, list_filter(wish, lambda x: NOT taken[x + 1])[1] AS pick
        FROM fill JOIN prefs ON shard = turn % {sharding.SHARDS} WHERE turn < {sharding.SLOTS})),
lookup AS (SELECT slot, ((turn - 1) % {sharding.SHARDS})::INTEGER AS shard FROM fill WHERE turn > 0),
keyed AS (
  SELECT doc_id, ('0x' || md5(coalesce('k' || doc_id, 'null'))[1:15])::BIGINT % {sharding.SLOTS} AS slot
  FROM documents)
SELECT doc_id, slot::INTEGER AS slot, shard FROM keyed JOIN lookup USING (slot)
""",
    "op9_decontamination": r"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''),
           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
items AS (
  SELECT item_id, w, least(len(w), 10) AS n FROM (
    SELECT item_id, regexp_extract_all(translate(coalesce(text, ''),
           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM benchmark WHERE item_id IS NOT NULL) WHERE len(w) > 0),
windows AS (
  SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS g
  FROM (SELECT item_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM items)),
found AS (
  SELECT r, i, d.n, item_id FROM (
    SELECT r, n, i, array_to_string(w[i:i + n - 1], ' ') AS g
    FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM docs, (SELECT DISTINCT n FROM windows))) d
  JOIN windows USING (n, g)),
hit AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS p FROM found) GROUP BY r),
named AS (SELECT r, list(DISTINCT item_id::VARCHAR) AS ids FROM found GROUP BY r)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(len(ids), 0)::BIGINT AS n_items,
       sha256(coalesce(array_to_string(list_sort(ids), ','), '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN hit USING (r) LEFT JOIN named USING (r)
""",
    "op13_line_dedup": r"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
lines AS (
  SELECT r, doc_id, i, ls[i] AS line, translate(trim(ls[i], ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
         'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM (SELECT r, doc_id, ls, unnest(range(1, len(ls) + 1)) AS i FROM docs)),
keepers AS (SELECT k, min(doc_id) AS keeper FROM lines WHERE length(k) >= 10 GROUP BY k),
judged AS (
  SELECT r, lines.doc_id, i, line, length(lines.k) < 10 OR lines.doc_id IS NOT DISTINCT FROM keeper AS keep
  FROM lines LEFT JOIN keepers ON lines.k = keepers.k)
SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines, count(*) FILTER (NOT keep) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (keep), '')) AS kept_sha256
FROM judged GROUP BY r
""",
    "op11_lexical_search": r"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''),
           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS t
  FROM documents),
stats AS (SELECT count(*) AS n_docs, sum(len(t))::BIGINT AS n_terms FROM docs WHERE len(t) > 0),
bag AS (SELECT r, any_value(doc_id) AS doc_id, any_value(n) AS n, term, count(*) AS tf
  FROM (SELECT r, doc_id, len(t) AS n, unnest(t) AS term FROM docs) GROUP BY r, term),
weighted AS (SELECT term, floor(1000 * ln((2 * any_value(n_docs) + 2) / (2 * count(*) + 1)))::BIGINT AS w
  FROM bag, stats GROUP BY term),
items AS (SELECT q, any_value(item_id) AS item_id, term, count(*) AS times FROM (
    SELECT q, item_id, unnest(regexp_extract_all(translate(coalesce(text, ''),
           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM (SELECT row_number() OVER () AS q, item_id, text FROM benchmark)) GROUP BY q, term),
scored AS (
  SELECT q, any_value(item_id) AS item_id, r, any_value(doc_id) AS doc_id,
         sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * n_docs) // n_terms))))::BIGINT AS score
  FROM items JOIN bag USING (term) JOIN weighted USING (term), stats GROUP BY q, r)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM scored WHERE score > 0)
WHERE rank <= 10
""",
    "op12_va_clusters": f"""
WITH ints AS (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS v
  FROM embeddings WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
c0 AS (SELECT row_number() OVER (ORDER BY sha256('1:' || vec_id), v) - 1 AS k, v AS c
  FROM ints WHERE vec_id IS NOT NULL ORDER BY k LIMIT 16),{CLUSTER_ROUNDS},
last AS (SELECT r, any_value(vec_id) AS vec_id, arg_min(k, (d, k)) AS k, min(d) AS d
  FROM (SELECT r, vec_id, k, {SQUARE} AS d FROM ints, c3) GROUP BY r)
SELECT vec_id, last.k::INTEGER AS cluster, d AS distance, sha256(array_to_string(c, ',')) AS centroid_sha256,
       (sum(d) OVER (PARTITION BY last.k))::BIGINT AS cluster_inertia, (sum(d) OVER ())::BIGINT AS inertia
FROM last JOIN c3 ON last.k = c3.k
""",
}
