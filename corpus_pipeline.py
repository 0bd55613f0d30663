"""Corpus pipeline over ``documents``: each stage calls one training-data operator and works
on what the stage before it kept; ``run`` writes each result as Parquet below the shared
checkpoint folder and rereads it.

Stages: documents whose language is undetermined or hardly told go; documents judged toxic
go; of each near-duplicate group the least id stays; documents holding a passage of the
benchmark go; the last stage encodes what is left.  Edge cases are those of the operators:
a null or letterless text has no language and goes with the first stage, rows without an id
are judged like others, extra columns are kept, empty tables give empty results.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from tidewater.llm import decontam, langid, pieces, simhash, toxicity
from tidewater.llm.common import importable, keep_where, table
from tidewater.session import run_dir

MIN_LANGUAGE_SCORE = 0.26  # with four languages, a quarter tells nothing; with more, the bar is lower in proportion
MIN_KNOWN = 0.1  # of a text's n-grams; below it no language is told, however many were learned


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    importable(spark)
    model = langid.fit(docs.select("doc_id", "text", "lang"))
    found = langid.language(F.col("text"), model, docs)
    bar = MIN_LANGUAGE_SCORE * min(1.0, 4 / len(model.languages)) if model else MIN_LANGUAGE_SCORE
    return keep_where(docs, (found["lang_pred"] != langid.UNDETERMINED) & (found["score"] >= bar) & (found["known"] >= MIN_KNOWN))


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = toxicity.fit(docs.select("doc_id", "text"), table(spark, sf_dir, "labels").select("doc_id", "toxic"))
    return keep_where(docs, toxicity.toxicity(F.col("text"), model, docs) < 0.5)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    importable(spark)
    return simhash.deduplicate(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontam.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, the packed ids, their number and the SHA-256 of the text that they decode to."""
    importable(spark)
    coded = pieces.round_trip(F.col("text"), public_tokenizers.path("piece_bpe_32k.model"))
    return docs.select("doc_id", coded.alias("c")).select(
        "doc_id", F.col("c.ids").alias("ids"), (F.octet_length("c.ids") / 4).cast("long").alias("n_tokens"),
        F.sha2(F.col("c.decoded").cast("binary"), 256).alias("decoded_sha256"))


STAGES = [("language_id", identify_language), ("toxicity", drop_toxic), ("simhash_near_dedup", drop_near_duplicates),
          ("decontamination", drop_contaminated), ("sentencepiece", encode)]
ORACLE_SQL = None  # kernels, models and fingerprints are beyond SQL; tests hold it against brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, folder = table(spark, sf_dir, "documents"), run_dir(spark, "corpus_pipeline")
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
