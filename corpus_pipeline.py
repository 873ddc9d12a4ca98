"""Corpus pipeline: stages over ``documents``, each written as Parquet and read
again as the next one's input.

Every function in ``STAGES`` takes (spark, docs, sf_dir) and returns a
DataFrame; all but the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from haulwise.llm import bpe, decontaminate, language_id, simhash, substrings
from haulwise.llm.store import materialize


def language_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents for which a language is found stay, with the predicted one as their ``lang``; ``und`` goes (no text or
    no letter)."""
    return language_id.keep_identified(docs)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group stays: the one with the smallest id."""
    return simhash.keep_one_per_group(docs, shingle=3, max_distance=2)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts lose the words of repeated 13-word windows; the rest is joined by one
    space. A document that loses everything stays, with an empty text."""
    return substrings.keep_rest(docs, width=13).withColumn("n_chars", F.length("text").cast("long"))


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a 10-word window of a benchmark item go."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text")
    return decontaminate.keep_clean(docs, items, width=10)


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document left, checked by decoding: doc_id, lang, source,
    n_tokens, ids, ids_sha256, decoded_sha256."""
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    back = bpe.round_trip(docs.select("doc_id", "lang", "source", "text"), ranks, public_tokenizers.PATTERN)
    return back.select("doc_id", "lang", "source", F.size("_ids").cast("long").alias("n_tokens"),
                          F.col("_ids").alias("ids"), bpe.ids_digest("_ids").alias("ids_sha256"),
                          F.sha2("_decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("language_id", language_filter),
    ("simhash_near_dedup", simhash_near_dedup),
    ("substring_dedup", substring_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("byte_bpe", byte_bpe),
]

#: The chain of stages is tested against brute force; SQL cannot express it.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole ``documents`` table."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
