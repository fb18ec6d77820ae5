"""From raw documents to token ids: five stages, each stored before the next one reads it."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm import bpe, decontaminate, langid, linededup, minhash
from ledgerline.llm.common import fresh, table
from ledgerline.session import materialize, prepare


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that is known; those without letters or like none of them go."""
    first, second = fresh(docs, "lang_pred", "score")
    return langid.known_language(docs, langid.fit(docs), (first, second))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the passages that an earlier document has; documents of which nothing is left go."""
    return linededup.dedup(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return minhash.keep_first(docs)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without passages of benchmark items; documents that are mostly such passages go."""
    return decontaminate.remove(docs, table(spark, sf_dir, "benchmark"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids per document, and whether they decode to its text."""
    vocab = bpe.vocabulary(spark, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    given = docs.select("doc_id", "lang", "source", "text")
    encoded = bpe.encode_checked(given, vocab)
    return encoded.select("doc_id", "lang", "source", F.size("ids").cast("long").alias("n_tokens"), "ids", "round_trip")


STAGES = [
    ("language", language),
    ("line_dedup", lines),
    ("near_duplicates", near_duplicates),
    ("decontamination", benchmark),
    ("tokens", tokens),
]

# Kernel regression, MinHash and byte pair merges have no counterpart in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in order over the documents table; each result is stored and read again."""
    docs = table(prepare(spark), sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return docs
