"""The operators as named queries over the given tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from ledgerline.llm import bpe, decontaminate, fingerprint, fixity, hardneg, langid, linededup, linkgraph, maxent, minhash, pii, quality, structure
from ledgerline.llm.common import held_out, table
from ledgerline.session import prepare

BPE_RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


def op1_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.compare_edits(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return quality.rate(docs, table(spark, sf_dir, "labels"))


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digests(pii.find(table(spark, sf_dir, "documents").select("doc_id", "text")))


def op4_fixity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pages as an archive against a replica of it that is damaged at known places."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return fixity.audit(pages, fixity.damaged_replica(pages))


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "n_chars")
    return linededup.dedup(docs, note="n_blocks", drop_empty=False)


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return decontaminate.digests(decontaminate.match(docs, items))


def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = langid.fit(docs)
    return langid.predict(docs.select("doc_id", "text"), model).select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocab = bpe.vocabulary(spark, BPE_RANKS, public_tokenizers.PATTERN)
    return bpe.text_digests(table(spark, sf_dir, "documents").select("doc_id", "text"), vocab).drop("text")


def op9_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op10_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linkgraph.verdicts(table(spark, sf_dir, "pages").select("page_id", "url", "html"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hardneg.mine(hardneg.relabelled(table(spark, sf_dir, "embeddings")))


def op12_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return maxent.score(docs, maxent.train(docs))


def op13_structure(spark: SparkSession, sf_dir: str) -> DataFrame:
    talks = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return structure.repair(structure.damaged(talks), talks)


_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_fingerprints": op1_fingerprints,
    "op2_quality": op2_quality,
    "op3_pii": op3_pii,
    "op4_fixity": op4_fixity,
    "op5_line_dedup": op5_line_dedup,
    "op6_decontamination": op6_decontamination,
    "op7_language": op7_language,
    "op8_bpe": op8_bpe,
    "op9_minhash": op9_minhash,
    "op10_urls": op10_urls,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_language_model": op12_language_model,
    "op13_structure": op13_structure,
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def named(query: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        return lambda spark, sf_dir: query(prepare(spark), sf_dir)

    return {name: named(query) for name, query in _QUERIES.items()}
