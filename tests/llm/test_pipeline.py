"""The pipeline as a whole, the registered queries, and the queries that SQL expresses."""

from collections import Counter

import edge
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from ledgerline.llm import bpe, decontaminate, langid, linededup, minhash, oracle, queries

SMALL = "/root/testdata/sf0.001"


def test_registered():
    names = entry.queries()
    assert set(queries.queries()) <= set(names) and names["pipeline"] is corpus_pipeline.run
    numbers = sorted(int(n[2:].split("_")[0]) for n in names if n.startswith("op") and n[2].isdigit())
    assert numbers == list(range(1, 14)) and set(oracle.oracle_sql()) <= set(queries.queries())


@pytest.mark.parametrize("name", sorted(oracle.oracle_sql()))
def test_same_as_sql(spark, name):
    import duckdb
    import verify

    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SMALL}/{t}.parquet'")
    df, result = queries.queries()[name](spark, SMALL), con.sql(oracle.oracle_sql()[name])
    assert verify.type_clashes(df, zip(result.columns, result.types)) == [] and sorted(df.columns) == sorted(result.columns)
    got = verify.rows_of(df.columns, df.collect())
    assert got and got == verify.rows_of(result.columns, result.fetchall())


def test_every_document_is_in_every_result(spark):
    n = spark.read.parquet(f"{SMALL}/documents.parquet").count()
    for name in ("op1_fingerprints", "op2_quality", "op3_pii", "op5_line_dedup", "op7_language", "op8_bpe"):
        assert queries.queries()[name](spark, SMALL).count() == n, name


def test_stages_take_awkward_documents(spark):
    docs = edge.docs(spark)
    for name, stage in corpus_pipeline.STAGES:
        for given in (docs, edge.empty(spark)):
            out = stage(spark, given, SMALL)
            assert out.columns == docs.columns or name == "tokens"
            assert out.count() <= given.count()


def test_pipeline_against_the_operators_one_by_one(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    names = ("lang_pred", "score")
    known = {r.doc_id for r in langid.known_language(docs, langid.fit(docs), names).collect()}
    docs = docs.where(docs.doc_id.isin(sorted(known)))
    docs = linededup.dedup(docs)
    kept = {r.doc_id for r in minhash.near_duplicates(docs).where("kept").collect()}
    docs = docs.where(docs.doc_id.isin(sorted(kept)))
    docs = decontaminate.remove(docs, spark.read.parquet(f"{SMALL}/benchmark.parquet"))
    wanted = {r.doc_id: r.text for r in docs.collect()}
    rows = corpus_pipeline.run(spark, SMALL).collect()
    assert Counter(r.doc_id for r in rows) == Counter(list(wanted)) and all(r.round_trip for r in rows)
    encoder = bpe._Encoder(bpe.vocabulary(spark, queries.BPE_RANKS, corpus_pipeline.public_tokenizers.PATTERN).value)
    for r in rows:
        assert list(r.ids) == list(next(encoder.encode([wanted[r.doc_id]]))) and r.n_tokens == len(r.ids)
    assert any(wanted[i] != texts[i] for i in wanted) and len(wanted) > 0.8 * len(texts)
