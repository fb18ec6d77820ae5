import base64
import random
from hashlib import sha256

import edge
import numpy as np
import public_tokenizers
import pytest
import tiktoken

from ledgerline.llm import bpe

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def vocab(spark):
    return bpe.vocabulary(spark, PATH, public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def reference():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(PATH, "rb"))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_perfect_hash_is_minimal(vocab):
    held = vocab.value
    assert sorted(held["ids"].tolist()) == [i for i, t in enumerate(held["tokens"]) if t]


@pytest.mark.parametrize("n", [1, 2, 5, 1000])
def test_perfect_hash_of_any_size(n):
    keys = np.random.default_rng(n).integers(1, 2**63, n, dtype=np.uint64)
    slots = bpe.slots_of(keys, bpe.perfect_hash(keys), n)
    assert sorted(slots.tolist()) == list(range(n))


def test_same_ids_as_the_public_library(vocab, reference):
    rnd = random.Random(4)
    alphabet = "aaabcde  \n\t'stré漢字😀0123.,!\x85\xa0<|>"
    texts = ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 120))) for _ in range(800)]
    texts += ["a" * 5000, "ab" * 3000, " " * 3000, "<|endoftext|>", "don't we'll", "unbelievableness " * 500]
    got = list(bpe._Encoder(vocab.value).encode(texts))
    assert [list(x) for x in got] == [reference.encode_ordinary(t) for t in texts]


def test_long_texts_are_cut_in_slices(vocab, reference, monkeypatch):
    monkeypatch.setattr(bpe, "_WHOLE_CHARS", 100)
    monkeypatch.setattr(bpe, "_SLICE", 7)
    text = "some words and 1234 numbers, again " * 20
    assert list(next(bpe._Encoder(vocab.value).encode([text]))) == reference.encode_ordinary(text)


def test_forgetting_changes_nothing(vocab, reference, monkeypatch):
    monkeypatch.setattr(bpe, "_REMEMBERED", 3)
    texts = [f"alpha beta{i} gamma delta zeta{i % 3}" for i in range(40)]
    encoder = bpe._Encoder(vocab.value)
    assert [list(next(encoder.encode([t]))) for t in texts] == [reference.encode_ordinary(t) for t in texts]


def test_round_trip_over_awkward_documents(spark, vocab, reference):
    given = edge.docs(spark).select("doc_id", "text", "score")
    rows = bpe.decode(bpe.encode(given, vocab), vocab).collect()
    assert len(rows) == len(edge.ROWS)
    for r in rows:
        assert bytes(r.decoded) == (r.text or "").encode() and r.score == "s"
        assert list(r.ids) == reference.encode_ordinary(r.text or "")
    digests = bpe.digests(bpe.decode(bpe.encode(given, vocab), vocab), "doc_id").collect()
    wanted = {(r.doc_id, len(r.ids), sha256(np.array(r.ids, "<u4").tobytes()).hexdigest(), sha256(bytes(r.decoded)).hexdigest()) for r in rows}
    assert {tuple(r) for r in digests} == wanted
    at_once = bpe.text_digests(given, vocab).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256").collect()
    assert {tuple(r) for r in at_once} == wanted
    checked = bpe.encode_checked(given, vocab).collect()
    assert sorted((str(r.doc_id), r.ids) for r in checked) == sorted((str(r.doc_id), r.ids) for r in rows)
    assert all(r.round_trip for r in checked)


def test_empty_table(spark, vocab):
    assert bpe.digests(bpe.decode(bpe.encode(edge.empty(spark).select("doc_id", "text"), vocab), vocab), "doc_id").collect() == []


def test_remembered_pieces_are_bounded_in_bytes(monkeypatch):
    monkeypatch.setattr(bpe, "_REMEMBERED", 2000)
    tokens = [bytes([i]) for i in range(256)] + [b"ab"]
    hashes = bpe.bytes_hashes(tokens, bpe.word_hash_tables(b""))
    shift = bpe.perfect_hash(hashes)
    ids = np.zeros(len(tokens), np.int64)
    ids[bpe.slots_of(hashes, shift, len(tokens))] = np.arange(len(tokens))
    encoder = bpe._Encoder({"tokens": tokens, "shift": shift, "ids": ids, "pattern": r"\S+|\s"})
    for i in range(200):
        text = f"ab{i} cd{i % 3} " + "x" * 300
        assert list(next(encoder.encode([text]))) == [t for p in text.split(" ") for t in [*bpe.merge(p.encode(), encoder.ranks), 32]][:-1]
        # A generation may pass the bound by the pieces of one text.
        assert len(encoder.known) + len(encoder.older) < 30
