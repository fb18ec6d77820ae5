import math
import random
import re
import zlib
from collections import Counter

import edge
import numpy as np
import pytest

from ledgerline.llm import maxent as M
from ledgerline.llm.common import word_hash_tables

TABLES = word_hash_tables(M._SEPARATORS)
WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def words(text):
    return [*WORD.findall((text or "").encode().lower()), None]


def training(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 10 != 0


def brute(rows):
    """Per row (n_tokens, n_known, train_tokens, base_score), from the definition."""
    counts = Counter(w for i, text in rows if training(i) for w in words(text))
    n, v = sum(counts.values()), len(counts)
    out = []
    for i, text in rows:
        every = words(text)
        base = sum(math.log10((counts[w] + 0.1) / (n + 0.1 * (v + 1))) for w in every)
        out.append((i, not training(i), len(every), sum(counts[w] > 0 for w in every), n, round(base, 6)))
    return sorted(out, key=repr)


def got(scored):
    return sorted(((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in scored), key=repr)


def two_languages(n):
    rnd = random.Random(4)
    vocab = [[f"{c}{'aeiou'[i % 5]}{i}" for i in range(300)] for c in "xy"]
    return [" ".join(rnd.choice(vocab[i % 2][: rnd.choice((10, 300))]) for _ in range(rnd.randrange(5, 120))) + "." for i in range(n)]


@pytest.fixture(scope="module")
def trained(spark):
    docs = edge.simple(spark, two_languages(600)).select("doc_id", "text")
    return docs, M.train(docs)


def test_counts_and_base_scores(spark, monkeypatch):
    rows = [(r[0], r[1]) for r in edge.ROWS] + [(100 + i, t) for i, t in enumerate(two_languages(60))]
    docs = edge.docs(spark, [edge.row(i, t) for i, t in rows])
    # With few head words most tokens go through the join.
    for head in (20, M.HEAD):
        monkeypatch.setattr(M, "HEAD", head)
        scored = M.score(docs, M.train(docs)).collect()
        assert got(scored) == brute(rows)
        assert all(math.isfinite(r.score) and r.score <= 0 for r in scored)


def test_without_training_texts(spark):
    assert M.score(edge.empty(spark), M.train(edge.empty(spark))).collect() == []
    nobody = edge.docs(spark, [edge.row(None, "a b"), edge.row(None, None)])
    assert [(r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in M.score(nobody, M.train(nobody)).orderBy("n_tokens").collect()] == [
        (1, 0, 0, 0.0, 0.0), (3, 0, 0, 0.0, 0.0)]


def test_held_out_texts_are_likelier_than_by_single_words(trained):
    docs, model = trained
    held = M.score(docs, model).where("held_out").collect()
    n = sum(r.n_tokens for r in held)
    assert sum(r.score for r in held) / n > sum(r.base_score for r in held) / n + 0.05


def test_all_outcomes_together_have_probability_one(trained):
    docs, model = trained
    table = model["words"].collect()
    lengths = np.array([4])
    hashes = np.array([h for _, _, h, _ in M.tokens(["xa0 ye41 xi2"], TABLES)][0])
    p = np.exp(M.log_softmax(M.logits(model["weights"], M.features(hashes, lengths))))
    word = np.array([r.word for r in table]).view(np.uint64)
    classes = model["class"][M.buckets(model, M.head_of(model), word, np.array([r.ending for r in table]))[1]]
    known = (np.array([r.n for r in table]) + M.SMOOTH) / model["mass"][classes]
    for at in range(4):
        total = (p[at][classes] * known).sum() + (p[at] * model["unseen"] / model["mass"]).sum()
        assert abs(total - 1) < 1e-4


def test_score_by_definition(trained):
    """One text's score, token by token, from the model's tables."""
    docs, model = trained
    text = "XA0 ye41 neverseen xi2"
    spark = docs.sparkSession
    scored = M.score(edge.simple(spark, [text]), model).first()
    n = {r.word: r.n for r in model["words"].collect()}
    total, (_, lengths, hashes, endings) = 0.0, next(M.tokens([text], TABLES))
    logp = M.log_softmax(M.logits(model["weights"], M.features(hashes, lengths)))
    for i, (h, e) in enumerate(zip(hashes, endings)):
        c = model["class"][M.buckets(model, M.head_of(model), hashes[i : i + 1], endings[i : i + 1])[1][0]]
        own = n.get(int(h.view(np.int64)))
        total += logp[i][c] / math.log(10) + math.log10((model["unseen"][c] if own is None else own + 0.1) / model["mass"][c])
    assert scored.score == pytest.approx(total, abs=1e-6) and scored.n_known == 4


def test_tokens_do_not_depend_on_their_neighbours():
    texts = ["Ab c", None, "", " \n", "ab\x0bC", "z" * 1_500_000 + " ab", "ab " * 700_000, "x " + "z" * 1_500_000]
    found = {}
    for first, lengths, hashes, _ in M.tokens(texts, TABLES):
        at = 0
        for i, n in enumerate(lengths):
            found[first + i] = hashes[at : at + n]
            at += n
        assert at == len(hashes)
    assert [len(found[i]) for i in range(len(texts))] == [len(words(t)) for t in texts]
    a, c = found[0][:2]
    assert found[4][0] == a and found[4][1] == c and found[5][1] == a and (found[6][:-1] == a).all()
    assert found[5][0] == found[7][1] and {found[i][-1] for i in found} == {M.END}


def test_gradient_step_lowers_the_loss():
    rng = np.random.default_rng(1)
    rows = np.stack([np.zeros(500, int), rng.integers(1, 20, 500)], 1)
    target = rows[:, 1] % 5
    weights, squares, met = np.zeros((20, 5), np.float32), np.zeros(20, np.float32), np.zeros(20)
    loss = [-M.log_softmax(M.logits(weights, rows))[np.arange(500), target].mean()]
    for _ in range(20):
        M.step(weights, squares, met, rows, target, 0.3)
        loss.append(-M.log_softmax(M.logits(weights, rows))[np.arange(500), target].mean())
    assert loss[-1] < 0.3 * loss[0] and met[0] == 20 * 500


def test_head_table_finds_every_word():
    rng = np.random.default_rng(2)
    known = np.unique(np.concatenate((rng.integers(0, 2**63, 40_000, dtype=np.uint64) * np.uint64(2), np.arange(1, 50, dtype=np.uint64))))
    head = M.Head(known)
    assert (head.places(known) == np.arange(len(known))).all()
    assert (head.places(known + np.uint64(1))[50:] == -1).all() and (M.Head(known[:0]).places(known) == -1).all()


def test_a_step_is_the_sum_over_its_tokens():
    rng = np.random.default_rng(3)
    # Rows met once, a few times, and by most tokens.
    rows = np.stack([np.zeros(400, int), rng.integers(1, 2000, 400), rng.integers(2000, 2040, 400), np.where(rng.random(400) < 0.9, 2100, 2101)], 1)
    target = rng.integers(0, 7, 400)
    given = rng.normal(size=(2200, 7)).astype(np.float32)
    weights, squares, met = given.copy(), np.ones(2200, np.float32), np.zeros(2200)
    p = np.exp(M.log_softmax(given[rows].sum(1, dtype=np.float64)))
    wrong = np.eye(7)[target] - p
    change, times = np.zeros((2200, 7)), np.zeros(2200)
    for i in range(rows.shape[1]):
        np.add.at(change, rows[:, i], wrong)
        np.add.at(times, rows[:, i], 1)
    damped = 1 + (change**2).mean(1)
    M.step(weights, squares, met, rows, target, 0.3)
    assert (met == times).all() and np.allclose(squares, damped, rtol=1e-4)
    assert np.allclose(weights, given + change * (0.3 / np.sqrt(damped * 7 + 1))[:, None], atol=1e-4)


def test_runs_of_equal_words():
    order, starts = M._runs(np.array([7, 3, 7, 9, 3, 7], np.uint64))
    assert np.array([7, 3, 7, 9, 3, 7])[order][starts].tolist() == [3, 7, 9] and starts.tolist() == [0, 2, 5]
    assert [len(a) for a in M._runs(np.empty(0, np.uint64))] == [0, 0]
