import random

import edge
import numpy as np

from ledgerline.llm import quality as Q


def test_model_learns_steps_and_pairs():
    rng = np.random.default_rng(0)
    x = rng.random((3000, 4))
    y = (((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)) | (x[:, 2] > 0.9)).astype(float)
    model = Q.learn(x[:2000], y[:2000])
    found = Q.score(x[2000:], model) >= 0.5
    assert (found == y[2000:]).mean() > 0.95
    assert (0, 1) in [(i, j) for i, j, *_ in model["pairs"]]
    # A score is the sum of one entry per table.
    f = model["base"] + sum(t[np.searchsorted(e, x[0, i], side="right")] for i, (e, t) in enumerate(zip(model["edges"], model["tables"])))
    f += sum(t[np.searchsorted(a, x[0, i], side="right"), np.searchsorted(b, x[0, j], side="right")] for i, j, a, b, t in model["pairs"])
    assert abs(1 / (1 + np.exp(-f)) - Q.score(x[:1], model)[0]) < 1e-12


def test_one_kind_of_label_gives_a_constant():
    model = Q.learn(np.random.default_rng(0).random((20, 2)), np.ones(20))
    assert len(set(Q.score(np.random.default_rng(1).random((5, 2)), model))) == 1


def test_best_split_by_brute_force():
    rng = np.random.default_rng(3)
    for _ in range(50):
        g, h, c = rng.normal(size=8), rng.random(8), rng.integers(0, 9, 8)
        gains = {
            k: g[:k].sum() ** 2 / (h[:k].sum() + 1) + g[k:].sum() ** 2 / (h[k:].sum() + 1) - g.sum() ** 2 / (h.sum() + 1)
            for k in range(1, 8) if c[:k].sum() >= Q.MIN_ROWS and c[k:].sum() >= Q.MIN_ROWS
        }
        gain, at = Q._split(g, h, c)
        if gains and max(gains.values()) > 0:
            assert abs(gain - max(gains.values())) < 1e-9 and abs(gains[at] - gain) < 1e-9
        else:
            assert (gain, at) == (0.0, 0)


def corpus():
    rnd = random.Random(0)
    words = ["river", "stone", "walks", "under", "a", "the", "morning", "light", "quiet", "houses"]
    good = [". ".join(" ".join(rnd.choice(words) for _ in range(9)).capitalize() for _ in range(6)) + "." for _ in range(150)]
    bad = [" ".join(rnd.choice(words).upper() + "!!" for _ in range(rnd.randint(3, 60))) for _ in range(150)]
    return good + bad, [1] * 150 + [0] * 150


def test_held_out_accuracy(spark):
    texts, labels = corpus()
    marks = spark.createDataFrame([(i, y, None) for i, y in enumerate(labels)], "doc_id long, quality int, score string")
    rows = Q.rate(edge.simple(spark, texts), marks).where("held_out").collect()
    assert len(rows) > 30 and all(r.predicted == labels[r.doc_id] == int(r.score >= 0.3) for r in rows)


def test_held_out_labels_are_not_read(spark):
    texts, labels = corpus()
    rows = [(i, y) for i, y in enumerate(labels)]
    from zlib import crc32

    turned = [(i, 1 - y if crc32(str(i).encode()) % 5 == 0 else y) for i, y in rows]
    docs = edge.simple(spark, texts)
    one, two = (
        {r.doc_id: r.score for r in Q.rate(docs, spark.createDataFrame(x, "doc_id long, quality int")).collect()} for x in (rows, turned)
    )
    assert one == two


def test_awkward_documents_and_labels(spark):
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, None), (8, 0), (None, 1), (99, 1), (9, 7)], "doc_id long, quality int")
    rows = Q.rate(edge.docs(spark), labels).collect()
    assert len(rows) == len(edge.ROWS) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in rows)
    assert all(r.held_out for r in rows if r.doc_id is None)
    nothing = Q.rate(edge.docs(spark), labels.limit(0)).collect()
    assert {r.score for r in nothing} == {0.5}
    assert Q.rate(edge.empty(spark), labels).collect() == []
