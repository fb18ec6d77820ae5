import math

import numpy as np
import pytest
from pyspark.sql import types as T

from ledgerline.llm import hardneg as H

VECTORS = T.StructType([
    T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.DoubleType())), T.StructField("label", T.IntegerType()),
    T.StructField("row", T.StringType()), T.StructField("windows", T.StringType()),
])


def frame(spark, rows):
    return spark.createDataFrame([(i, v, lab, "r", "w") for i, v, lab in rows], VECTORS)


def brute(rows):
    """Every anchor against every row, by the definition."""
    kept = {}
    for i, v, lab in rows:
        if i is None or lab is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        whole = tuple(math.floor(256 * x) for x in v)
        kept[(i, (lab + 1) % 10 if i % 7 == 0 else lab, whole)] = True

    def score(a, b):
        return sum(x * y for x, y in zip(a, b))

    found = []
    for i, lab, v in kept:
        if i % 50:
            continue
        others = sorted((-score(v, w), j, m) for j, m, w in kept if j != i)
        for s, p, _ in [o for o in others if o[2] == lab][:5]:
            fits = [(n, j) for n, j, m in others if m != lab and 50 * -s <= 100 * -n <= 95 * -s]
            found += [(i, p, rank, j, -s, -n) for rank, (n, j) in enumerate(fits[:3], 1)]
    return sorted(found)


def mined(spark, rows):
    return sorted(tuple(r) for r in H.mine(H.relabelled(frame(spark, rows))).collect())


@pytest.mark.parametrize("seed,dim,n,spread", [(1, 4, 700, 0.3), (3, 1, 300, 0.5)])
def test_all_rows_against_all(spark, seed, dim, n, spread):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(6, dim))
    rows = [(int(i), list(map(float, centres[i % 6] + spread * rng.normal(size=dim))), int(rng.integers(10))) for i in range(n)]
    # Copies and ties.
    rows += [(n + i, rows[0][1], i % 3) for i in range(200)]
    assert mined(spark, rows) == brute(rows) != []


def test_awkward_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(50, [1.0, 0.0], 1), (1, [1.0, 0.0], 1), (2, [0.8, 0.0], 2), (2, [0.8, 0.0], 2), (3, [0.7], 3), (4, [], 4), (5, None, 1),
            (6, [nan, 1.0], 2), (8, [inf, 1.0], 2), (9, [None, 1.0], 2), (10, [0.9, 0.0], None), (None, [0.9, 0.0], 2), (11, [-1.0, 0.0], 2)]
    got = mined(spark, rows)
    assert got == [(50, 1, 1, 2, 65536, 52224), (50, 1, 2, 3, 65536, 45824)]


def test_large_components_are_exact(spark):
    rows = [(50, [2.0**22, 3.0], 1), (1, [2.0**22 - 1, 1.0], 1), (2, [2.0**21 + 7, 1.0], 5), (3, [2.0**21 + 7, 1 + 1 / 256], 5), (100, [2.0**20, 1.0], 2)]
    assert mined(spark, rows) == brute(rows) != []


def test_empty_and_unlabelled(spark):
    assert mined(spark, []) == []
    assert mined(spark, [(0, [], 2), (50, [], 2)]) == []


def test_ranges_drop_leaves_and_never_a_row():
    """In separate clusters most leaves go, and no row inside an annulus is in one that went."""
    rng = np.random.default_rng(5)
    centres = 10 * rng.normal(size=(12, 8))
    x = centres[rng.integers(12, size=3000)] + 0.3 * rng.normal(size=(3000, 8))
    largest = (x * x).sum(1).max()
    lifted = H.lifted(x, largest)
    nodes = H.fit_tree(lifted[:800])
    leaf = H.leaf_of(nodes, lifted)
    ranges = [(np.full((len(n["kids"]),) * 2, np.inf), np.full((len(n["kids"]),) * 2, -np.inf)) for n in nodes]
    for number, _, away, nearest in H.descend(nodes, lifted):
        for j in np.unique(nearest):
            ranges[number][0][:, j] = away[nearest == j].min(0)
            ranges[number][1][:, j] = away[nearest == j].max(0)
    anchors = np.concatenate([x[:50], np.zeros((50, 1))], axis=1)
    away = H.distances(anchors, lifted)
    inner = np.quantile(away, 0.01, axis=1)[:, None]
    outer = np.quantile(away, 0.03, axis=1)[:, None]
    kept = H.remaining(nodes, ranges, anchors, inner, outer, 1e-6)
    for i, leaves in enumerate(kept):
        inside = (away[i] >= inner[i]) & (away[i] <= outer[i])
        assert set(leaf[inside]) <= set(leaves)
    assert np.mean([len(k) for k in kept]) < 0.5 * len(np.unique(leaf))
