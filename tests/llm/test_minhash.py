import random
from collections import Counter

import edge
import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerline.llm import minhash as M


def shingles(text):
    words = (text or "").encode().lower().split()
    n = min(5, len(words))
    return frozenset(tuple(words[i : i + n]) for i in range(len(words) - n + 1)) if words else frozenset()


def brute(texts):
    """{id: (size, smallest id reachable)} of texts by id."""
    sets = {i: shingles(t) for i, t in texts.items()}
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in sets.items():
        for j, b in sets.items():
            if i < j and a and b and 100 * len(a & b) >= 75 * len(a | b):
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    return {i: (len(s), find(i)) for i, s in sets.items()}


def variants(seed, groups, size, words=60):
    """Groups of texts made from one each by a growing number of changed words."""
    rnd = random.Random(seed)
    out = []
    for _ in range(groups):
        base = [f"w{rnd.randrange(5000)}" for _ in range(words)]
        for k in range(size):
            text = list(base)
            for _ in range(rnd.randrange(1 + k % 6)):
                text[rnd.randrange(words)] = f"x{rnd.randrange(5000)}"
            out.append(" ".join(text))
    rnd.shuffle(out)
    return out


def result(df):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in M.near_duplicates(df).collect()}


def test_links_against_brute_force(spark):
    texts = dict(enumerate(variants(1, 12, 14) + ["", "one", "one", "a b c d", "A  b\tc d", "e f g h i", "e f g h i j"]))
    assert result(edge.simple(spark, list(texts.values()))) == brute(texts)


def test_a_large_group_against_brute_force(spark):
    texts = dict(enumerate(variants(2, 1, 150, words=40)))
    assert result(edge.simple(spark, list(texts.values()))) == brute(texts)


def test_prefix_pairs_miss_nothing(spark):
    texts = variants(3, 3, 40, words=30)
    tables = M.word_hash_tables(M._WHITE)
    sets = {i: M.shingle_set(t, tables) for i, t in enumerate(texts)}
    frame = spark.createDataFrame([(i, s.view(np.int64).tolist()) for i, s in sets.items()], "node long, shingles array<long>")
    found = {(r.a, r.b) for r in M.prefix_pairs(frame.select("node", F.col("node").alias("root")), frame).collect()}
    wanted = set()
    for i, a in sets.items():
        for j, b in sets.items():
            both = len(np.intersect1d(a, b))
            if i < j and 100 * both >= 75 * (len(a) + len(b) - both):
                wanted.add((i, j))
    assert wanted and wanted <= found


def test_components_of_a_long_path(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101), (101, 100)], "a long, b long")
    roots = {r.node: r.root for r in M.components(links).collect()}
    assert roots == {i: 0 for i in range(41)} | {100: 100, 101: 100}


def test_tensored_keys_meet_as_often_as_computed(spark):
    # At 0.75 a pair is missed with odds of about 1 in 10,000.
    rnd = np.random.default_rng(0)
    family, met = M._family(), 0
    for _ in range(400):
        common, own = rnd.integers(0, 2**63, 90, dtype=np.uint64), rnd.integers(0, 2**63, 30, dtype=np.uint64)
        one = M.half_keys(np.concatenate([common, own[:15]]), family)
        two = M.half_keys(np.concatenate([common, own[15:]]), family)
        same = one == two
        met += same[: M.HALVES].any() and same[M.HALVES :].any()
    assert met == 400


def test_awkward_documents(spark):
    df = edge.docs(spark)
    rows = M.near_duplicates(df).collect()
    assert len(rows) == len(edge.ROWS)
    by = Counter((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in rows)
    assert by[(1, 11, 1, True)] == 2 and by[(2, 11, 1, False)] == 1
    assert by[(3, 0, 3, True)] == 1 and by[(3, 1, 3, True)] == 1 and by[(4, 0, 4, True)] == 1
    assert by[(None, 1, None, True)] == 1 and by[(None, 0, None, True)] == 1
    assert M.near_duplicates(edge.empty(spark)).collect() == []


def test_keep_first(spark):
    df = edge.docs(spark)
    left = M.keep_first(df)
    assert left.columns == df.columns
    ids = Counter(r.doc_id for r in left.collect())
    # One of two equal rows stays, both texts under one id, and whatever has no id.
    assert ids[1] == 1 and 2 not in ids and ids[3] == 2 and ids[None] == 2 and ids[9] == 1
    assert M.keep_first(edge.empty(spark)).collect() == []


@pytest.mark.parametrize("text", ["", "a", "a b c d e f", "ü é " * 5, "x" * 3_000_000 + " y z", "w " * 700_000])
def test_word_hashes_in_pieces(text):
    tables = M.word_hash_tables(M._WHITE)
    words = M.word_hashes(text.encode(), tables)
    assert len(words) == len(text.split())
    if len(text) < 100:
        assert M.word_hashes(("  " + text + "\n").encode(), tables).tolist() == words.tolist()
