import random
from hashlib import sha256

import pytest

from ledgerline.llm import fixity as M

SCHEMA = "page_id long, url string, html string, digest int, leaf string"


def pages(spark, rows):
    return spark.createDataFrame([(i, u, h, 1, "x") for i, u, h in rows], SCHEMA)


def audit(spark, one, two):
    return sorted((r.page_id, r.finding) for r in M.audit(pages(spark, one), pages(spark, two)).collect())


@pytest.mark.parametrize("seed", range(3))
def test_random_damage_is_located(spark, seed):
    rnd = random.Random(seed)
    one = [(i, f"http://h/{i}", f"body {i} ü" * rnd.randint(0, 5)) for i in range(rnd.randint(1, 5000)) if rnd.random() < 0.9]
    two, wanted = [], []
    for i, u, h in one:
        what = rnd.random()
        if what < 0.002:
            wanted.append((i, "missing"))
        elif what < 0.005:
            two.append((i, u, h + "!"))
            wanted.append((i, "altered"))
        else:
            two.append((i, u, h))
    two.append((7000, "http://new", "added"))
    wanted.append((7000, "added"))
    assert audit(spark, one, two) == sorted(wanted)
    assert audit(spark, one, one) == []


def test_leaf_and_root_by_hand(spark):
    rows = [(i, f"u{i}", f"b{i}") for i in range(10)]
    records = M.records(pages(spark, rows))
    held = records.orderBy("id").collect()
    text = "WARC/1.1\r\nWARC-Type: resource\r\nWARC-Target-URI: u3\r\nContent-Length: 2\r\n\r\nb3\r\n\r\n"
    assert held[3].digest == sha256(text.encode()).hexdigest()
    assert [r.start for r in held] == [i * len(text) for i in range(10)] and all(r.end - r.start == len(text) for r in held)
    levels = M.tree(records)
    leaves = [sha256("".join(sha256(f"{r.id}|{r.digest}|{len(text)}".encode()).hexdigest() for r in held[a:b]).encode()).hexdigest() for a, b in ((0, 8), (8, 10))]
    assert [r.digest for r in levels[0].orderBy("node").collect()] == leaves
    root = levels[-1].collect()
    assert len(levels) == 2 and [r.digest for r in root] == [sha256("".join(leaves).encode()).hexdigest()]
    assert (root[0].start, root[0].end) == (0, 10 * len(text))


def test_only_differing_branches_are_entered(spark, monkeypatch):
    rows = [(i, "u", str(i)) for i in range(4096)]
    seen = []
    real = M.materialize

    def spy(df, label):
        out = real(df, label)
        if label == "differing":
            seen.append(out.count())
        return out

    monkeypatch.setattr(M, "materialize", spy)
    assert audit(spark, rows, [r for r in rows if r[0] != 2000]) == [(2000, "missing")]
    assert seen == [1, 1, 1, 1]


def test_awkward_records(spark):
    one = [(None, None, None), (None, "u", "x"), (None, "u", "x"), (5, "a", None), (5, "a", "b"), (5, "a", "b"), (6, None, "é" * 1000), (-3, "n", "n")]
    assert audit(spark, one, one) == []
    # Among repeated ids, what has no equal on the other side is matched in order.
    two = [(None, None, None), (None, "u", "x"), (5, "a", None), (5, "a", "b"), (5, "a", "c"), (6, None, "é" * 1000), (-3, "n", "m")]
    found = audit_rows = M.audit(pages(spark, one), pages(spark, two)).collect()
    assert sorted((r.page_id is None, r.page_id or 0, r.finding) for r in found) == [(False, -3, "altered"), (False, 5, "altered"), (True, 0, "missing")]
    assert audit_rows


def test_empty_replicas(spark):
    assert audit(spark, [], []) == []
    assert audit(spark, [(1, "u", "b")], []) == [(1, "missing")] and audit(spark, [], [(1, "u", "b")]) == [(1, "added")]
