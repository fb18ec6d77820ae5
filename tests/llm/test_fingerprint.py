import random
from hashlib import sha256

import edge
import numpy as np
import pytest

from ledgerline.llm import fingerprint as P

TABLE = P._byte_values()


@pytest.mark.parametrize("width", [1, 2, 3, 5, 7, 23, 24])
def test_windows(width):
    values = np.random.default_rng(0).integers(0, 2**63, 60, dtype=np.uint64)
    wanted = []
    for i in range(60 - width + 1):
        h = 0
        for v in values[i : i + width]:
            h = (h * int(P._BASE) + int(v)) % 2**64
        wanted.append(h)
    with np.errstate(over="ignore"):
        assert P._windows(values, width).tolist() == wanted


def random_text(rnd, n):
    return "".join(rnd.choice("abcdefghij klmnop") for _ in range(n)).encode()


def test_sketch_keeps_every_hash_below_the_threshold(monkeypatch):
    data = random_text(random.Random(1), 20_000)
    whole = P.sketch(data, TABLE)
    assert 400 < len(whole) < 850 and (whole < np.uint64(2**P.HASH_BITS // P.SCALE)).all()
    monkeypatch.setattr(P, "_CHUNK", 100)
    assert P.sketch(data, TABLE).tolist() == whole.tolist()
    assert P.read(P.write(whole)).tolist() == whole.tolist()


def test_containment_between_very_unequal_documents():
    rnd = random.Random(2)
    large, small = random_text(rnd, 400_000), random_text(rnd, 8000)
    a, b = P.sketch(large[:200_000] + small + large[200_000:], TABLE), P.sketch(small, TABLE)
    assert P.containment(b, a) > 0.98 and P.likeness(a, b) < 0.05
    halves = P.sketch(large[:200_000], TABLE), P.sketch(large[200_000 - P.SHINGLE_BYTES + 1 :], TABLE)
    assert P.merge(*halves).tolist() == P.sketch(large, TABLE).tolist()


def test_small_and_empty_texts():
    assert P.write(P.sketch(b"", TABLE)) == "0:"
    assert len(P.sketch(b"a", TABLE)) == 1 and P.sketch(b"a", TABLE).tolist() != P.sketch(b"b", TABLE).tolist()
    none, some = P.sketch(b"", TABLE), P.sketch(b"abc", TABLE)
    assert P.containment(none, none) == 1.0 and P.containment(none, some) == 0.0 == P.containment(some, none)
    assert P.likeness(none, none) == 1.0


def test_every_document_meets_its_successor(spark):
    rows = sorted(((r[0], r[1] or "") for r in edge.ROWS if r[0] is not None and r[0] != 3), key=lambda r: r[0])
    df = edge.docs(spark).where("doc_id IS NOT NULL AND doc_id <> 3")
    got = {r.doc_id: r for r in P.compare_edits(df).collect()}
    for i, (doc_id, text) in enumerate(rows):
        if rows[(i + 1) % len(rows)][0] == doc_id:
            continue
        other = rows[(i + 1) % len(rows)][1]
        changed = text[: len(text) - len(text) // 2] + other[: len(text) // 2]
        r = got[doc_id]
        assert (r.n_chars, r.edited_sha256) == (len(text), sha256(changed.encode()).hexdigest())
        assert r.fingerprint == P.write(P.sketch(text.encode(), TABLE))
        assert r.edited_fingerprint == P.write(P.sketch(changed.encode(), TABLE))
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
    everything = P.compare_edits(edge.docs(spark)).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in everything) == sorted((r[0] is None, r[0] or 0) for r in edge.ROWS)


@pytest.mark.parametrize("n", [1, 2, 3, 50])
def test_order_over_several_ranges(spark, n):
    df = edge.docs(spark, [edge.row(i * i, f"text number {i} " * 3) for i in range(n)])
    got = {r.doc_id: r.edited_sha256 for r in P.compare_edits(df.repartition(4)).collect()}
    texts = [f"text number {i} " * 3 for i in range(n)]
    wanted = {i * i: sha256(P.edited(texts[i], texts[(i + 1) % n]).encode()).hexdigest() for i in range(n)}
    assert got == wanted


def test_empty_table(spark):
    assert P.compare_edits(edge.empty(spark)).collect() == [] and P.fingerprints(edge.empty(spark)).collect() == []
