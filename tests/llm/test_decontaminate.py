import random

import edge

from ledgerline.llm import decontaminate as D


def brute(words, items, window):
    hit, named = set(), set()
    for name, item in items:
        k = min(window, len(item))
        runs = {tuple(item[i : i + k]) for i in range(len(item) - k + 1)} if k else set()
        for i in range(len(words) - k + 1):
            if tuple(words[i : i + k]) in runs:
                hit.update(range(i, i + k))
                named.add(name)
    return hit, named


def test_automaton_against_brute_force():
    rnd = random.Random(5)
    for _ in range(1500):
        letters = [b"a", b"b", b"c"][: rnd.randint(1, 3)]
        items = [(str(j), [rnd.choice(letters) for _ in range(rnd.randint(0, 9))]) for j in range(rnd.randint(0, 5))]
        window = rnd.randint(2, 5)
        words = [rnd.choice([*letters, b"z"]) for _ in range(rnd.randint(0, 25))]
        ranges, named = D.hits(words, D.automaton(items, window))
        assert ({p for a, b in ranges for p in range(a, b)}, named) == brute(words, items, window)
        assert all(b < c for (_, b), (c, _) in zip(ranges, ranges[1:]))


def test_words_are_the_defined_ones():
    assert D.words_of("Ab-c9 É\x00x_y\x7f ÀB", D._word_table()) == ["ab".encode(), b"c9", "É".encode(), b"x", b"y", "Àb".encode()]


ITEM = "one two three four five six seven eight nine ten eleven twelve"


def items(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string, spans string")


def test_match_over_awkward_documents(spark):
    bench = items(spark, [(7, ITEM, "x"), (8, "Short item", "x"), (None, ITEM, "x"), (9, None, "x"), (10, "...", "x"), (7, ITEM, "x")])
    more = [edge.row(20, f"before {ITEM.upper()}, after short, item"), edge.row(21, "one two three four five six seven eight nine")]
    rows = {r.doc_id: r for r in D.digests(D.match(edge.docs(spark, edge.ROWS + more), bench)).where("doc_id >= 20").collect()}
    assert (rows[20].n_words, rows[20].n_hit, rows[20].n_items, rows[20].contaminated) == (16, 14, 2, True)
    assert (rows[21].n_hit, rows[21].n_items, rows[21].contaminated) == (0, 0, False)
    all_rows = D.digests(D.match(edge.docs(spark), bench)).collect()
    assert len(all_rows) == len(edge.ROWS) and not any(r.contaminated for r in all_rows)


def test_shards_do_not_change_the_result(spark, monkeypatch):
    rnd = random.Random(2)
    pool = [f"w{i}" for i in range(6)]
    bench = items(spark, [(i, " ".join(rnd.choice(pool) for _ in range(rnd.randint(3, 14))), "") for i in range(12)])
    docs = edge.simple(spark, [" ".join(rnd.choice(pool) for _ in range(60)) for _ in range(30)])
    whole = D.digests(D.match(docs, bench, window=4)).orderBy("doc_id").collect()
    monkeypatch.setattr(D, "SHARD_WORDS", 15)
    assert len(D.shards(bench)) > 2 * D.SHARDS_AT_ONCE
    assert D.digests(D.match(docs, bench, window=4)).orderBy("doc_id").collect() == whole


def test_remove(spark):
    bench = items(spark, [(1, ITEM, "x")])
    texts = [f"Keep this. {ITEM}, and that which follows stays here as well", ITEM, "clean text", None]
    docs = edge.simple(spark, texts)
    left = {r.doc_id: r for r in D.remove(docs, bench).collect()}
    assert left[0].text == "Keep this. and that which follows stays here as well" and left[0].n_chars == len(left[0].text)
    assert 1 not in left and left[2].text == "clean text" and left[3].text is None
    assert D.remove(docs, bench).columns == docs.columns and left[0]["a.b"] == "tick"


def test_remove_takes_one_python_pass_and_the_same_for_any_shards(spark, monkeypatch):
    rnd = random.Random(3)
    pool = [f"w{i}" for i in range(6)]
    bench = items(spark, [(i, " ".join(rnd.choice(pool) for _ in range(rnd.randint(3, 14))), "") for i in range(12)])
    texts = [", ".join(rnd.choice([*pool, "Other", "Ä"]) for _ in range(60)) for _ in range(30)] + ["", None, "w1"]
    docs = edge.simple(spark, texts)

    def removed():
        left = D.remove(docs, bench, window=5)
        assert left.columns == docs.columns
        assert left._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1
        return {r.doc_id: r for r in left.collect()}

    whole = removed()
    marked = {r.doc_id: r for r in D.match(docs, bench, window=5).collect()}
    hit = {i: sum(s.end - s.start for s in r.spans) for i, r in marked.items()}
    assert set(whole) == {i for i, r in marked.items() if hit[i] <= D.MAX_COVERAGE * r.n_words}
    for i, r in whole.items():
        words = D.words_of(texts[i], D._word_table())
        gone = {at for s in marked[i].spans for at in range(s.start, s.end)}
        assert D.words_of(r.text, D._word_table()) == [w for at, w in enumerate(words) if at not in gone]
    assert any(hit[i] for i in whole) and whole[31].text is None
    monkeypatch.setattr(D, "SHARD_WORDS", 15)
    assert len(D.shards(bench)) > 2 * D.SHARDS_AT_ONCE
    assert removed() == whole


def test_empty_tables(spark):
    bench = items(spark, [])
    assert D.match(edge.empty(spark), bench).collect() == []
    assert D.remove(edge.docs(spark), bench).count() == len(edge.ROWS)
    assert not any(r.contaminated for r in D.digests(D.match(edge.docs(spark), bench)).collect())
