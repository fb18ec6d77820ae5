import random

import edge
import pytest

from ledgerline.llm import linededup as L


def words(rnd, n):
    return " ".join(f"w{rnd.randrange(10**6)}" for _ in range(n))


def sentences(rnd, n, size=9):
    return " ".join(words(rnd, size).capitalize() + "." for _ in range(n))


def left(spark, texts, **options):
    return {r.doc_id: r.text for r in L.dedup(edge.simple(spark, texts), drop_empty=False, **options).collect()}


def test_a_passage_goes_from_all_but_the_first(spark):
    rnd = random.Random(1)
    passage = sentences(rnd, 7)
    texts = [sentences(rnd, 4) + " " + passage + " " + sentences(rnd, 4) for _ in range(30)]
    texts.insert(0, sentences(rnd, 5))
    got = left(spark, texts)
    assert got[0] == texts[0] and got[1] == texts[1]
    assert all(passage not in got[i] and got[i] == texts[i].replace(passage + " ", "") for i in range(2, 31))


def test_a_passage_in_the_middle_of_lines_and_without_sentences(spark):
    rnd = random.Random(2)
    passage = words(rnd, 90)
    texts = [f"{words(rnd, 20)} {passage} {words(rnd, 20)}" for _ in range(3)]
    got = left(spark, texts)
    inner = " ".join(passage.split()[30:60])
    assert inner in got[0] and inner not in got[1] and inner not in got[2]
    assert all(texts[i].split()[0] in got[i] and texts[i].split()[-1] in got[i] for i in range(3))


def test_clean_documents_and_common_lines_stay(spark):
    rnd = random.Random(3)
    texts = [sentences(rnd, 5) + "\nAll rights reserved by the owner.\n" + sentences(rnd, 5) for _ in range(40)]
    assert left(spark, texts) == dict(enumerate(texts))


def test_swapped_passages_are_both_found(spark):
    rnd = random.Random(4)
    a, b = sentences(rnd, 5), sentences(rnd, 5)
    got = left(spark, [a + "\n" + b, b + "\n" + a])
    assert got[1].strip() == ""


def test_a_passage_whose_lines_first_stand_apart(spark):
    rnd = random.Random(7)
    s = [sentences(rnd, 1, 12) for _ in range(5)]
    own = [sentences(rnd, 3) for _ in range(6)]
    texts = [f"{own[i]} {s[i]}" for i in range(4)] + [f"{own[4]} {' '.join(s)}", f"{own[5]} {' '.join(s)}"]
    got = left(spark, texts)
    assert all(got[i] == texts[i] for i in range(5))
    assert got[5].strip() == own[5]


def test_short_lines_and_text_without_spaces(spark):
    rnd = random.Random(9)
    menu = "\n".join(words(rnd, 1) for _ in range(60))
    chinese = "".join(chr(rnd.randrange(0x4E00, 0x9000)) for _ in range(120))
    thai = "".join(chr(rnd.randrange(0x0E01, 0x0E2F)) for _ in range(120))
    texts = [menu, f"{words(rnd, 7)}\n{menu}\n{words(rnd, 5)}", chinese, "漢字" + chinese + "文書", chinese, thai, thai]
    got = left(spark, texts)
    assert all(got[i] == texts[i] for i in (0, 2, 5))
    assert len(got[1].split()) < 45 and len(got[3]) < 64 and got[4] == got[6] == ""


def test_a_passage_on_sentence_ends_and_amid_sentences(spark):
    rnd = random.Random(10)
    texts = []
    for _ in range(20):
        passage = ". ".join(words(rnd, n) for n in (22, 12, 20))
        texts += [f"{sentences(rnd, 2)} {passage}. {sentences(rnd, 2)}", f"{words(rnd, 9)} {passage} {words(rnd, 9)}."]
    got = left(spark, texts)
    assert all(got[i] == texts[i] for i in range(0, 40, 2))
    assert sum(len(got[i].split()) for i in range(1, 40, 2)) < 0.65 * 20 * 72


def test_lines_depend_on_their_neighbourhood_only(monkeypatch):
    rnd = random.Random(11)
    text = "\n".join(words(rnd, rnd.randint(1, 30)) for _ in range(60))
    whole = L.lines_of(text)
    later = {h for _, _, _, h in L.lines_of("Something else. " + text)}
    assert sum(h not in later for _, _, _, h in whole) <= 2
    monkeypatch.setattr(L, "_PIECE", 50)
    assert L.lines_of(text) == whole


def test_sequences_cover_every_shared_passage():
    rnd = random.Random(8)
    for _ in range(300):
        lines = [{"at": i, "line": i, "words": rnd.randint(3, 20)} for i in range(rnd.randint(1, 9))]
        found = {(a, b) for a, b, _ in L.sequences(lines)}
        for a in range(len(lines)):
            for b in range(a + 1, len(lines) + 1):
                if sum(x["words"] for x in lines[a:b]) >= L.BLOCK_WORDS:
                    assert set(range(a, b)) == {i for x, y in found if a <= x and y <= b for i in range(x, y)}


def test_the_longest_increasing_sequence_by_brute_force():
    from itertools import combinations

    rnd = random.Random(5)
    for _ in range(200):
        there = rnd.sample(range(12), rnd.randint(0, 8))
        pairs = list(enumerate(there))
        got = L.longest_increasing(pairs)
        assert all(x[1] < y[1] for x, y in zip(got, got[1:]))
        best = max((k for k in range(len(pairs) + 1) for c in combinations(there, k) if list(c) == sorted(c)), default=0)
        assert len(got) == best


def test_nothing_is_lost(spark):
    """Every line of the corpus is still in some document, and what is left of a document is its own."""
    rnd = random.Random(6)
    pool = [sentences(rnd, 3) for _ in range(12)]
    texts = ["\n".join(rnd.sample(pool, 4) + [sentences(rnd, 2)]) for _ in range(25)]
    got = left(spark, texts)
    whole = "\n".join(got.values())
    for i, text in enumerate(texts):
        for a, b, _, _ in L.lines_of(text):
            assert text[a:b].strip() in whole
    assert sum(map(len, got.values())) < 0.7 * sum(map(len, texts))


def test_awkward_documents(spark):
    df = edge.docs(spark, edge.ROWS + [edge.row(40, edge.LONG), edge.row(41, "x" * 200_000)])
    kept = L.dedup(df)
    assert kept.columns == df.columns
    rows = kept.collect()
    by = {}
    for r in rows:
        by.setdefault(r.doc_id, []).append(r)
    # Rows of one id do not touch each other; the copy under another id is short of a block and stays.
    assert len(by[1]) == 2 and by[9][0].text == edge.LONG and 40 not in by and len(by[None]) == 2 and len(by[3]) == 2
    noted = L.dedup(df, note="blocks", drop_empty=False)
    counts = {r.doc_id: r.blocks for r in noted.collect()}
    assert counts[40] > 0 and counts[9] == 0 and noted.count() == len(edge.ROWS) + 2
    assert L.dedup(edge.empty(spark)).collect() == []


@pytest.mark.parametrize("text", ["", "a", "One. Two. Three four five six.", "no end", "a\nb\n\nc d e f\n", "x " * 100])
def test_lines_lie_in_order_inside_the_text(text):
    lines = L.lines_of(text)
    assert all(0 <= a < b <= len(text) for a, b, _, _ in lines) and all(x[1] <= y[0] for x, y in zip(lines, lines[1:]))
    assert all(n == len(text[a:b].split()) >= L.LINE_WORDS for a, b, n, _ in lines)


def linked(places, words):
    return [{"at": a, "line": a, "first": 0, "first_at": b, "words": words[a], "once": 1} for a, b in places]


def test_blocks_by_brute_force():
    """Of a pair of documents, every stretch of shared lines in the same distance that has enough words goes,
    but for lines that a stretch before it took, and nothing else does."""
    rnd = random.Random(12)
    for _ in range(300):
        n = rnd.randint(1, 14)
        there = list(range(n))
        for _ in range(rnd.randrange(3)):
            a, b = sorted(rnd.sample(range(n + 1), 2))
            there = there[b:] + there[a:b] + there[:a]
        words = [rnd.randint(3, 9) for _ in range(n)]
        got = {i for block in L.blocks(linked(enumerate(there), words)) for i in block}
        want, a = set(), 0
        while a < n:
            b = a + 1
            while b < n and there[b] == there[b - 1] + 1:
                b += 1
            if sum(words[a:b]) >= L.BLOCK_WORDS:
                want.update(range(a, b))
            a = b
        assert want <= got
        # More only as bridges between lines on one distance.
        for i in got - want:
            assert any(there[j] - j == there[k] - k and j < k <= j + L.BRIDGE_LINES + 1 and j <= i <= k for j in got for k in got)


def test_reversed_lists_take_no_longer_than_sorted_ones():
    import time

    n = 100_000
    start = time.monotonic()
    assert L.blocks(linked(((a, n - 1 - a) for a in range(n)), [4] * n)) == []
    assert time.monotonic() - start < 30
    assert sum(map(len, L.blocks(linked(((a, a) for a in range(n)), [4] * n)))) == n


def test_lines_of_many_texts_are_those_of_each(monkeypatch):
    rnd = random.Random(13)
    table = L.character_table()
    for size in (1 << 20, 300):
        monkeypatch.setattr(L, "_PIECE", size)
        monkeypatch.setattr(L, "_TOGETHER", size)
        for _ in range(30):
            texts = [rnd.choice(["", " ", "a b", "\n", "x", " one two three "]) if rnd.random() < 0.4 else
                     rnd.choice(["", "\n ", "漢字仮名"]) + sentences(rnd, rnd.randint(1, 6), rnd.randint(1, 12)) + rnd.choice(["", " ", "\n\n"])
                     for _ in range(rnd.randint(0, 12))]
            counts, *columns = L.lines_of_all(texts, table)
            got = list(zip(*(c.tolist() for c in columns)))
            want = [[(a, n, h, b) for a, b, n, h in L.lines_of(t)] for t in texts]
            assert counts.tolist() == [len(x) for x in want] and got == [x for t in want for x in t]


def test_sequences_are_told_apart_by_their_lines():
    rnd = random.Random(14)
    lines = [rnd.randrange(-(2**63), 2**63) for _ in range(6)]
    seen = {}
    for _ in range(200):
        picked = [{"at": i, "line": rnd.choice(lines), "words": rnd.randint(4, 9)} for i in range(12)]
        for a, b, h in L.sequences(picked):
            key = tuple(x["line"] for x in picked[a:b])
            assert seen.setdefault(key, h) == h
    assert len(set(seen.values())) == len(seen)


def test_blocks_of_a_batch_are_those_of_each_document():
    """Lines of documents in random places of several earlier ones: all of a batch at once, and one by one."""
    import pyarrow as pa

    rnd = random.Random(15)
    kind = pa.list_(pa.struct([(n, pa.int64()) for n in ("at", "line", "first", "first_at", "words", "once")]))
    for _ in range(60):
        docs = []
        for _ in range(rnd.randint(1, 6)):
            links, there = [], 0
            for at in range(rnd.randint(0, 40)):
                if rnd.random() < 0.1:
                    there = rnd.randrange(50)
                there += 1
                if rnd.random() < 0.9:
                    links.append({"at": at, "line": at, "first": rnd.choice([3, 3, 3, 4]), "first_at": there, "words": rnd.randint(3, 9),
                                  "once": int(rnd.random() < 0.8)})
            docs.append(rnd.sample(links, len(links)))
        got = L.Links(pa.array(docs, kind)).blocks()
        for d, links in enumerate(docs):
            ordered = sorted(links, key=lambda x: x["at"])
            assert sum(map(len, got.get(d, []))) == len({i for b in got.get(d, []) for i in b})
            one, many = ({i for b in x for i in b} for x in (L.blocks(ordered), got.get(d, [])))
            assert one == many
