import random

import edge
import numpy as np

from ledgerline.llm import langid as K

PARTS = {
    "en": "the ing tion and er with ly th ea ou sh".split(),
    "de": "der ein ung sch ver keit ich ä ü tz ge".split(),
    "fr": "les eau que é è ou ment oi aux ç tion".split(),
}


def text(rnd, lang, n):
    return " ".join("".join(rnd.choice(PARTS[lang]) for _ in range(rnd.randint(1, 3))) for _ in range(n))


def corpus(n=240):
    rnd = random.Random(0)
    langs = [rnd.choice(["en", "en", "en", "de", "fr"]) for _ in range(n)]
    return [text(rnd, lang, rnd.randint(4, 120)) for lang in langs], langs


def test_held_out_accuracy(spark):
    texts, langs = corpus()
    docs = edge.simple(spark, texts, langs)
    rows = K.predict(docs.select("doc_id", "text"), K.fit(docs)).withColumn("h", K.held_out()).where("h").collect()
    assert len(rows) > 25 and sum(r.lang_pred == langs[r.doc_id] for r in rows) >= 0.97 * len(rows)
    assert all(0 <= r.score <= 1 for r in rows)


def test_kernel_by_definition():
    letters = K.letter_table()
    a, b = "Straße 12", "strasse, Straße"
    grams = [K.ngrams(a, letters), K.ngrams(b, letters)]

    def exact(t):
        t = f" {' '.join(''.join(c if c.isalpha() else ' ' for c in t.lower()).split())} "
        return {t[i : i + n] for n in range(1, K.SPECTRUM + 1) for i in range(len(t) - n + 1)}

    one, two = exact(a), exact(b)
    # Hashed places may fall together, which few texts are long enough for.
    assert abs(len(grams[0]) - len(one)) <= 1 and abs(len(grams[1]) - len(two)) <= 1
    got = K.kernel(grams, K.presence([grams[1]]).T.copy(), np.array([len(grams[1])], np.float32))
    assert abs(got[0, 0] - len(one & two) / (len(one) * len(two)) ** 0.5) < 0.05 and abs(got[1, 0] - 1) < 1e-6


def test_held_out_labels_are_not_read(spark):
    from zlib import crc32

    texts, langs = corpus(120)
    turned = [("xx" if crc32(str(i).encode()) % 5 == 0 else lang) for i, lang in enumerate(langs)]
    found = []
    for labels in (langs, turned):
        docs = edge.simple(spark, texts, labels)
        found.append({r.doc_id: (r.lang_pred, round(r.score, 4)) for r in K.predict(docs.select("doc_id", "text"), K.fit(docs)).collect()})
    assert found[0] == found[1]


def test_samples_are_bounded(spark, monkeypatch):
    texts, langs = corpus(200)
    rows, counts = K._labelled(edge.simple(spark, texts, langs))
    sample = K._sample(rows, counts, 12, 1).groupBy("lang").count().collect()
    assert {r.lang for r in sample} == {"en", "de", "fr"} and all(r["count"] <= 4 for r in sample)


def test_awkward_documents(spark):
    df = edge.docs(spark)
    names = ("lang_pred", "score_")
    rows = K.predict(df, K.fit(df), names).collect()
    assert len(rows) == len(edge.ROWS)
    for r in rows:
        lettered = any(c.isalpha() for c in r.text or "")
        assert (r.lang_pred == "und") == (not lettered) and (lettered or r.score_ == 0) and r.score == "s"
    kept = K.known_language(df, K.fit(df), names)
    assert kept.columns == df.columns and all(any(c.isalpha() for c in r.text) for r in kept.collect())


def test_without_labels(spark):
    docs = edge.simple(spark, ["some text", None])
    assert [(r.lang_pred, r.score) for r in K.predict(docs.select("text"), K.fit(docs)).collect()] == [("und", 0.0)] * 2
    assert K.predict(edge.empty(spark).select("text"), K.fit(edge.empty(spark))).collect() == []


def test_very_long_texts_keep_label_and_score(spark):
    rnd = random.Random(13)
    texts, langs = corpus()
    model = K.fit(edge.simple(spark, texts, langs))
    # Letters that no landmark has fill the n-grams, as those of a long text of a large script do.
    rare = "".join(chr(rnd.randrange(0x4E00, 0x9FFF)) for _ in range(60_000))
    long = [text(rnd, lang, 60_000) for lang in ("en", "de", "fr")]
    asked = [long[0], long[1], long[2], long[0][:2000], long[1] + " " + rare]
    rows = sorted(K.predict(edge.simple(spark, asked).select("doc_id", "text"), model).collect(), key=lambda r: r.doc_id)
    assert [r.lang_pred for r in rows] == ["en", "de", "fr", "en", "de"]
    assert all(r.score > 0.5 for r in rows[:4]) and rows[4].score > K.MIN_SCORE
    letters = K.letter_table()
    assert len(K.ngrams(rare, letters)) > 150_000


def test_every_label_is_learnt(spark):
    rnd = random.Random(14)
    n = 70
    script = {f"l{i:02}": [chr(0x4E00 + 20 * i + k) for k in range(20)] for i in range(n)}
    texts, langs = [], []
    for i, (lang, letters) in enumerate(sorted(script.items()) * 6):
        texts.append("".join(rnd.choice(letters) for _ in range(80)))
        langs.append(lang)
    docs = edge.simple(spark, texts, langs)
    model = K.fit(docs)
    assert model.value["langs"] == sorted(script)
    rows = K.predict(docs.select("doc_id", "text"), model).collect()
    assert sum(r.lang_pred == langs[r.doc_id] for r in rows) >= 0.97 * len(rows)
