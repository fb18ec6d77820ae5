"""Language identification with a string kernel.

The kernel of two texts is the number of letter n-grams (n = 1 to SPECTRUM, presence only) they
share, over the geometric mean of how many each has: the blended-spectrum presence kernel, with
n-grams as 62-bit hashes. It is approximated with Nyström landmarks, texts drawn from every
language, and one ridge regression per language is fitted in that space. The landmarks' n-grams
lead to the landmarks that have them, which gives the kernel; kernel times weights gives the
languages. A text of more than PIECE characters has the mean kernel of its pieces, each weighted
by its n-grams, so label and score do not depend on length; a landmark is a text's first piece with letters.

Learning takes a bounded sample of labelled rows: at most LANDMARKS landmarks and TRAINING
texts in all, dealt evenly over the languages, chosen by a hash of the id. Every label with a text is
learnt: where there are many, each still gets LANDMARKS_EACH and TRAINING_EACH, and the sample grows.

Defined results: a null text or one without a letter is ``und`` with score 0; without any
labelled text every document is ``und``; ties go to the label first in the alphabet; a null id
is held out; repeated rows get repeated results; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

import numpy as np
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm.common import held_out, map_rows, quoted, with_notes

SPECTRUM = 4
PIECE = 1 << 14
LANDMARKS = 128
TRAINING = 2400
LANDMARKS_EACH = 2
TRAINING_EACH = 37
RIDGE = 1e-3
BATCH = 64
UNKNOWN = "und"
MIN_SCORE = 0.1
_SALTS = np.random.default_rng(7).integers(1, 2**62, SPECTRUM, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SPACE = 32


def letter_table() -> np.ndarray:
    """Which code points are letters."""
    return np.array([chr(c).isalpha() for c in range(0x110000)], np.bool_)


def ngrams(text: str | None, letters: np.ndarray) -> np.ndarray:
    """Hashes of the distinct n-grams of a text's letters, ascending, words parted by one space; none without letters."""
    points = np.frombuffer((text or "").lower().encode("utf-32-le"), np.uint32)
    is_letter = letters[points]
    if not is_letter.any():
        return np.empty(0, np.int64)
    keep = is_letter.copy()
    keep[1:] |= is_letter[:-1]
    body = np.where(is_letter, points, _SPACE)[keep]
    line = np.concatenate(([_SPACE], body, [] if body[-1] == _SPACE else [_SPACE])).astype(np.uint64)
    found = []
    code = line
    for n in range(1, min(SPECTRUM, len(line)) + 1):
        if n > 1:
            code = code[:-1] * np.uint64(0x110000) + line[n - 1 :]
        mixed = code * _SALTS[n - 1]
        found.append((mixed ^ (mixed >> np.uint64(29))) * _SALTS[n - 1] >> np.uint64(2))
    return np.unique(np.concatenate(found)).astype(np.int64)


def pieces(text: str | None, letters: np.ndarray) -> Iterator[np.ndarray]:
    """The n-grams of every piece of a text that has letters."""
    for at in range(0, len(text or ""), PIECE):
        grams = ngrams(text[at : at + PIECE], letters)
        if len(grams):
            yield grams


def presence(grams: list[np.ndarray]) -> np.ndarray:
    """A row of hashes for each text, filled up with -1."""
    out = np.full((len(grams), max(map(len, grams), default=0)), -1, np.int64)
    for row, hashes in zip(out, grams):
        row[: len(hashes)] = hashes
    return out


def postings(landmarks: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The hashes of all landmarks (a column each), ascending, where each one's landmarks begin, and the landmarks."""
    place, mark = np.nonzero(landmarks >= 0)
    hashes = landmarks[place, mark]
    order = np.argsort(hashes, kind="stable")
    known, starts = np.unique(hashes[order], return_index=True)
    return known, np.append(starts, len(order)), mark[order].astype(np.int32)


def kernel(grams: list[np.ndarray], landmarks: np.ndarray | tuple, sizes: np.ndarray) -> np.ndarray:
    """The kernel of every text with every landmark, given as columns of hashes or as ``postings``."""
    known, starts, marks = landmarks if isinstance(landmarks, tuple) else postings(landmarks)
    own = np.array([max(1, len(g)) for g in grams], np.float32)
    shared = np.zeros((len(grams), len(sizes)), np.float32)
    for row, hashes in zip(shared, grams):
        at = np.searchsorted(known, hashes)
        at = at[known[np.minimum(at, len(known) - 1)] == hashes] if len(known) else at[:0]
        many = starts[at + 1] - starts[at]
        ends = np.cumsum(many)
        if len(at):
            places = np.arange(ends[-1]) + np.repeat(starts[at] - ends + many, many)
            row += np.bincount(marks[places], minlength=len(sizes))
    return shared / np.sqrt(own[:, None] * sizes[None, :])


def kernel_of(texts: list[str | None], letters: np.ndarray, landmarks: tuple, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The mean kernel of every text's pieces, and whether it has letters."""
    out, known = np.zeros((len(texts), len(sizes)), np.float32), np.zeros(len(texts), np.bool_)
    for i, text in enumerate(texts):
        total = 0
        for grams in pieces(text, letters):
            out[i] += len(grams) * kernel([grams], landmarks, sizes)[0]
            total += len(grams)
        if total:
            out[i] /= total
            known[i] = True
    return out, known


def _labelled(docs: DataFrame) -> tuple[DataFrame, list[str]]:
    rows = docs.where(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}") & ~held_out())
    rows = rows.select("doc_id", "text", "lang")
    counts = rows.groupBy("lang").agg(F.count("*").alias("n")).collect()
    return rows, sorted((r.lang, r.n) for r in counts)


def _sample(rows: DataFrame, counts: list[tuple[str, int]], most: int, seed: int) -> DataFrame:
    """At most ``most`` texts, as many of each language as there are, chosen by a hash of the id."""
    share = max(1, most // len(counts))
    order = F.pmod(F.xxhash64(F.lit(seed), "doc_id"), F.lit(2**32))
    # Most rows fall out before any shuffle; the window then cuts to the exact bound.
    limits = [(lang, min(2**32, int(2**32 * (2 * share + 64) / n))) for lang, n in counts]
    limit = F.broadcast(rows.sparkSession.createDataFrame(limits, "lang string, most long"))
    first = Window.partitionBy("lang").orderBy(order, "doc_id")
    return rows.join(limit, "lang").where(order < F.col("most")).drop("most").withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= share).drop("rank")


def fit(docs: DataFrame) -> Broadcast:
    """Landmarks and weights, learnt from documents outside the held-out fold."""
    sc = docs.sparkSession.sparkContext
    rows, counts = _labelled(docs)
    if not counts:
        return sc.broadcast({"langs": []})
    langs = [lang for lang, _ in counts]

    def places(batches: Iterator[dict[str, list]]) -> Iterator[dict[str, Any]]:
        letters = letter_table()
        for batch in batches:
            yield {"lang": batch["lang"], "grams": [next(pieces(t, letters), np.empty(0, np.int64)) for t in batch["text"]]}

    drawn = map_rows(_sample(rows, counts, max(LANDMARKS, LANDMARKS_EACH * len(counts)), 1).select("lang", "text"), places, "lang string, grams array<long>")
    marks = [np.array(r.grams, np.int64) for r in drawn.orderBy("lang", F.hash("grams")).collect()]
    index, sizes = postings(presence(marks).T), np.array([max(1, len(g)) for g in marks], np.float32)
    held = sc.broadcast({"landmarks": index, "sizes": sizes})

    def rows_of_kernel(batches: Iterator[dict[str, list]]) -> Iterator[dict[str, Any]]:
        letters = letter_table()
        for batch in batches:
            yield {"lang": batch["lang"], "k": list(kernel_of(batch["text"], letters, held.value["landmarks"], held.value["sizes"])[0])}

    taught = map_rows(_sample(rows, counts, max(TRAINING, TRAINING_EACH * len(counts)), 2).select("lang", "text"), rows_of_kernel, "lang string, k array<float>")
    sample = taught.collect()
    k = np.array([r.k for r in sample], np.float64)
    own = kernel(marks, index, sizes).astype(np.float64)
    wanted = np.array([[r.lang == lang for lang in langs] for r in sample], np.float64)
    penalty = RIDGE * len(k) * (own + own.T) / 2 + 1e-6 * np.eye(len(marks))
    weights = np.linalg.lstsq(k.T @ k + penalty, k.T @ wanted, rcond=None)[0]
    return sc.broadcast({"langs": langs, "weights": weights.astype(np.float32), **held.value})


def _score(batches: Iterator[list[str | None]], model: dict[str, Any]) -> Iterator[tuple[list[str], list[float]]]:
    langs = model["langs"]
    if langs:
        letters = letter_table()
    for texts in batches:
        best, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
        for at in range(0, len(texts) if langs else 0, BATCH):
            found, lettered = kernel_of(texts[at : at + BATCH], letters, model["landmarks"], model["sizes"])
            for i, (has, row) in enumerate(zip(lettered, found @ model["weights"]), at):
                if has:
                    best[i] = langs[int(row.argmax())]
                    scores[i] = float(min(1.0, max(0.0, row.max())))
        yield best, scores


def predict(docs: DataFrame, model: Broadcast, names: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """``docs`` with the predicted language and its score from 0 to 1."""

    def each(batches: Iterator[list[list]]) -> Iterator[list[list]]:
        for best, scores in _score((texts for texts, in batches), model.value):
            yield [best, scores]

    return with_notes(docs, ["text"], f"`{names[0]}` string, `{names[1]}` double", each)


def known_language(docs: DataFrame, model: Broadcast, names: tuple[str, str]) -> DataFrame:
    """The documents whose language is told with a score of MIN_SCORE or more, in their own columns."""
    scored = predict(docs, model, names)
    return scored.where((F.col(names[0]) != UNKNOWN) & (F.col(names[1]) >= MIN_SCORE)).select(*map(quoted, docs.columns))
