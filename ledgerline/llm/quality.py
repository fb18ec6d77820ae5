"""Quality classifier: a generalised additive model with pairwise interactions.

Every text is described by a few statistics of its whole length. The model has a lookup table
for each statistic over its quantile bins and one for each of the PAIRS strongest pairs of
statistics over coarser bins. Tables are learnt by cyclic gradient boosting: in turn, each
statistic (then each pair) adds a shrunken shallow tree fitted to what all others leave
unexplained. A score is a sum of one entry per table through the logistic function, computed
for a batch of texts as vectorised additions.

Learning takes at most TRAINING labelled rows outside the held-out fold, chosen by a hash of
the id; labels, lang, source and ids are never inputs of a score.

Defined results: null counts as empty, and an empty text has a score like any other; without
labels of both kinds the score is their share, 0.5 without any; labels other than 0 and 1 and
null labels are ignored; several labels of one id each count; a null id is held out; repeated
rows get repeated results; other columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from itertools import combinations
from typing import Any

import numpy as np
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import bounded_sample, held_out, map_rows
from ledgerline.session import materialize

TRAINING = 20_000
THRESHOLD = 0.3
BINS = 48
PAIR_BINS = 8
PAIRS = 8
ROUNDS = 200
RATE = 0.1
MIN_ROWS = 5
FEATURES = [
    "chars", "words", "word_length", "letters", "digits", "upper", "marks", "odd_marks", "lines", "line_words",
    "repeated_lines", "distinct_words", "top_word", "short_words", "marked_words", "upper_words", "sentence_words",
    "repeated_runs", "entropy", "links", "longest_word", "mixed_words", "repeat_neighbours",
]
_MARKS = re.compile(r"[^\w\s]")
_ODD = re.compile(r"[^\w\s.,;:!?'\"()\-]")
_ENDS = re.compile(r"[.!?]+")
_LINK = re.compile(r"https?:|www\.|@")


def describe(text: str | None) -> list[float]:
    """The statistics of a text, in the order of FEATURES."""
    text = text or ""
    words = text.split()
    n, w = len(text), len(words)
    if not w:
        return [math.log1p(n)] + [0.0] * (len(FEATURES) - 1)
    lower = [x.lower() for x in words]
    counts = Counter(lower)
    lines = [x for x in text.split("\n") if x.strip()]
    line_counts = Counter(lines)
    runs = Counter(zip(lower, lower[1:], lower[2:]))
    letters = Counter(text.lower())
    shares = np.fromiter(letters.values(), np.float64, len(letters)) / max(1, letters.total())
    alpha = sum(c for x, c in letters.items() if x.isalpha())
    digits = sum(c for x, c in letters.items() if x.isdigit())
    odd = len(_ODD.findall(text))
    upper = sum(map(str.isupper, words))
    return [
        math.log1p(n), math.log1p(w), sum(map(len, words)) / w, alpha / n, digits / n,
        sum(1 for x in words if x[:1].isupper()) / w, len(_MARKS.findall(text)) / n, odd / n, math.log1p(len(lines)), w / max(1, len(lines)),
        1 - len(line_counts) / max(1, len(lines)), len(counts) / w, max(counts.values()) / w,
        sum(1 for x in words if len(x) <= 3) / w, sum(1 for x in words if not x[-1].isalnum()) / w, upper / w,
        w / (1 + len(_ENDS.findall(text))), 1 - len(runs) / max(1, w - 2), float(-(shares * np.log(shares)).sum()),
        len(_LINK.findall(text)) / w, math.log1p(max(map(len, words))),
        sum(1 for x in words if not x.isalpha() and x.isalnum()) / w, sum(map(str.__eq__, lower, lower[1:])) / w,
    ]


def features(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: id and its statistics."""

    def each(batches: Iterator[dict[str, list]]) -> Iterator[dict[str, Any]]:
        for batch in batches:
            yield {"id": batch["id"], "x": [describe(t) for t in batch["text"]]}

    kind = docs.schema[key].dataType.simpleString()
    return map_rows(docs.select(F.col(key).alias("id"), F.col(text).alias("text")), each, f"id {kind}, x array<double>")


def _bins(values: np.ndarray, edges: np.ndarray) -> np.ndarray:
    return np.searchsorted(edges, values, side="right")


def _edges(values: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(values, np.linspace(0, 1, bins + 1)[1:-1]))


def _split(grad: np.ndarray, hess: np.ndarray, count: np.ndarray) -> tuple[float, int]:
    """The gain and place of the best cut of ordered bins, 0 if none is allowed."""
    g, h, c = grad.cumsum(), hess.cumsum(), count.cumsum()
    ok = (c >= MIN_ROWS) & (c[-1] - c >= MIN_ROWS)
    gain = np.where(ok, g**2 / (h + 1) + (g[-1] - g) ** 2 / (h[-1] - h + 1) - g[-1] ** 2 / (h[-1] + 1), -np.inf)
    at = int(gain[:-1].argmax()) if len(gain) > 1 else 0
    return (float(gain[at]), at + 1) if len(gain) > 1 and gain[at] > 0 else (0.0, 0)


def _tree(grad: np.ndarray, hess: np.ndarray, count: np.ndarray, leaves: int = 3) -> np.ndarray:
    """A shallow tree over ordered bins, as the value of each bin."""
    parts = [(0, len(grad))]
    while len(parts) < leaves:
        found = [(*_split(grad[a:b], hess[a:b], count[a:b]), a, b) for a, b in parts]
        gain, at, a, b = max(found)
        if not at:
            break
        parts.remove((a, b))
        parts += [(a, a + at), (a + at, b)]
    out = np.zeros(len(grad))
    for a, b in parts:
        out[a:b] = grad[a:b].sum() / (hess[a:b].sum() + 1)
    return out


def _pair_tree(grad: np.ndarray, hess: np.ndarray, count: np.ndarray) -> tuple[float, np.ndarray]:
    """The better tree that cuts one side of a grid and then each part along the other; its gain and values."""
    best, values = 0.0, np.zeros_like(grad)
    for turned in (False, True):
        g, h, c = (x.T if turned else x for x in (grad, hess, count))
        for at in range(1, len(g)):
            out, gain = np.zeros_like(g), 0.0
            for rows in (slice(0, at), slice(at, None)):
                gs, hs, cs = g[rows].sum(0), h[rows].sum(0), c[rows].sum(0)
                more, cut = _split(gs, hs, cs)
                gain += more + gs.sum() ** 2 / (hs.sum() + 1)
                for columns in ((slice(0, cut), slice(cut, None)) if cut else (slice(None),)):
                    out[rows, columns] = gs[columns].sum() / (hs[columns].sum() + 1)
            if gain > best:
                best, values = gain, out.T.copy() if turned else out
    return best, values


def learn(x: np.ndarray, y: np.ndarray) -> dict[str, Any]:
    """The model's tables from statistics and labels 0 or 1."""
    share = (y.sum() + 0.5) / (len(y) + 1)
    base = math.log(share / (1 - share))
    model: dict[str, Any] = {"base": base, "edges": [], "tables": [], "pairs": []}
    if not 0 < y.sum() < len(y):
        return model
    f = np.full(len(y), base)
    edges = [_edges(column, BINS) for column in x.T]
    coarse = [_edges(column, PAIR_BINS) for column in x.T]
    bins = [_bins(column, e) for column, e in zip(x.T, edges)]
    coarse_bins = [_bins(column, e) for column, e in zip(x.T, coarse)]
    counts = [np.bincount(b, minlength=len(e) + 1) for b, e in zip(bins, edges)]
    tables = [np.zeros(len(e) + 1) for e in edges]

    def slopes() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-f))
        return y - p, p * (1 - p)

    for _ in range(ROUNDS):
        for i, b in enumerate(bins):
            g, h = slopes()
            size = len(tables[i])
            step = RATE * _tree(np.bincount(b, g, size), np.bincount(b, h, size), counts[i])
            tables[i] += step
            f += step[b]
    grids = {}
    for i, j in combinations(range(x.shape[1]), 2):
        shape = (len(coarse[i]) + 1, len(coarse[j]) + 1)
        grids[i, j] = (shape, coarse_bins[i] * shape[1] + coarse_bins[j])

    def grid(values: np.ndarray | None, pair: tuple[int, int]) -> np.ndarray:
        shape, cell = grids[pair]
        return np.bincount(cell, values, shape[0] * shape[1]).reshape(shape)

    g, h = slopes()
    gains = {pair: _pair_tree(grid(g, pair), grid(h, pair), grid(None, pair))[0] for pair in grids}
    chosen = sorted(gains, key=lambda pair: (-gains[pair], pair))[:PAIRS]
    pair_tables = {pair: np.zeros(grids[pair][0]) for pair in chosen}
    pair_counts = {pair: grid(None, pair) for pair in chosen}
    for _ in range(ROUNDS // 4):
        for pair in chosen:
            g, h = slopes()
            step = RATE * _pair_tree(grid(g, pair), grid(h, pair), pair_counts[pair])[1]
            pair_tables[pair] += step
            f += step.reshape(-1)[grids[pair][1]]
    model["edges"], model["tables"] = edges, tables
    model["pairs"] = [(i, j, coarse[i], coarse[j], pair_tables[i, j]) for i, j in chosen]
    return model


def score(x: np.ndarray, model: dict[str, Any]) -> np.ndarray:
    """Scores from 0 to 1 of a batch of statistics."""
    f = np.full(len(x), model["base"])
    for column, edges, table in zip(x.T, model["edges"], model["tables"]):
        f += table[_bins(column, edges)]
    for i, j, first, second, table in model["pairs"]:
        f += table[_bins(x[:, i], first), _bins(x[:, j], second)]
    return 1 / (1 + np.exp(-f))


def fit(described: DataFrame, labels: DataFrame, label: str = "quality") -> Broadcast:
    """The model, learnt from the statistics of labelled documents outside the held-out fold."""
    sc = described.sparkSession.sparkContext
    y = labels.select(F.col("doc_id").alias("id"), F.col(label).cast("int").alias("y")).where("y IN (0, 1)").where(~held_out("id"))
    rows = bounded_sample(y, "id", TRAINING, y.count(), 2).join(described, "id").orderBy("id", "y").limit(2 * TRAINING).collect()
    if not rows:
        return sc.broadcast({"base": 0.0, "edges": [], "tables": [], "pairs": []})
    return sc.broadcast(learn(np.array([r.x for r in rows]), np.array([r.y for r in rows], np.float64)))


def rate(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: key, held_out, score, and predicted: 1 if the score is THRESHOLD or more."""
    described = materialize(features(docs, key, text), "features")
    model = fit(described, labels)

    def each(batches: Iterator[dict[str, list]]) -> Iterator[dict[str, Any]]:
        for batch in batches:
            found = score(np.array(batch["x"]).reshape(-1, len(FEATURES)), model.value)
            yield {"id": batch["id"], "score": found, "predicted": (found >= THRESHOLD).astype(np.int32)}

    kind = docs.schema[key].dataType.simpleString()
    rated = map_rows(described, each, f"id {kind}, score double, predicted int")
    return rated.select(F.col("id").alias(key), held_out("id").alias("held_out"), "score", "predicted")
