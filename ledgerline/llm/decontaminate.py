"""Benchmark decontamination with a generalised suffix automaton over test items.

Words are lower-cased runs of letters, digits and non-ASCII characters. The automaton
accepts every run of words of every item; each document's words are streamed through it
and at each word the longest run that ends there and occurs in an item is known. A run of
``window`` words, or a whole shorter item, is a hit, and all its words are marked.

The automaton of one shard of items has at most twice as many states as the shard has
words. Shards are cut at a fixed number of words and tasks work on a fixed number of them
at a time, so a growing benchmark means more passes and not a larger automaton.

Defined results: null and empty texts have no words and no hits; null items and items
without words hit nothing; repeated items count once per distinct item_id; repeated
documents get repeated results; an empty benchmark leaves every document clean. Other
columns, whatever their names, pass through ``remove`` and are ignored by ``match``.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import Any

from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import fresh, rewrite_text, with_notes
from ledgerline.session import materialize

WINDOW = 10
SHARD_WORDS = 100_000
SHARDS_AT_ONCE = 2
MAX_COVERAGE = 0.8

# Bytes that end a word, as fixed by the definition of a word.
_SEPARATORS = [*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)]
_WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
_LOWER = {c: c + 32 for c in range(0x41, 0x5B)}


def _word_table() -> bytes:
    """A byte map that lower-cases A-Z and turns every separator into a space."""
    table = bytearray(range(256))
    for b in _SEPARATORS:
        table[b] = 0x20
    for b in range(0x41, 0x5B):
        table[b] = b + 0x20
    return bytes(table)


def words_of(text: str | None, table: bytes) -> list[bytes]:
    return (text or "").encode().translate(table).split()


def automaton(items: list[tuple[str, list[bytes]]], window: int = WINDOW) -> dict[str, Any]:
    """The suffix automaton of the items as plain lists.

    ``long_of[state]``: the state that stands for the last ``window`` words of a match of at
    least that length, or -1. ``short[state]``: shorter whole items that end a match here, as
    (length, items). ``items_of[state]``: items that contain a window state's words.
    """
    after: list[dict[bytes, int]] = [{}]
    link, length = [-1], [0]
    ends: list[tuple[int, str]] = []

    def extend(last: int, word: bytes) -> int:
        if word in after[last]:
            q = after[last][word]
            if length[q] == length[last] + 1:
                return q
            return clone(last, word, q)
        state = len(after)
        after.append({})
        link.append(0)
        length.append(length[last] + 1)
        p = last
        while p >= 0 and word not in after[p]:
            after[p][word] = state
            p = link[p]
        if p >= 0:
            q = after[p][word]
            link[state] = q if length[q] == length[p] + 1 else clone(p, word, q)
        return state

    def clone(p: int, word: bytes, q: int) -> int:
        copy = len(after)
        after.append(dict(after[q]))
        link.append(link[q])
        length.append(length[p] + 1)
        link[q] = copy
        while p >= 0 and after[p].get(word) == q:
            after[p][word] = copy
            p = link[p]
        return copy

    distinct = {w: w for _, words in items for w in words}
    for _, words in items:
        state = 0
        for word in words:
            state = extend(state, distinct[word])
        ends.append((state, words))

    n = len(after)
    by_length = sorted(range(1, n), key=length.__getitem__)
    long_of = [-1] * n
    for state in by_length:
        if length[state] >= window:
            up = link[state]
            long_of[state] = state if length[up] < window else long_of[up]
    items_of: dict[int, set[str]] = {}
    short_at: dict[int, tuple[int, set[str]]] = {}
    for name, words in items:
        state = 0
        for word in words:
            state = after[state][word]
            # The whole prefix is matched here, so its last ``window`` words are, too.
            if long_of[state] >= 0:
                items_of.setdefault(long_of[state], set()).add(name)
        if 0 < len(words) < window:
            short_at.setdefault(state, (len(words), set()))[1].add(name)
    short: dict[int, list[tuple[int, set[str]]]] = {}
    for state in by_length:
        found = list(short.get(link[state], ()))
        if state in short_at:
            found.append(short_at[state])
        if found:
            short[state] = found
    return {
        "after": after, "link": link, "length": length, "long_of": long_of,
        "items_of": {s: sorted(x) for s, x in items_of.items()}, "short": short, "window": window,
    }


def longest_matches(words: list[bytes], sam: dict[str, Any]) -> Iterator[tuple[int, int, int]]:
    """(position, state, length of the longest run of item words that ends there), where there is one."""
    after, link, length = sam["after"], sam["link"], sam["length"]
    root = after[0]
    state = matched = 0
    here = root
    for at, word in enumerate(words):
        if word in here:
            state = here[word]
            matched += 1
        elif state:
            while state and word not in after[state]:
                state = link[state]
            matched = length[state]
            if word in after[state]:
                state = after[state][word]
                matched += 1
        else:
            continue
        here = after[state]
        if matched:
            yield at, state, matched


def hits(words: list[bytes], sam: dict[str, Any]) -> tuple[list[tuple[int, int]], set[str]]:
    """Half-open word ranges inside occurring windows, in order and disjoint, and the items hit."""
    window, long_of, short = sam["window"], sam["long_of"], sam["short"]
    ranges: list[tuple[int, int]] = []
    states: set[int] = set()
    small: set[str] = set()
    for at, state, matched in longest_matches(words, sam):
        reach = 0
        if matched >= window:
            reach = matched
            states.add(long_of[state])
        if short and state in short:
            for size, names in short[state]:
                if size <= matched:
                    reach = max(reach, size)
                    small |= names
        if reach:
            start, end = at + 1 - reach, at + 1
            while ranges and ranges[-1][1] >= start:
                start = min(start, ranges.pop()[0])
            ranges.append((start, end))
    return ranges, small.union(*[sam["items_of"][s] for s in states])


def shards(benchmark: DataFrame, item_id: str = "item_id", text: str = "text") -> list[Broadcast]:
    """The items' words, cut into shards of about SHARD_WORDS words.

    Items come to the driver one at a time and leave it as broadcasts of bounded size; the
    automaton itself is built once per Python worker.
    """
    spark = benchmark.sparkSession
    table = _word_table()
    found: list[Broadcast] = []
    current: dict[str, set[tuple[bytes, ...]]] = {}
    size = 0

    def flush() -> None:
        items = [(name, list(words)) for name, texts in sorted(current.items()) for words in sorted(texts)]
        found.append(spark.sparkContext.broadcast({"items": items}))

    rows = benchmark.select(F.col(item_id).cast("string").alias("i"), F.col(text).alias("t")).where("t IS NOT NULL AND i IS NOT NULL")
    for row in rows.toLocalIterator(prefetchPartitions=False):
        words = tuple(words_of(row.t, table))
        if words:
            current.setdefault(row.i, set()).add(words)
            size += len(words)
        if size >= SHARD_WORDS:
            flush()
            current, size = {}, 0
    if current:
        flush()
    return found


def _built(shard: Broadcast, window: int) -> dict[str, Any]:
    held = shard.value
    if window not in held:
        held[window] = automaton(held["items"], window)
    return held[window]


def _merged(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for start, end in sorted(ranges):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def _marks(text: str | None, before: list[dict[str, int]], sams: list[dict[str, Any]], table: bytes) -> tuple[int, list[tuple[int, int]], set[str]]:
    """Number of words, ranges hit, those of earlier passes included, and the items that hit in this pass."""
    words = words_of(text, table)
    got, found = [(r["start"], r["end"]) for r in before], set()
    for sam in sams:
        more, others = hits(words, sam)
        got = _merged([*got, *more]) if got else more
        found |= others
    return len(words), got, found


def _mark(df: DataFrame, some: list[Broadcast], window: int, text: str, names: list[str], first: bool) -> DataFrame:
    """``df`` and three columns: number of words, word ranges that are hit (end exclusive), items; or these with
    what ``some`` shards add to them."""
    n_words, spans, items = names
    kind = f"`{n_words}` long, `{spans}` array<struct<start: int, end: int>>, `{items}` array<string>"
    table = _word_table()

    def each(batches: Iterator[list[list]]) -> Iterator[list[list]]:
        sams = [_built(p, window) for p in some]
        for texts, *before in batches:
            counts, ranges, found = [], [], []
            for i, doc in enumerate(texts):
                n, got, hit = _marks(doc, [] if first else before[0][i], sams, table)
                counts.append(n)
                ranges.append([{"start": a, "end": b} for a, b in got])
                found.append(sorted(hit if first else hit.union(before[1][i])))
            yield [counts, ranges, found]

    if first:
        return with_notes(df, [text], kind, each)
    old = fresh(df, "spans", "items")
    renamed = df.withColumnsRenamed(dict(zip([spans, items], old))).drop(n_words)
    return with_notes(renamed, [text, *old], kind, each).drop(*old)


def _before_last(docs: DataFrame, parts: list[Broadcast], window: int, text: str, names: list[str]) -> tuple[DataFrame, list[Broadcast], bool]:
    """``docs`` after all passes but the last, the last one's shards, and whether it is the first one, too.

    Documents pass SHARDS_AT_ONCE shards at a time. A benchmark beyond that takes further
    passes, each over a stored copy, so no task ever holds more automata than that.
    """
    at = 0
    while at + SHARDS_AT_ONCE < len(parts):
        docs = materialize(_mark(docs, parts[at : at + SHARDS_AT_ONCE], window, text, names, at == 0), "marked")
        at += SHARDS_AT_ONCE
    return docs, parts[at:], at == 0


def annotate(docs: DataFrame, benchmark: DataFrame, window: int, text: str, names: list[str]) -> DataFrame:
    """``docs`` and three columns: number of words, word ranges that are hit (end exclusive), items."""
    marked, last, first = _before_last(docs, shards(benchmark), window, text, names)
    return _mark(marked, last, window, text, names, first)


def match(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: key, n_words, spans (array of word ranges that are hit, end exclusive) and items."""
    given = docs.select(F.col(key).alias(key), F.col(text).alias("_text"))
    return annotate(given, benchmark, window, "_text", ["n_words", "spans", "items"]).drop("_text")


def remove(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, max_coverage: float = MAX_COVERAGE) -> DataFrame:
    """Documents without the spans that are hit; those of which more than ``max_coverage`` is hit go.

    A span's characters go with it, from the start of its first word to that of the next
    word, so the words around it stay apart. The last pass marks and cuts at once: a second
    pass behind it would keep a second Python worker per task.
    """
    names = fresh(docs, "n_words", "spans", "items")
    table = _word_table()
    marked, last, first = _before_last(docs, shards(benchmark), window, "text", names)

    def clean(doc: str, before: list[dict[str, int]] = []) -> str | None:
        n_words, spans, _ = _marks(doc, before, [_built(p, window) for p in last], table)
        if not spans:
            return doc
        if sum(b - a for a, b in spans) > max_coverage * n_words:
            return None
        starts = [m.start() for m in _WORD.finditer(doc.translate(_LOWER))] + [len(doc)]
        kept, at = [], 0
        for a, b in spans:
            kept.append(doc[at : starts[a]])
            at = starts[b]
        return "".join([*kept, doc[at:]])

    if first:
        return rewrite_text(marked, [], clean, drop_none=True)
    return rewrite_text(marked.drop(names[0], names[2]), [names[1]], clean, drop_none=True)


def digests(matched: DataFrame, key: str = "doc_id") -> DataFrame:
    """Per document: key, n_words, n_hit, n_items, items_sha256 and contaminated, from ``match``."""
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda total, r: total + (r["end"] - r["start"]))
    return matched.select(
        key, "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"),
    )
