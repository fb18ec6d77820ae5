"""Line dedup by pairwise alignment: passages that a document shares with an earlier one go.

A line ends where a sentence or a line of text does, and behind words whose hash says so. Of
ends that are fewer than LINE_WORDS words apart only one counts, the end of a sentence before
others and then the one with the lowest hash, so no line is shorter and what is cut depends on
the words next to it alone: a passage gives the same lines wherever it stands, but for its edges.
Lines tile the text from its first word on; only a text of fewer than LINE_WORDS words has none.
A character of a script that is written without spaces counts as a word here, and as half a
word in the length of a line.

Every line that occurs in several documents links each later one to the first that has it, so
there are as many links as occurrences, however many documents share the line, and none is
dropped for being common. A pair of documents is aligned with patience diff over the lines they
share through such links: where these stand in one order in both, that is the alignment; else lines that
occur once in both are put into the longest increasing sequence and neighbours extend it; what is left, passages that were moved, is aligned run by run. Aligned
lines that follow each other in both documents are a block; blocks of BLOCK_WORDS words or more are
deleted from the later document, so the earliest occurrence always stays. The time for a pair is in
proportion to its lines, but for a logarithm, in whatever order they are.

The lines of a passage may have their first places in many documents, none of which has the
passage. So the shortest sequences of repeated lines that have BLOCK_WORDS words, from every line
on and up to every line, are linked to the first document with the sequence as well: together
they cover every passage of that length, and what an earlier document has of them goes too.

Defined results: documents are ordered by id; a document without an id or text is left alone;
rows with the same id are not compared with each other and get the same cuts where their lines
are the same; an empty text or table stays empty; a very long text is read whole, piece by piece.
Other columns pass as they are.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterable, Iterator
from itertools import chain, pairwise
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import fresh, map_arrays, mix, quoted, rewrite_text
from ledgerline.session import materialize

LINE_WORDS = 3
CUT_EVERY = 8
BLOCK_WORDS = 16
BRIDGE_LINES = 2
# Thai, Lao, Myanmar, Khmer, kana, Han and the scripts beside them.
_UNSPACED = [
    (0x0E01, 0x0EFF), (0x1000, 0x109F), (0x1780, 0x17FF), (0x1950, 0x19DF), (0x1A20, 0x1AAF), (0x3001, 0x30FF), (0x31F0, 0x31FF),
    (0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xF900, 0xFAFF), (0xFF66, 0xFF9F), (0x20000, 0x3FFFF),
]
_GAP = re.compile(r"\s+")
_PIECE = 1 << 20
# Short texts are cut together up to so many characters, which fit into a processor's cache.
_TOGETHER = 1 << 17
_ODD = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_ODD), -1, 2**64))


def character_table() -> np.ndarray:
    """By code point: 0 for white space, 2 for scripts that are written without spaces, 3 for the end of a sentence, else 1."""
    table = np.ones(0x110000, np.uint8)
    for first, last in _UNSPACED:
        table[first : last + 1] = 2
    table[[c for c in range(0x3001) if chr(c).isspace()]] = 0
    table[[ord(c) for c in ".!?"]] = 3
    return table


def lines_of(text: str, table: np.ndarray | None = None) -> list[tuple[int, int, int, int]]:
    """(start, end, words, hash) of the lines that are compared, in order."""
    starts, words, hashes, ends = _lines(text, character_table() if table is None else table)
    return list(zip(starts.tolist(), ends.tolist(), words.tolist(), hashes.tolist()))


def _words(text: str, offset: int, table: np.ndarray) -> tuple[np.ndarray, ...]:
    """Start, hash, whether a line of text or a sentence ends behind it, and whether it is a
    single character of an unspaced script, of every word of a piece of text."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    kind = table[points]
    single = kind == 2
    inside = kind != 0
    begins = inside.copy()
    begins[1:] &= ~inside[:-1] | single[1:] | single[:-1]
    starts = np.flatnonzero(begins)
    if not len(starts):
        return starts, np.empty(0, np.uint64), np.empty(0, np.bool_), np.empty(0, np.bool_)
    # White space belongs to the word before it and counts for nothing.
    place = np.arange(len(points), dtype=np.uint64)
    first = np.repeat(starts, np.diff(starts, append=len(points)))
    place[starts[0] :] -= first.astype(np.uint64)
    each = mix((points.astype(np.uint64) + np.uint64(1)) * _ODD + place)
    each[~inside] = 0
    hashes = mix(np.add.reduceat(each, starts))
    newline = np.add.reduceat(points == 10, starts, dtype=np.int64) > 0
    lengths = np.add.reduceat(inside, starts, dtype=np.int64)
    return starts + offset, hashes, newline | (kind[starts + lengths - 1] == 3), single[starts]


def _pieces(text: str) -> Iterator[tuple[int, str]]:
    """The text in pieces that end at white space, so that memory follows _PIECE and the words' number."""
    at = 0
    while at < len(text):
        end = at + _PIECE
        if end < len(text):
            gap = _GAP.search(text, end)
            end = gap.end() if gap else len(text)
        yield at, text[at:end]
        at = end


def _lines(text: str, table: np.ndarray) -> tuple[np.ndarray, ...]:
    """Start, words, hash and end of the lines of one text, read piece by piece."""
    parts = [_words(piece, at, table) for at, piece in _pieces(text)] or [_words("", 0, table)]
    words = [np.concatenate(x) for x in zip(*parts)]
    return _tiled(*words, np.zeros(1, np.int64), np.array([len(text)]))[1:]


def lines_of_all(texts: list[str], table: np.ndarray) -> tuple[np.ndarray, ...]:
    """The number of lines of every text, and start, words, hash and end of all lines, text after text.

    Short texts are cut together, up to _TOGETHER characters at a time, long ones each by itself.
    """
    found, group, size = [], [], 0

    def together() -> None:
        lengths = np.array([len(t) for t in group], np.int64)
        offsets = np.cumsum(lengths + 1) - lengths - 1
        found.append(_tiled(*_words("\n".join(group), 0, table), offsets, lengths))

    for text in texts:
        if group and size + len(text) > _TOGETHER:
            together()
            group, size = [], 0
        if len(text) > _TOGETHER:
            alone = _lines(text, table)
            found.append((np.array([len(alone[0])]), *alone))
        else:
            group.append(text)
            size += len(text) + 1
    if group or not found:
        together()
    return tuple(np.concatenate(x) for x in zip(*found))


def _tiled(
    starts: np.ndarray, hashes: np.ndarray, stops: np.ndarray, single: np.ndarray, offsets: np.ndarray, lengths: np.ndarray
) -> tuple[np.ndarray, ...]:
    """Lines made of the words of texts that begin at ``offsets``: their number in each text, and
    start and end within it, words and hash of each."""
    none = np.empty(0, np.int64)
    if not len(starts):
        return np.zeros(len(offsets), np.int64), none, none, np.empty(0, np.uint64), none
    reach = LINE_WORDS - 1
    doc = np.searchsorted(offsets, starts, side="right") - 1
    many = np.bincount(doc, minlength=len(offsets))
    inside = np.arange(len(starts)) - (np.cumsum(many) - many)[doc]
    half = np.uint64(1 << 63)
    never = np.uint64(2**64 - 1)
    key = np.where(stops, hashes >> np.uint64(1), np.where(hashes % np.uint64(CUT_EVERY) == 0, hashes >> np.uint64(1) | half, never))
    cut = key != never
    for k in range(1, reach + 1):
        cut[k:] &= key[k:] < key[:-k]
        cut[:-k] &= key[:-k] <= key[k:]
    # The first and the last line are no shorter than others. So words of two texts are never weighed against each other.
    cut &= (inside >= reach) & (inside < many[doc] - LINE_WORDS)
    begins = inside == 0
    begins[1:] |= cut[:-1]
    first = np.flatnonzero(begins)
    sizes = np.diff(first, append=len(starts))
    place = np.arange(len(starts), dtype=np.uint64) - np.repeat(first, sizes).astype(np.uint64)
    found = mix(np.add.reduceat(mix(hashes + place * _ODD), first))
    halves = np.add.reduceat(single, first, dtype=np.int64)
    of = doc[first]
    ends = np.append(starts[first[1:]], 0)
    last = np.append(of[1:] != of[:-1], True)
    ends[last] = (offsets + lengths)[of[last]]
    kept = many[of] >= LINE_WORDS
    lines = (starts[first] - offsets[of], sizes - halves + halves // 2, found, ends - offsets[of])
    return np.bincount(of[kept], minlength=len(offsets)), *(x[kept] for x in lines)


def line_hashes(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: id, hashes of its lines, and for each its number of words, doubled, plus 1
    if the line occurs once in the document."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[list[pa.Array]]:
        table = character_table()
        for batch in batches:
            counts, _, sizes, own, _ = lines_of_all([t or "" for t in batch.column("text").to_pylist()], table)
            doc = np.repeat(np.arange(len(counts)), counts)
            order = np.lexsort((own, doc))
            same = (own[order[1:]] == own[order[:-1]]) & (doc[order[1:]] == doc[order[:-1]])
            once = np.ones(len(own), np.int64)
            once[order[1:][same]] = 0
            once[order[:-1][same]] = 0
            yield [batch.column("id"), _lists(counts, own.view(np.int64)), _lists(counts, (2 * sizes + once).astype(np.int32))]

    kind = docs.schema[key].dataType.simpleString()
    given = docs.select(F.col(key).alias("id"), F.col(text).alias("text")).where("id IS NOT NULL")
    return map_arrays(given, each, f"id {kind}, hashes array<long>, notes array<int>")


def _lists(counts: np.ndarray, values: np.ndarray) -> pa.ListArray:
    offsets = np.concatenate(([0], np.cumsum(counts))).astype(np.int32)
    return pa.ListArray.from_arrays(offsets, pa.array(values))


def _columns(lists: pa.ListArray) -> tuple[np.ndarray, list[pa.Array]]:
    """Of a column of arrays of structs: the row of every element, and the fields of all elements."""
    counts = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    return np.repeat(np.arange(len(lists)), counts), lists.flatten().flatten()


def shared_lines(lines: DataFrame) -> DataFrame:
    """(id, links, passages): for every document that has lines of earlier ones, those lines as
    (at, line, first, first_at, words, once), ``first`` being the first document with the line,
    and the (start, end) of sequences of lines that an earlier document has."""
    each = lines.select("id", F.explode("hashes").alias("line"))
    repeated = each.groupBy("line").agg(F.min("id").alias("first"), F.max("id").alias("last")).where("first < last").drop("last")
    # A stored side lets a join split the partition of a line that very many documents share.
    repeated = materialize(repeated, "repeated")
    placed = lines.select("id", "row", "notes", F.posexplode("hashes").alias("at", "line")).select(
        "id", "row", "at", "line", F.expr("notes[at]").alias("note")
    )
    found = materialize(placed.join(repeated, "line"), "repeated-lines")
    origin = found.where("id = first").groupBy("line").agg(
        F.min("at").alias("first_at"), F.min(F.col("note") % 2).alias("once_there")
    )
    later = found.where("id > first").join(materialize(origin, "origins"), "line")
    link = F.struct(
        "at", "line", "first", "first_at", F.shiftright("note", 1).alias("words"), (F.col("note") % 2 * F.col("once_there")).alias("once")
    )
    links = later.groupBy("id").agg(F.collect_list(link).alias("links"))
    return links.join(earlier_passages(found), "id", "left")


def _spans(doc: np.ndarray, at: np.ndarray, line: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, ...]:
    """First line, line behind the last, and hash, of the shortest sequences of neighbouring lines with
    BLOCK_WORDS words that begin or end with each line; lines are given by document and place, in order."""
    n = len(at)
    if not n:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64)
    breaks = np.flatnonzero((doc[1:] != doc[:-1]) | (at[1:] != at[:-1] + 1)) + 1
    runs = np.concatenate(([0], breaks))
    sizes = np.diff(runs, append=n)
    run_start, run_end = np.repeat(runs, sizes), np.repeat(runs + sizes, sizes)
    total = np.concatenate(([0], np.cumsum(words, dtype=np.int64)))
    here = np.arange(n)
    end = np.searchsorted(total, total[:-1] + BLOCK_WORDS)
    start = np.searchsorted(total, total[1:] - BLOCK_WORDS, side="right") - 1
    on, back = end <= run_end, start >= run_start
    both = np.unique(np.concatenate((here[on] * (n + 1) + end[on], start[back] * (n + 1) + here[back] + 1)))
    i, j = both // (n + 1), both % (n + 1)
    # Sums of the lines' hashes times powers of an odd number; those of the lines before are taken off again.
    powers = np.multiply.accumulate(np.concatenate((np.ones(1, np.uint64), np.full(n - 1, _ODD))))
    inverses = np.multiply.accumulate(np.concatenate((np.ones(1, np.uint64), np.full(n - 1, _INVERSE))))
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mix(line.view(np.uint64) + _ODD) * powers)))
    hashes = mix((sums[j] - sums[i]) * inverses[i] + (j - i).astype(np.uint64))
    return i, j, hashes.view(np.int64)


def sequences(lines: list[dict[str, int]]) -> Iterator[tuple[int, int, int]]:
    """(start, end, hash) of the shortest sequences of neighbouring lines with BLOCK_WORDS words that
    begin or end with each line. Any longer sequence of lines is covered by those inside it."""
    at, line, words = (np.array([x[name] for x in lines], np.int64) for name in ("at", "line", "words"))
    i, j, hashes = _spans(np.zeros_like(at), at, line, words)
    yield from zip(at[i].tolist(), (at[j - 1] + 1).tolist(), hashes.tolist())


def earlier_passages(found: DataFrame) -> DataFrame:
    """(id, passages): the sequences of repeated lines that a document with a lower id has as well."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[list[pa.Array]]:
        for batch in batches:
            doc, fields = _columns(batch.column("lines"))
            at, line, words = (x.to_numpy().astype(np.int64) for x in fields)
            order = np.lexsort((at, doc))
            doc, at = doc[order], at[order]
            i, j, hashes = _spans(doc, at, line[order], words[order])
            yield [batch.column("id").take(pa.array(doc[i])), pa.array(at[i]), pa.array(at[j - 1] + 1), pa.array(hashes)]

    # By row: rows with the same id are texts of their own.
    line = F.struct("at", "line", F.shiftright("note", 1).alias("words"))
    by_row = found.groupBy("row", "id").agg(F.collect_list(line).alias("lines")).drop("row")
    kind = found.schema["id"].dataType.simpleString()
    placed = materialize(map_arrays(by_row, each, f"id {kind}, start int, end int, passage long"), "passages")
    repeated = placed.groupBy("passage").agg(F.min("id").alias("first"), F.max("id").alias("last")).where("first < last").drop("last")
    later = placed.join(materialize(repeated, "repeated-passages"), "passage").where("id > first")
    return later.groupBy("id").agg(F.collect_list(F.struct("start", "end")).alias("passages"))


def longest_increasing(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Of (at, first_at), ascending in ``at``, a longest subsequence ascending in both."""
    tops: list[int] = []
    rows: list[int] = []
    back: list[int] = []
    for i, (_, there) in enumerate(pairs):
        pile = bisect_left(tops, there)
        if pile == len(tops):
            tops.append(there)
            rows.append(i)
        else:
            tops[pile] = there
            rows[pile] = i
        back.append(rows[pile - 1] if pile else -1)
    out, i = [], rows[-1] if rows else -1
    while i >= 0:
        out.append(pairs[i])
        i = back[i]
    return out[::-1]


def blocks(links: list[dict[str, Any]], passages: list[dict[str, int]] | None = None) -> list[list[int]]:
    """Positions of the lines to delete, a list for each block."""
    words, by_first, common = {}, {}, {}
    for x in links:
        words[x["at"]] = x["words"]
        by_first.setdefault(x["first"], {})[x["at"]] = x["first_at"]
        if x["once"]:
            common.setdefault(x["first"], set()).add(x["at"])
    out: list[list[int]] = []
    gone: set[int] = set()
    for first, places in by_first.items():
        # Also lines that come from elsewhere may stand inside a block.
        if sum(words[a] for a in places) >= BLOCK_WORDS // 2:
            _take(out, gone, _long(_aligned(places, common.get(first, set()), words), words))
    _add_passages(out, sorted((x["start"], x["end"]) for x in passages or ()))
    return out


def _aligned(places: dict[int, int], common: set[int], words: dict[int, int]) -> Iterator[list[int]]:
    """Runs of lines of a document that are aligned with one earlier document: patience diff over ``places``
    (line there by line here), ``common`` being the lines that occur once in both."""
    ordered = sorted(places.items())
    if all(x[1] < y[1] for x, y in pairwise(ordered)):
        return _runs(ordered, words)
    anchors = sorted((a, places[a]) for a in common if a in places) or ordered
    aligned = dict(longest_increasing(anchors))
    for step in (1, -1):
        for a in sorted(aligned, reverse=step < 0):
            b = aligned[a]
            while places.get(a + step) == b + step and a + step not in aligned:
                a, b = a + step, b + step
                aligned[a] = b
    # What does not fit into this order has been moved: each moved passage is a run of its own, on
    # lines that keep their distance to the first document's.
    moved = sorted(((a, b) for a, b in places.items() if a not in aligned), key=lambda x: (x[1] - x[0], x[0]))
    return chain(_runs(sorted(aligned.items()), words), _runs(moved, words))


def _long(runs: Iterator[list[int]], words: dict[int, int]) -> Iterator[list[int]]:
    return (run for run in runs if sum(words[a] for a in run) >= BLOCK_WORDS)


def _take(out: list[list[int]], gone: set[int], runs: Iterable[list[int]]) -> None:
    """Add the runs as blocks. Two of them may hold the same bridge, which then belongs to the first."""
    for run in runs:
        if block := [a for a in run if a not in gone]:
            out.append(block)
            gone.update(block)


class Links:
    """The links of a batch of documents, sorted by document and place."""

    def __init__(self, lists: pa.ListArray):
        doc, fields = _columns(lists)
        at, line, first, there, words, once = fields
        at = at.to_numpy().astype(np.int64)
        order = np.lexsort((at, doc))
        self.doc, self.at = doc[order], at[order]
        self.line, self.there, self.words, self.once = (x.to_numpy()[order].astype(np.int64) for x in (line, there, words, once))
        self.first = first.dictionary_encode().indices.to_numpy()[order].astype(np.int64)
        self.bounds = np.searchsorted(self.doc, np.arange(len(lists) + 1))
        # Rows of a repeated id may have several lines in one place.
        twice = (self.doc[1:] == self.doc[:-1]) & (self.at[1:] == self.at[:-1])
        self.repeated = set(self.doc[1:][twice].tolist())

    def of(self, doc: int) -> list[dict[str, int]]:
        here = slice(self.bounds[doc], self.bounds[doc + 1])
        columns = {"at": self.at, "first": self.first, "first_at": self.there, "words": self.words, "once": self.once}
        return [dict(zip(columns, x)) for x in zip(*(c[here].tolist() for c in columns.values()))]

    def blocks(self) -> dict[int, list[list[int]]]:
        """Blocks by document, as ``blocks`` finds them. Pairs of documents whose shared lines stand in the same order in
        both are their own longest increasing sequence, and their runs are found for all of them at once."""
        if not len(self.at):
            return {}
        order = np.lexsort((self.first, self.doc))
        doc, first, at, there = self.doc[order], self.first[order], self.at[order], self.there[order]
        new = np.append(True, (doc[1:] != doc[:-1]) | (first[1:] != first[:-1]))
        starts = np.flatnonzero(new)
        pair = np.cumsum(new) - 1
        enough = np.add.reduceat(self.words[order], starts) >= BLOCK_WORDS // 2
        climbs = np.append(True, there[1:] > there[:-1]) | new
        sorted_ = np.logical_and.reduceat(climbs, starts)
        if self.repeated:
            enough &= ~np.isin(doc[starts], list(self.repeated))
        out: dict[int, list[list[int]]] = {}
        gone: dict[int, set[int]] = {}

        # Lines whose places differ by the same in both documents, with at most BRIDGE_LINES others, all of them linked, between.
        gap = np.diff(at)
        joins = ~new[1:] & (gap == np.diff(there)) & (gap <= BRIDGE_LINES + 1) & (np.diff(order) == gap)
        runs = np.flatnonzero(np.append(True, ~joins))
        ends = np.append(runs[1:], len(at)) - 1
        total = np.concatenate(([0], np.cumsum(self.words)))
        size = total[order[ends] + 1] - total[order[runs]]
        good = (size >= BLOCK_WORDS) & enough[pair[runs]] & sorted_[pair[runs]]
        for d, a, b in zip(doc[runs[good]].tolist(), at[runs[good]].tolist(), at[ends[good]].tolist()):
            _take(out.setdefault(d, []), gone.setdefault(d, set()), [list(range(a, b + 1))])

        known: dict[int, dict[int, int]] = {}
        for p in np.flatnonzero(enough & ~sorted_).tolist():
            here = order[starts[p] : starts[p + 1] if p + 1 < len(starts) else len(order)]
            d = int(self.doc[here[0]])
            if d not in known:
                mine = slice(self.bounds[d], self.bounds[d + 1])
                known[d] = dict(zip(self.at[mine].tolist(), self.words[mine].tolist()))
            places = dict(zip(self.at[here].tolist(), self.there[here].tolist()))
            common = set(self.at[here[self.once[here] == 1]].tolist())
            runs_ = _long(_aligned(places, common, known[d]), known[d])
            _take(out.setdefault(d, []), gone.setdefault(d, set()), runs_)
        for d in self.repeated:
            out[d] = blocks(self.of(d))
        return out


def _add_passages(out: list[list[int]], spans: list[tuple[int, int]]) -> None:
    """Add the lines of the spans to the blocks that they overlap, or as blocks of their own."""
    owner = {a: block for block in out for a in block}
    merged: list[list[int]] = []
    for start, end in spans:
        if merged and start < merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], end)
        else:
            merged.append([start, end])
    for start, end in merged:
        new = [a for a in range(start, end) if a not in owner]
        if new:
            block = next((owner[a] for a in range(start, end) if a in owner), None)
            if block is None:
                out.append(new)
            else:
                block.extend(new)
                block.sort()


def _runs(aligned: list[tuple[int, int]], words: dict[int, int]) -> Iterator[list[int]]:
    run: list[int] = []
    before = (-2, -2)
    for a, b in aligned:
        gap = a - before[0]
        bridge = range(before[0] + 1, a)
        if run and gap == b - before[1] and gap <= BRIDGE_LINES + 1 and all(i in words for i in bridge):
            run.extend([*bridge, a])
        else:
            if run:
                yield run
            run = [a]
        before = (a, b)
    if run:
        yield run


def _merged(passages: pa.ListArray) -> dict[int, list[tuple[int, int]]]:
    """By document: its passages, those that overlap as one."""
    doc, fields = _columns(passages)
    if not len(doc):
        return {}
    start, end = (x.to_numpy().astype(np.int64) for x in fields)
    order = np.lexsort((start, doc))
    doc, start, end = doc[order], start[order], end[order]
    far = doc * (int(end.max()) + 1)
    reach = np.maximum.accumulate(end + far)
    first = np.flatnonzero(np.append(True, (doc[1:] != doc[:-1]) | (start[1:] + far[1:] >= reach[:-1])))
    last = np.maximum.reduceat(end, first)
    out: dict[int, list[tuple[int, int]]] = {}
    for d, a, b in zip(doc[first].tolist(), start[first].tolist(), last.tolist()):
        out.setdefault(d, []).append((a, b))
    return out


def cuts(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, at, line, blocks): place and hash of the lines to delete by document, and in how many blocks they stand."""
    lines = line_hashes(docs, key, text).withColumn("row", F.monotonically_increasing_id())
    linked = shared_lines(materialize(lines, "lines"))

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[list[pa.Array]]:
        for batch in batches:
            links = Links(batch.column("links"))
            found, passages = links.blocks(), _merged(batch.column("passages"))
            docs_, counts, number, places = [], [], [], []
            for d in sorted(found.keys() | passages.keys()):
                got = found.get(d, [])
                _add_passages(got, passages.get(d, []))
                lo, hi = links.bounds[d], links.bounds[d + 1]
                gone = np.isin(links.at[lo:hi], [a for block in got for a in block])
                if gone.any():
                    docs_.append(d)
                    number.append(sum(map(bool, got)))
                    places.append(lo + np.flatnonzero(gone))
                    counts.append(len(places[-1]))
            where = np.concatenate(places) if places else np.empty(0, np.int64)
            sizes = np.array(counts, np.int64)
            yield [
                batch.column("id").take(pa.array(docs_, pa.int64())), _lists(sizes, links.at[where].astype(np.int32)),
                _lists(sizes, links.line[where]), pa.array(number, pa.int32()),
            ]

    kind = docs.schema[key].dataType.simpleString()
    return map_arrays(linked, each, f"id {kind}, at array<int>, line array<long>, blocks int")


def without_lines(text: str, at: list[int], line: list[int], table: np.ndarray) -> str:
    """The text without the lines in the places ``at``, where they are still those that were found."""
    starts, _, hashes, ends = _lines(text, table)
    places, found = np.array(at, np.int64), np.array(line, np.int64).view(np.uint64)
    there = places < len(starts)
    places, found = places[there], found[there]
    places = np.unique(places[hashes[places] == found])
    kept, end = [], 0
    for a, b in zip(starts[places].tolist(), ends[places].tolist()):
        kept.append(text[end:a])
        end = b
    return "".join([*kept, text[end:]])


def dedup(docs: DataFrame, key: str = "doc_id", note: str | None = None, drop_empty: bool = True) -> DataFrame:
    """``docs`` with the blocks deleted from ``text``; with ``note``, their number in that column.

    A document of which no word is left goes if ``drop_empty``.
    """
    id_, at, line, number = fresh(docs, "cut_id", "cut_at", "cut_line", "cut_blocks")
    by_doc = cuts(docs, key).withColumnsRenamed({"id": id_, "at": at, "line": line, "blocks": number})
    known = docs.where(quoted(key).isNotNull())
    joined = known.join(by_doc, quoted(key) == F.col(id_), "left").drop(id_)
    alone = docs.where(quoted(key).isNull())
    if note:
        joined = joined.withColumn(note, F.coalesce(F.col(number), F.lit(0)))
        alone = alone.withColumn(note, F.lit(0))

    held: list[np.ndarray] = []

    def rewrite(text: str, places: list[int] | None, hashes: list[int] | None) -> str | None:
        if not places:
            return text
        if not held:
            held.append(character_table())
        left = without_lines(text, places, hashes, held[0])
        return left if left.strip() or not drop_empty else None

    return rewrite_text(joined.drop(number), [at, line], rewrite, drop_none=drop_empty).unionByName(alone)
