"""Byte-level BPE: encoding with a two-tier lookup, and decoding.

A text is cut by a pattern into pre-tokens. Tier one: a minimal perfect hash over the
vocabulary answers whole pre-tokens, a batch of distinct ones at a time. Tier two: a
pre-token that is no vocabulary entry is merged byte by byte, the lowest rank first and
the leftmost of equals, with a heap of pairs over a linked list of parts, so that its
cost is n log n however long it is.

Nulls count as empty; an empty text has no ids and decodes to no bytes; repeated rows
give repeated results. Other columns pass as they are, clashing names included: the
result columns are named by the caller.
"""

from __future__ import annotations

import base64
import heapq
from array import array
from collections.abc import Callable, Iterator
from itertools import chain, islice
from pathlib import Path
from typing import Any

import numpy as np
import pyarrow as pa
import regex
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ledgerline.llm.common import map_positions, mix, word_hash_tables

_KEYS_A_BUCKET = 4
_STEP = np.uint64(0xD1B54A32D192ED03)
# Bytes of a generation of remembered pre-tokens, with what Python needs to hold an entry.
_REMEMBERED = 32 << 20
_ENTRY = 160
_GROUP_CHARS = 1 << 19
_WHOLE_CHARS = 1 << 22
_SLICE = 1 << 17


def read_ranks(path: str) -> list[bytes]:
    """The vocabulary of a rank file, by id. It has a fixed size, far below a task's memory."""
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, Path(path).read_bytes().splitlines())}
    tokens: list[bytes] = [b""] * (max(ranks.values()) + 1)
    for token, rank in ranks.items():
        tokens[rank] = token
    return tokens


def bytes_hashes(items: list[bytes], tables: dict[str, np.ndarray]) -> np.ndarray:
    """A 64-bit hash of each of a batch of short byte strings, from prefix sums over them all."""
    data = np.frombuffer(b"".join(items), np.uint8)
    ends = np.cumsum(np.fromiter(map(len, items), np.int64, len(items)))
    starts = np.concatenate(([0], ends[:-1]))
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(tables["values"][data] * tables["powers"][: len(data)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * tables["inverses"][starts])


def perfect_hash(hashes: np.ndarray) -> np.ndarray:
    """Displacements of a minimal perfect hash over distinct 64-bit hashes.

    Keys fall into small buckets; the largest buckets first, each takes the first displacement
    that puts all its keys on free slots. A bucket of one key names its slot outright (negative).
    """
    n = len(hashes)
    buckets = max(1, n // _KEYS_A_BUCKET)
    order = np.argsort((hashes >> np.uint64(32)) % np.uint64(buckets), kind="stable")
    in_bucket = ((hashes >> np.uint64(32)) % np.uint64(buckets))[order].astype(np.int64)
    starts = np.searchsorted(in_bucket, np.arange(buckets + 1))
    shift = np.zeros(buckets, np.int64)
    used = np.zeros(n, np.bool_)
    sizes = np.diff(starts)
    for b in np.argsort(-sizes, kind="stable"):
        if sizes[b] < 2:
            break
        keys = hashes[order[starts[b] : starts[b + 1]]]
        for first in range(0, 1 << 30, 256):
            tries = np.arange(first, first + 256, dtype=np.uint64)
            slots = _slots(keys[:, None], tries[None, :], n)
            ordered = np.sort(slots, axis=0)
            good = ~used[slots].any(axis=0) & (ordered[1:] != ordered[:-1]).all(axis=0)
            if good.any():
                at = int(np.argmax(good))
                shift[b] = first + at
                used[slots[:, at]] = True
                break
    free = np.flatnonzero(~used)
    shift[np.flatnonzero(sizes == 1)] = -free - 1
    return shift


def _slots(hashes: np.ndarray, shifts: np.ndarray, n: int) -> np.ndarray:
    return (mix(hashes + shifts * _STEP) % np.uint64(n)).astype(np.int64)


def slots_of(hashes: np.ndarray, shift: np.ndarray, n: int) -> np.ndarray:
    """The slot of each hash; for what is no key, any slot."""
    own = shift[((hashes >> np.uint64(32)) % np.uint64(len(shift))).astype(np.int64)]
    return np.where(own < 0, -own - 1, _slots(hashes, np.maximum(own, 0).astype(np.uint64), n))


_sent: dict[tuple[str, str, str], Broadcast] = {}


def vocabulary(spark: SparkSession, path: str, pattern: str) -> Broadcast:
    """The vocabulary with its perfect hash, on every executor; sent once per application."""
    key = (spark.sparkContext.applicationId, path, pattern)
    if key not in _sent:
        tokens = read_ranks(path)
        tables = word_hash_tables(b"")
        known = np.array([i for i, t in enumerate(tokens) if t], np.int64)
        hashes = np.concatenate([
            bytes_hashes([tokens[i] for i in known[at : at + 4096]], tables) for at in range(0, len(known), 4096)
        ])
        shift = perfect_hash(hashes)
        ids = np.zeros(len(known), np.int64)
        ids[slots_of(hashes, shift, len(known))] = known
        _sent[key] = spark.sparkContext.broadcast({"tokens": tokens, "shift": shift, "ids": ids, "pattern": pattern})
    return _sent[key]


def merge(piece: bytes, ranks: dict[bytes, int]) -> tuple[int, ...]:
    """The ids of a piece: of all neighbouring parts the pair of lowest rank is joined, over and over.

    Heap entries are (rank, start) packed into one number; ``pair`` has the rank that the part
    at each start would have if joined with the next one, so outdated entries are told apart.
    """
    n = len(piece)
    rank_of, bits = ranks.get, n.bit_length()
    mask = (1 << bits) - 1
    after = list(range(1, n + 1))
    before = list(range(-1, n))
    pair = [rank_of(piece[i : i + 2]) for i in range(n)]
    pair[-1] = None
    heap = [r << bits | i for i, r in enumerate(pair) if r is not None]
    heapq.heapify(heap)
    pop, push = heapq.heappop, heapq.heappush
    while heap:
        entry = pop(heap)
        i = entry & mask
        if pair[i] != entry >> bits:
            continue
        j = after[i]
        k = after[i] = after[j]
        pair[j] = None
        before[k] = i
        if k < n:
            r = pair[i] = rank_of(piece[i : after[k]])
            if r is not None:
                push(heap, r << bits | i)
        else:
            pair[i] = None
        h = before[i]
        if h >= 0:
            r = pair[h] = rank_of(piece[h:k])
            if r is not None:
                push(heap, r << bits | h)
    out, i = [], 0
    while i < n:
        j = after[i]
        out.append(ranks[piece[i:j]])
        i = j
    return tuple(out)


class _Encoder:
    """What one task needs to encode. Ids of pre-tokens are remembered in two generations of
    bounded bytes; those met again move to the younger one, the rest are forgotten."""

    def __init__(self, vocab: dict[str, Any]):
        self.tokens, self.shift, self.ids = vocab["tokens"], vocab["shift"], vocab["ids"]
        self.find = regex.compile(vocab["pattern"])
        self.tables = word_hash_tables(b"")
        self.ranks = {t: i for i, t in enumerate(self.tokens) if t}
        self.longest = max(map(len, self.tokens))
        self.known: dict[str, tuple[int, ...]] = {}
        self.older: dict[str, tuple[int, ...]] = {}
        self.held = 0

    def learn(self, pieces: set[str]) -> None:
        if self.held > _REMEMBERED:
            self.known, self.older, self.held = {}, self.known, 0
        new = [p for p in pieces if p not in self.known]
        if self.older:
            again = [p for p in new if p in self.older]
            self.known.update(zip(again, map(self.older.__getitem__, again)))
            self.held += sum(_ENTRY + len(p) + 8 * len(self.known[p]) for p in again)
            new = [p for p in new if p not in self.older]
        raw = [p.encode() for p in new]
        short = [i for i, p in enumerate(raw) if len(p) <= self.longest]
        for at in range(0, len(short), 4096):
            some = short[at : at + 4096]
            hashes = bytes_hashes([raw[i] for i in some], self.tables)
            for i, found in zip(some, self.ids[slots_of(hashes, self.shift, len(self.ids))].tolist()):
                if self.tokens[found] == raw[i]:
                    self.known[new[i]] = (found,)
        for p, b in zip(new, raw):
            if p not in self.known:
                self.known[p] = merge(b, self.ranks)
            self.held += _ENTRY + len(b) + 8 * len(self.known[p])

    def pieces(self, text: str) -> Iterator[list[str]]:
        if len(text) <= _WHOLE_CHARS:
            yield self.find.findall(text)
            return
        matches = self.find.finditer(text)
        while some := [m.group() for m in islice(matches, _SLICE)]:
            yield some

    def encode(self, texts: list[str | None]) -> Iterator[array]:
        """The ids of each text; neighbouring short texts look their new pre-tokens up together."""
        at = 0
        while at < len(texts):
            end, chars = at, 0
            while end < len(texts) and (end == at or chars + len(texts[end] or "") <= _GROUP_CHARS):
                chars += len(texts[end] or "")
                end += 1
            if end - at == 1:
                ids = array("i")
                for some in self.pieces(texts[at] or ""):
                    self.learn(set(some))
                    ids.extend(list(chain.from_iterable(map(self.known.__getitem__, some))))
                yield ids
            else:
                cut = [self.find.findall(t or "") for t in texts[at:end]]
                self.learn(set().union(*cut))
                for some in cut:
                    yield array("i", list(chain.from_iterable(map(self.known.__getitem__, some))))
            at = end


def _encoded(df: DataFrame, vocab: Broadcast, text: str, fields: list[T.StructField], made: Callable) -> DataFrame:
    """``df`` and the columns that ``made`` makes of a batch's ids, texts and the vocabulary's bytes, in one pass."""
    place = df.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[list[pa.Array]]:
        encoder = _Encoder(vocab.value)
        for batch in batches:
            texts = batch.column(place).to_pylist()
            rows = [np.frombuffer(r, np.int32) for r in encoder.encode(texts)]
            yield [*batch.columns, *made(rows, texts, encoder.tokens)]

    return map_positions(df, run, [*df.schema.fields, *fields])


def _lists(rows: list[np.ndarray]) -> pa.Array:
    offsets = np.zeros(len(rows) + 1, np.int32)
    np.cumsum([len(r) for r in rows], out=offsets[1:])
    flat = np.concatenate(rows) if rows else np.empty(0, np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat, pa.int32()))


def _bytes_of(ids: np.ndarray, tokens: list[bytes]) -> bytes:
    return b"".join(map(tokens.__getitem__, ids.tolist()))


def encode(df: DataFrame, vocab: Broadcast, text: str = "text", ids: str = "ids") -> DataFrame:
    """``df`` with the token ids of ``text`` as an array column ``ids``."""
    return _encoded(df, vocab, text, [T.StructField(ids, T.ArrayType(T.IntegerType(), False), False)], lambda rows, texts, tokens: [_lists(rows)])


def encode_checked(df: DataFrame, vocab: Broadcast, text: str = "text", ids: str = "ids", same: str = "round_trip") -> DataFrame:
    """``df`` with the token ids of ``text``, and whether they decode to it; in one pass over the texts."""

    def made(rows: list[np.ndarray], texts: list[str | None], tokens: list[bytes]) -> list[pa.Array]:
        return [_lists(rows), pa.array([_bytes_of(r, tokens) == (t or "").encode() for r, t in zip(rows, texts)], pa.bool_())]

    fields = [T.StructField(ids, T.ArrayType(T.IntegerType(), False), False), T.StructField(same, T.BooleanType(), False)]
    return _encoded(df, vocab, text, fields, made)


def text_digests(df: DataFrame, vocab: Broadcast, text: str = "text") -> DataFrame:
    """``df`` with n_tokens, and SHA-256 of the ids of ``text`` (little-endian, 32 bits each) and of
    the bytes that they decode to; in one pass over the texts."""

    def made(rows: list[np.ndarray], texts: list[str | None], tokens: list[bytes]) -> list[pa.Array]:
        from hashlib import sha256

        return [
            pa.array([len(r) for r in rows], pa.int64()), pa.array([sha256(r.astype("<u4").tobytes()).hexdigest() for r in rows], pa.string()),
            pa.array([sha256(_bytes_of(r, tokens)).hexdigest() for r in rows], pa.string()),
        ]

    fields = [T.StructField("n_tokens", T.LongType()), T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType())]
    return _encoded(df, vocab, text, fields, made)


def _slices(column: pa.Array) -> Iterator[np.ndarray]:
    offsets, flat = column.offsets.to_numpy(), column.values.to_numpy()
    for a, b in zip(offsets[:-1], offsets[1:]):
        yield flat[a:b]


def decode(df: DataFrame, vocab: Broadcast, ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """``df`` with the bytes that ``ids`` stand for as a binary column; they need not be UTF-8."""
    place = df.columns.index(ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[list[pa.Array]]:
        tokens = vocab.value["tokens"]
        for batch in batches:
            rows = _slices(batch.column(place))
            yield [*batch.columns, pa.array([_bytes_of(r, tokens) for r in rows], pa.binary())]

    return map_positions(df, run, [*df.schema.fields, T.StructField(decoded, T.BinaryType(), False)])


def digests(df: DataFrame, key: str, ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """Per row: ``key``, n_tokens, and SHA-256 of the ids (little-endian, 32 bits each) and of the decoded bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from hashlib import sha256

        for batch in batches:
            rows = list(_slices(batch.column(batch.schema.names.index(ids))))
            raw = batch.column(batch.schema.names.index(decoded)).to_pylist()
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(batch.schema.names.index(key)),
                    pa.array([len(r) for r in rows], pa.int64()),
                    pa.array([sha256(r.astype("<u4").tobytes()).hexdigest() for r in rows], pa.string()),
                    pa.array([sha256(b).hexdigest() for b in raw], pa.string()),
                ],
                names=[key, "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    kind = df.schema[key].dataType.simpleString()
    return df.mapInArrow(run, f"{key} {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")
