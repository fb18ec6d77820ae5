"""Document fingerprints: threshold-scaled sketches.

A fingerprint keeps every hash of a text's byte shingles that lies below 1/SCALE of the hash
range, whatever the text's length. Sketches of texts of any two lengths can thus be merged
(union) and compared: the share of one sketch found in the other estimates the share of its
shingles, containment, without either length getting in the way. A text none of whose hashes
is below the threshold keeps its smallest one, so that every text with content has a sketch.

Shingles are SHINGLE_BYTES consecutive bytes of UTF-8; a shorter text is one shingle. The
fingerprint is the number of hashes, a colon, and the hashes (48 bits, ascending) in hexadecimal.

Defined results: null counts as empty; an empty text has the fingerprint "0:", which is wholly
contained in an empty text and not at all in another; equal texts have equal fingerprints.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256
from typing import Any

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import map_rows, mix
from ledgerline.session import shuffle_width

SHINGLE_BYTES = 24
SCALE = 32
HASH_BITS = 48
_CHUNK = 1 << 18
_BASE = np.uint64(0x9E3779B97F4A7C15)


def _byte_values() -> np.ndarray:
    return np.random.default_rng(1).integers(1, 2**63, 256, dtype=np.uint64)


def _windows(values: np.ndarray, width: int) -> np.ndarray:
    """The polynomial hash of every ``width`` consecutive values, by doubling."""
    whole, done, power, block = None, 0, _BASE, values
    size = 1
    while True:
        if width & size:
            if whole is None:
                whole = block
            else:
                # ``whole`` covers the first ``done`` values of a window, ``block`` the next ``size``.
                n = len(block) - done
                whole = whole[:n] * power + block[done : done + n]
            done += size
        if size * 2 > width:
            return whole
        block = block[:-size] * power + block[size:]
        power = power * power
        size *= 2


def sketch(data: bytes, table: np.ndarray) -> np.ndarray:
    """The retained hashes of a text, ascending."""
    if not data:
        return np.empty(0, np.uint64)
    width = min(SHINGLE_BYTES, len(data))
    limit = np.uint64((1 << HASH_BITS) // SCALE)
    kept, lowest = [], None
    with np.errstate(over="ignore"):
        for at in range(0, len(data) - width + 1, _CHUNK):
            values = table[np.frombuffer(data, np.uint8, min(_CHUNK + width - 1, len(data) - at), at)]
            hashes = mix(_windows(values, width)) >> np.uint64(64 - HASH_BITS)
            small = hashes[hashes < limit]
            if len(small):
                kept.append(small)
            elif not kept:
                here = hashes.min()
                lowest = here if lowest is None else min(lowest, here)
    return np.unique(np.concatenate(kept)) if kept else np.array([lowest], np.uint64)


def write(hashes: np.ndarray) -> str:
    return f"{len(hashes)}:" + hashes.astype(">u8").view(np.uint8).reshape(-1, 8)[:, 2:].tobytes().hex()


def read(fingerprint: str) -> np.ndarray:
    raw = bytes.fromhex(fingerprint.partition(":")[2])
    out = np.zeros((len(raw) // 6, 8), np.uint8)
    out[:, 2:] = np.frombuffer(raw, np.uint8).reshape(-1, 6)
    return out.reshape(-1).view(">u8").astype(np.uint64)


def containment(of: np.ndarray, within: np.ndarray) -> float:
    """The share of ``of`` that ``within`` holds."""
    if not len(of):
        return float(not len(within))
    return len(np.intersect1d(of, within, assume_unique=True)) / len(of)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """The share of both sketches' hashes that they have in common."""
    if not len(a) and not len(b):
        return 1.0
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (len(a) + len(b) - both)


def merge(*sketches: np.ndarray) -> np.ndarray:
    """The sketch of several texts taken together."""
    return np.unique(np.concatenate(sketches))


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: key and fingerprint."""

    def each(batches: Iterator[dict[str, list]]) -> Iterator[dict[str, Any]]:
        table = _byte_values()
        for batch in batches:
            found = [write(sketch((t or "").encode(), table)) for t in batch["text"]]
            yield {"key": batch["key"], "fingerprint": found}

    kind = docs.schema[key].dataType.simpleString()
    given = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    return map_rows(given, each, f"key {kind}, fingerprint string").withColumnRenamed("key", key)


def with_successor(docs: DataFrame, each_pair: Any, schema: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Run ``each_pair`` over (document, next document) in the order of key and text; the first
    document follows the last.

    Texts move once: to one task for each range of keys, in order. The first document of a
    range is also sent to the task of the range before it, so no task needs another's rows. The
    bounds, one for each shuffle partition, are quantiles of the keys. A null key comes first.
    """
    spark = docs.sparkSession
    # A hash decides between rows that repeat a key; equal rows are alike anyway.
    rows = docs.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"), F.xxhash64(text).alias("tie"))
    width = shuffle_width(spark)
    shares = [i / width for i in range(1, width)]
    bounds = rows.agg(F.percentile_approx("key", F.array(*map(F.lit, shares)), 100 * width)).first()[0] if shares else []
    bounds = sorted(set(bounds or []))
    rows = rows.withColumn("p", _bucket("key", bounds))
    heads = rows.groupBy("p").agg(F.min(F.struct("key", "tie")).alias("head")).orderBy("p").collect()
    if not heads:
        return spark.createDataFrame([], schema)
    # One entry for each bound: a range's first document also goes to the range before it.
    first: list[Any] = [(None, None, None)] * (len(bounds) + 1)
    for i, row in enumerate(heads):
        first[row.p] = (row.head.key, row.head.tie, heads[i - 1].p)
    keys, ties, before = (F.array(*[F.lit(x[i]).cast(kind) for x in first]) for i, kind in enumerate(("long", "long", "int")))
    is_head = F.get(keys, F.col("p")).eqNullSafe(F.col("key")) & F.get(ties, F.col("p")).eqNullSafe(F.col("tie"))
    own = F.struct("p", F.lit(False).alias("after"))
    copy = F.struct(F.get(before, F.col("p")).alias("p"), F.lit(True).alias("after"))
    sent = rows.withColumn("to", F.explode(F.when(is_head, F.array(own, copy)).otherwise(F.array(own))))
    dealt = sent.select("key", "text", "tie", "to.p", "to.after").repartitionById(len(bounds) + 1, F.col("p"))
    ordered = dealt.sortWithinPartitions("after", F.col("key").asc_nulls_first(), "tie").select("key", "text", "after")

    def each(batches: Iterator[dict[str, list]]) -> Iterator[dict[str, Any]]:
        def in_order() -> Iterator[tuple[Any, str | None, bool]]:
            for batch in batches:
                yield from zip(batch["key"], batch["text"], batch["after"])

        yield from each_pair(_pairs(in_order()))

    return map_rows(ordered, each, schema)


def _pairs(rows: Iterator[tuple[Any, str | None, bool]]) -> Iterator[tuple[Any, str, str]]:
    """(key, text, next text), without the copies at the end, of which only the first is a successor."""
    last = None
    for key, text, after in rows:
        if last is not None:
            yield last[0], last[1], text or ""
        if after:
            return
        last = (key, text or "")


def _bucket(column: str, bounds: list[int]) -> Column:
    """How many bounds are at or below the value; 0 for null."""
    if not bounds:
        return F.lit(0)
    below = F.size(F.filter(F.array(*map(F.lit, bounds)), lambda b: b <= F.col(column)))
    return F.when(F.col(column).isNull(), F.lit(0)).otherwise(below)


def edited(text: str, other: str) -> str:
    """``text`` with its last half replaced by as much of the beginning of ``other``."""
    half = len(text) // 2
    return text[: len(text) - half] + other[:half]


def compare_edits(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: its fingerprint, that of its edited text, and how much of its own sketch is
    found in that of the edited text and of the next document."""
    batch_rows = 200

    def each_pair(pairs: Iterator[tuple[Any, str, str]]) -> Iterator[dict[str, Any]]:
        table = _byte_values()
        names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next", "jaccard_edited", "jaccard_next"]
        out: dict[str, list] = {n: [] for n in names}
        known: tuple[str, np.ndarray] | None = None
        for doc_id, own, following in pairs:
            mine = known[1] if known and known[0] == own else sketch(own.encode(), table)
            theirs = sketch(following.encode(), table)
            known = (following, theirs)
            changed = edited(own, following).encode()
            other = sketch(changed, table)
            row = (
                doc_id, len(own), sha256(changed).hexdigest(), write(mine), write(other), containment(mine, other),
                containment(mine, theirs), likeness(mine, other), likeness(mine, theirs),
            )
            for n, value in zip(names, row):
                out[n].append(value)
            if len(out["doc_id"]) == batch_rows:
                yield out
                out = {n: [] for n in names}
        yield out

    schema = (
        "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double, jaccard_edited double, jaccard_next double"
    )
    return with_successor(docs, each_pair, schema, key, text)
