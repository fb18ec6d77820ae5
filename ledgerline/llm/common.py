"""Helpers that several operators share."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql import types as T

BATCH_ROWS = 500
HELD_OUT_FOLDS = 5


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession) -> None:
    """Texts differ in length by orders of magnitude, so a batch holds few rows: a worker's
    memory follows BATCH_ROWS texts and not a partition."""
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) > BATCH_ROWS:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def map_rows(df: DataFrame, each: Callable[[Iterator[dict[str, list]]], Iterator[dict[str, Any]]], schema: str) -> DataFrame:
    """Run ``each`` over a partition's batches, given and returned as columns by name."""
    small_batches(df.sparkSession)
    arrow = to_arrow_schema(T._parse_datatype_string(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        columns = ({n: c.to_pylist() for n, c in zip(b.schema.names, b.columns)} for b in batches)
        for out in each(columns):
            yield pa.RecordBatch.from_arrays([pa.array(out[f.name], f.type) for f in arrow], schema=arrow)

    return df.mapInArrow(run, schema)


def map_arrays(df: DataFrame, each: Callable[[Iterator[pa.RecordBatch]], Iterator[list[pa.Array]]], schema: str) -> DataFrame:
    """Run ``each`` over a partition's batches, given as they are and returned as arrays in the order of ``schema``."""
    small_batches(df.sparkSession)
    arrow = to_arrow_schema(T._parse_datatype_string(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for out in each(batches):
            yield pa.RecordBatch.from_arrays([a if a.type == f.type else a.cast(f.type) for a, f in zip(out, arrow)], schema=arrow)

    return df.mapInArrow(run, schema)


def map_positions(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[list[pa.Array]]], fields: list[T.StructField]) -> DataFrame:
    """``df`` mapped batch by batch to the columns ``fields``; columns go by place, so any names will do."""
    small_batches(df.sparkSession)
    out = T.StructType([T.StructField(f"c{i}", f.dataType, f.nullable) for i, f in enumerate(fields)])
    arrow = to_arrow_schema(out)

    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for arrays in run(batches):
            yield pa.RecordBatch.from_arrays([a if a.type == f.type else a.cast(f.type) for a, f in zip(arrays, arrow)], schema=arrow)

    plain = df.toDF(*[f"c{i}" for i in range(len(df.columns))])
    return plain.mapInArrow(mapped, out).toDF(*[f.name for f in fields])


def with_notes(df: DataFrame, inputs: list[str], schema: str, each: Callable[[Iterator[list[list]]], Iterator[list[list]]]) -> DataFrame:
    """``df`` and the columns of ``schema`` that ``each`` makes of the batches of ``inputs``.

    All other columns pass as they are, whatever their names and types. The new names must
    not be taken (see ``fresh``).
    """
    new = T._parse_datatype_string(schema)
    kinds = [f.type for f in to_arrow_schema(new)]
    places = [df.columns.index(n) for n in inputs]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[list[pa.Array]]:
        waiting: list[pa.RecordBatch] = []

        def columns() -> Iterator[list[list]]:
            for batch in batches:
                waiting.append(batch)
                yield [batch.column(i).to_pylist() for i in places]

        for out in each(columns()):
            yield [*waiting.pop().columns, *[pa.array(values, kind) for values, kind in zip(out, kinds)]]

    return map_positions(df, run, [*df.schema.fields, *new.fields])


def rewrite_text(df: DataFrame, notes: list[str], rewrite: Callable[..., str | None], drop_none: bool = False) -> DataFrame:
    """``df`` with ``text`` replaced by ``rewrite(text, *notes of the row)``, and ``n_chars``, if
    there is one, recounted where the text changed; the note columns are dropped.

    All other columns pass as they are. Null texts stay; with ``drop_none``, other rows for
    which the rewrite returns None go.
    """
    names = df.columns
    kept = [i for i, n in enumerate(names) if n not in notes]
    note_places = [names.index(n) for n in notes]
    text_place = names.index("text")
    count_place = names.index("n_chars") if "n_chars" in names else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[list[pa.Array]]:
        for batch in batches:
            old = batch.column(text_place).to_pylist()
            given = [batch.column(i).to_pylist() for i in note_places]
            new = [None if t is None else rewrite(t, *row) for t, *row in zip(old, *given)]
            arrays = {i: batch.column(i) for i in kept}
            arrays[text_place] = pa.array(new, pa.string())
            if count_place is not None and pa.types.is_integer(arrays[count_place].type):
                before = arrays[count_place]
                counts = [c if n is None or n == o else len(n) for c, o, n in zip(before.to_pylist(), old, new)]
                arrays[count_place] = pa.array(counts, before.type)
            if drop_none:
                stay = pa.array([n is not None or o is None for o, n in zip(old, new)], pa.bool_())
                arrays = {i: a.filter(stay) for i, a in arrays.items()}
            yield [arrays[i] for i in kept]

    return map_positions(df, run, [df.schema.fields[i] for i in kept])


def quoted(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names like ``names`` that ``df`` does not have yet."""
    taken = {c.lower() for c in df.columns}
    found = []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        found.append(name)
    return found


def held_out(doc_id: str = "doc_id") -> Column:
    """The fold that nothing is learnt from: crc32 of the id as text divisible by five. A
    null id belongs to no fold and is held out as well."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % HELD_OUT_FOLDS == 0, F.lit(True))


def bounded_sample(df: DataFrame, by: str, most: int, total: int, seed: int) -> DataFrame:
    """About ``most`` of ``total`` rows, chosen by a hash of ``by``; all if there are fewer."""
    if total <= most:
        return df
    share = int(most / total * 2**32)
    return df.where(F.pmod(F.xxhash64(F.lit(seed), F.col(by)), F.lit(2**32)) < F.lit(share))


# ---- hashes of words, all at once over the bytes of a text ----

_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 2**64)
_PIECE = 1 << 20


def word_hash_tables(separators: bytes) -> dict[str, np.ndarray]:
    """Tables for ``word_hashes``: which bytes part words, a random value per byte, and the
    powers of an odd base and of its inverse modulo 2**64."""
    rng = np.random.default_rng(20250101)
    is_word = np.ones(256, np.bool_)
    is_word[list(separators)] = False
    values = rng.integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
    powers = np.ones(_PIECE, np.uint64)
    inverses = np.ones(_PIECE, np.uint64)
    with np.errstate(over="ignore"):
        powers[1:] = np.multiply.accumulate(np.full(_PIECE - 1, _BASE, np.uint64))
        inverses[1:] = np.multiply.accumulate(np.full(_PIECE - 1, _INVERSE, np.uint64))
    return {"is_word": is_word, "values": values, "powers": powers, "inverses": inverses}


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _piece_hashes(data: np.ndarray, tables: dict[str, np.ndarray]) -> np.ndarray:
    inside = tables["is_word"][data]
    edges = np.flatnonzero(np.diff(np.concatenate(([False], inside, [False])).view(np.int8)))
    starts, ends = edges[0::2], edges[1::2]
    if not len(starts):
        return np.empty(0, np.uint64)
    sums = np.empty(len(data) + 1, np.uint64)
    sums[0] = 0
    np.cumsum(tables["values"][data] * tables["powers"][: len(data)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * tables["inverses"][starts])


def word_hashes(data: bytes, tables: dict[str, np.ndarray]) -> np.ndarray:
    """A 64-bit hash of every word of ``data``, in order, from prefix sums over its bytes.

    Long texts are hashed in pieces that end between words, so memory stays at a few
    megabytes; a single word longer than a piece is hashed by its pieces.
    """
    whole = np.frombuffer(data, np.uint8)
    if len(whole) < _PIECE:
        return _piece_hashes(whole, tables)
    found, at, joined = [], 0, False
    while at < len(whole):
        end = min(at + _PIECE - 1, len(whole))
        piece = whole[at:end]
        if end < len(whole):
            gaps = np.flatnonzero(~tables["is_word"][piece])
            if len(gaps) and gaps[-1] > 0:
                end = at + int(gaps[-1])
                piece = whole[at:end]
        got = _piece_hashes(piece, tables)
        if joined and len(got) and found and len(found[-1]):
            got[0] = mix(found[-1][-1:] * np.uint64(3) + got[:1])[0]
            found[-1] = found[-1][:-1]
        found.append(got)
        joined = bool(len(piece)) and bool(tables["is_word"][piece[-1]]) and end < len(whole) and bool(tables["is_word"][whole[end]])
        at = end
    return np.concatenate(found)


def shingle_hashes(words: np.ndarray, width: int) -> np.ndarray:
    """A hash of every ``width`` consecutive words; of all words if there are fewer."""
    if not len(words):
        return words
    width = min(width, len(words))
    n = len(words) - width + 1
    out = np.zeros(n, np.uint64)
    for i in range(width):
        out = mix(out + words[i : i + n] + np.uint64(i + 1)) if i else words[:n] * np.uint64(_INVERSE)
    return out
