"""Scores of texts under a hashed maximum-entropy language model.

A token's probability is that of its class, given the words before it, times its own within the
class. The class comes from a softmax over the sum of weight rows of hashed features: the last word, the
one before it, the third last (skips), and the last two, and last and third last, as pairs. A word's own part is the
softmax of one feature per word, whose best weights are its counts in closed form. Words that training has never seen are
one outcome per class, with the weight of the class's words seen once (Good and Turing), so all outcomes
together have probability 1.

Classes are groups of words by their neighbours: frequent words one by one, all others by their last
three bytes, so that unseen words have a class as well. Everything is learnt from all training texts:
counts, neighbours, and the weights, by ``ROUNDS`` rounds that share the texts out. In a round every task goes through
its texts in small steps from the common weights, and the changes of a row are averaged by how
often a task met it. What grows with the corpus (the words and their counts) stays in Spark: the most frequent words,
at most ``HEAD`` of them, are broadcast, and the others are looked up by a join.

Words are told apart by 64-bit hashes.

Defined results: a null text is empty and has the end as its only token. Texts of any length are read whole, in
pieces that end between words. Rows of a repeated id are scored each by itself; a null id is held out.
Without training texts every score is 0. An empty table gives no rows. Columns other than doc_id and text are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import mix, small_batches, word_hash_tables
from ledgerline.session import materialize

FOLDS = 10
HEAD = 1 << 16
OWN_CLASSED = 4096
ENDINGS = 1024
LANDMARKS, REST_LANDMARKS = 48, 16
CLASSES = 64
ROWS = 1 << 14
ROUNDS = 3
STEP_TOKENS = 1024
_FEW = 16
_AT_ONCE = 768
RATE = (0.3, 0.2, 0.1)
BLOCK = 256
SMOOTH = 0.1
END = np.uint64(1)
_SEPARATORS = b" \t\n\x0b\x0c\r"
_GROUP = (1 << 20) - 1
_HEAD_BITS = 20
_SHARED = -2
_HELD_WORDS = 1_000_000
_SALTS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0x85EBCA77C2B2AE63)
FEATURES = len(_SALTS) + 1


def held_out() -> Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % FOLDS == 0, F.lit(True))


# ---- tokens ----

def _words(data: bytes, tables: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, hash and ending (a number below ENDINGS) of every word of at most a piece of text."""
    raw = np.frombuffer(data, np.uint8)
    inside = tables["is_word"][raw]
    edges = np.flatnonzero(np.diff(np.concatenate(([False], inside, [False])).view(np.int8)))
    starts, ends = edges[0::2], edges[1::2]
    sums = np.empty(len(raw) + 1, np.uint64)
    sums[0] = 0
    np.cumsum(tables["values"][raw] * tables["powers"][: len(raw)], out=sums[1:])
    hashes = mix((sums[ends] - sums[starts]) * tables["inverses"][starts])
    tail = np.maximum(ends - 3, starts)
    return starts, hashes, _ending((sums[ends] - sums[tail]) * tables["inverses"][tail])


def _ending(x: np.ndarray) -> np.ndarray:
    return (mix(x) >> np.uint64(64 - ENDINGS.bit_length() + 1)).astype(np.int32)


def _pieces(data: bytes) -> Iterator[bytes]:
    """A long text in pieces that end between words; a piece is longer only if it is one word."""
    at = 0
    while at < len(data):
        stop = min(at + _GROUP, len(data))
        if stop < len(data):
            last = max(data.rfind(bytes([s]), at, stop) for s in _SEPARATORS)
            if last <= at:
                later = [p for p in (data.find(bytes([s]), stop) for s in _SEPARATORS) if p >= 0]
                stop = min(later, default=len(data))
            else:
                stop = last
        yield data[at:stop]
        at = stop


def _long(data: bytes, tables: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    hashes, endings = [np.empty(0, np.uint64)], [np.empty(0, np.int32)]
    for piece in _pieces(data):
        if len(piece) > _GROUP + 1:
            word = piece.strip(_SEPARATORS)
            got = np.frombuffer(hashlib.blake2b(word, digest_size=8).digest(), np.uint64)
            end = _words(word[-3:], tables)[2]
        else:
            _, got, end = _words(piece, tables)
        hashes.append(got)
        endings.append(end)
    return np.concatenate(hashes), np.concatenate(endings)


def tokens(texts: list[str | None], tables: dict[str, np.ndarray]) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """Groups of texts: place of the first, tokens per text, and all tokens' hashes and endings;
    each text's last token is the end."""
    group: list[bytes] = []
    size, first = 0, 0

    def grouped() -> tuple[int, np.ndarray, np.ndarray, np.ndarray]:
        begins = np.cumsum([0] + [len(t) + 1 for t in group[:-1]])
        starts, hashes, endings = _words(b"\n".join(group), tables)
        upto = np.searchsorted(starts, np.append(begins[1:], size + 1))
        return first, np.diff(upto, prepend=0) + 1, np.insert(hashes, upto, END), np.insert(endings, upto, 0)

    for place, text in enumerate(texts):
        data = (text or "").encode("utf-8", "surrogatepass").lower()
        if group and size + len(data) + 1 > _GROUP:
            yield grouped()
            group, size, first = [], 0, place
        if len(data) >= _GROUP:
            hashes, endings = _long(data, tables)
            yield place, np.array([len(hashes) + 1]), np.append(hashes, END), np.append(endings, np.int32(0))
            first = place + 1
            continue
        group.append(data)
        size += len(data) + 1
    if group:
        yield grouped()


def features(hashes: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Weight rows of every token's features; row 0 is for all tokens. Before a text stands its end."""
    n = len(hashes)
    place = np.arange(n) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    before = []
    for back in (1, 2, 3):
        h = np.full(n, END, np.uint64)
        h[back:] = hashes[:-back] if n > back else h[back:]
        h[place < back] = END
        before.append(h)
    one, two, three = before
    s = [np.uint64(x) for x in _SALTS]
    keys = (one * s[0] + s[1], two * s[1] + s[2], three * s[2] + s[3], (one ^ mix(two + s[4])) * s[3] + s[4], (one ^ mix(three + s[0])) * s[4] + s[0])
    out = np.zeros((n, FEATURES), np.int32)
    for i, key in enumerate(keys):
        out[:, i + 1] = 1 + (mix(key) % np.uint64(ROWS - 1)).astype(np.int32)
    return out


# ---- the model as plain arrays ----

class Head:
    """Places of the head words: a table by the first bits of a hash names the only word with
    them, and hashes whose bits several words share are searched for."""

    def __init__(self, known: np.ndarray):
        self.known = known
        slots = self._slots(known)
        self.table = np.full(1 << _HEAD_BITS, -1, np.int32)
        self.table[slots] = np.arange(len(known), dtype=np.int32)
        self.table[slots[np.flatnonzero(np.diff(slots) == 0)]] = _SHARED

    def _slots(self, hashes: np.ndarray) -> np.ndarray:
        return (hashes >> np.uint64(64 - _HEAD_BITS)).astype(np.int64)

    def places(self, hashes: np.ndarray) -> np.ndarray:
        """Place of every hash in the sorted head, -1 if it is not there."""
        at = self.table[self._slots(hashes)]
        shared = np.flatnonzero(at == _SHARED)
        if len(shared):
            at[shared] = np.minimum(np.searchsorted(self.known, hashes[shared]), len(self.known) - 1)
        if len(self.known):
            at[self.known[at] != hashes] = -1
        return at


def head_of(model: dict) -> Head:
    """The head's table, made once per task."""
    return Head(model["head"])


def buckets(model: dict, head: Head, hashes: np.ndarray, endings: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Place among the head words, and the group of the word: its own, or that of its ending."""
    at = head.places(hashes)
    own = np.where(at >= 0, model["own"][at], -1) if len(model["head"]) else at
    return at, np.where(own >= 0, own, OWN_CLASSED + endings)


def logits(weights: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Sums of each token's weight rows; the first is row 0 for all of them."""
    total = weights.take(rows[:, 1], 0)
    total += weights[0]
    for i in range(2, rows.shape[1]):
        total += weights.take(rows[:, i], 0)
    return total


def log_softmax(x: np.ndarray) -> np.ndarray:
    x = x - x.max(1, keepdims=True)
    return x - np.log(np.exp(x).sum(1, keepdims=True))


def _sums(wrong: np.ndarray, token: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Sums of the rows ``token`` of ``wrong`` over groups, large ones first: one member of each
    at a time, and the few groups of more than ``_FEW`` each by itself."""
    out = wrong.take(token[starts], 0)
    for member in range(1, _FEW):
        more = int(np.count_nonzero(sizes > member))
        if not more:
            break
        out[:more] += wrong.take(token[starts[:more] + member], 0)
    for i in range(int(np.count_nonzero(sizes > _FEW))):
        out[i] = wrong.take(token[starts[i] : starts[i] + sizes[i]], 0).sum(0)
    return out


def _lengths(change: np.ndarray) -> np.ndarray:
    """The mean square of each row."""
    return np.einsum("ij,ij->i", change, change) / change.shape[1]


def _move(weights: np.ndarray, squares: np.ndarray, at: np.ndarray, change: np.ndarray, lengths: np.ndarray, rate: float) -> None:
    """Move the rows ``at``, which are distinct, by ``change``, some at a time while they are in the cache."""
    damped = squares.take(at)
    damped += lengths
    squares[at] = damped
    scale = (rate / np.sqrt(damped * change.shape[1] + 1.0))[:, None]
    for a in range(0, len(at), _AT_ONCE):
        here = slice(a, a + _AT_ONCE)
        part = change[here]
        part *= scale[here]
        part += weights.take(at[here], 0)
        weights[at[here]] = part


def step(weights: np.ndarray, squares: np.ndarray, met: np.ndarray, rows: np.ndarray, target: np.ndarray, rate: float) -> None:
    """One gradient step on some tokens; ``squares`` damps a row by its earlier gradients."""
    wrong = logits(weights, rows)
    wrong -= wrong.max(1, keepdims=True)
    np.exp(wrong, out=wrong)
    wrong /= -wrong.sum(1, keepdims=True)
    wrong[np.arange(len(target)), target] += 1.0
    met[0] += len(rows)
    every = wrong.sum(0, keepdims=True)
    _move(weights, squares, np.zeros(1, np.int64), every, _lengths(every), rate)
    # Sixteen bits are sorted by counting.
    flat = rows[:, 1:].astype(np.uint16).ravel()
    order = np.argsort(flat, kind="stable")
    ordered = flat[order]
    starts = np.flatnonzero(np.concatenate(([True], ordered[1:] != ordered[:-1])))
    sizes = np.diff(starts, append=len(flat))
    at = ordered[starts].astype(np.int64)
    met[at] += sizes
    token = order // (rows.shape[1] - 1)
    # Most rows are those of one token only, whose change needs no sum.
    alone = np.flatnonzero(sizes == 1)
    one = token[starts[alone]]
    _move(weights, squares, at[alone], wrong.take(one, 0), _lengths(wrong)[one], rate)
    several = np.flatnonzero(sizes > 1)
    several = several[np.argsort(-np.minimum(sizes[several], _FEW + 1).astype(np.int8), kind="stable")]
    change = _sums(wrong, token, starts[several], sizes[several])
    _move(weights, squares, at[several], change, _lengths(change), rate)


def group_words(counts: np.ndarray, neighbours: np.ndarray, classes: int, first: int) -> np.ndarray:
    """Class per bucket, by k-means over the neighbours' shares; bucket ``first`` (the end) has class 0 for itself."""
    seen = np.flatnonzero(counts > 0)
    words = seen[seen != first]
    out = np.zeros(len(counts), np.int32)
    k = min(classes - 1, len(words))
    if not k:
        return out
    x = np.sqrt(neighbours[words] / np.maximum(neighbours[words].sum(1, keepdims=True), 1.0))
    weight = counts[words].astype(np.float64)
    frequent = np.argsort(-weight, kind="stable")
    centres = [x[frequent[0]]]
    away = ((x - centres[0]) ** 2).sum(1)
    while len(centres) < k:
        # Far from the others and frequent.
        at = int(np.argmax(away * weight))
        centres.append(x[at])
        away = np.minimum(away, ((x - x[at]) ** 2).sum(1))
    centres = np.array(centres)
    for _ in range(20):
        label = np.argmin(((centres**2).sum(1)[None] - 2 * x @ centres.T), 1)
        sums = np.zeros_like(centres)
        np.add.at(sums, label, x * weight[:, None])
        total = np.bincount(label, weight, k)
        centres = np.where(total[:, None] > 0, sums / np.maximum(total, 1e-9)[:, None], centres)
    out[:] = 1 + np.bincount(label, weight, k).argmax()
    out[words] = 1 + label
    out[first] = 0
    return out


# ---- training ----

def _each(docs: DataFrame, run, schema: str) -> DataFrame:
    small_batches(docs.sparkSession)
    return docs.select("text").mapInArrow(run, schema)


def _runs(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order of the words, and where each distinct one begins in it. Equal words have equal endings, so
    their own order does not matter and the sort need not be stable."""
    order = np.argsort(words)
    ordered = words[order]
    return order, np.flatnonzero(np.concatenate((np.ones(min(len(words), 1), np.bool_), ordered[1:] != ordered[:-1])))


def count_words(training: DataFrame) -> DataFrame:
    """(word, ending, n): how often every token occurs in the training texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = word_hash_tables(_SEPARATORS)
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        size, merged = 0, 0

        def merge() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
            words, ends, n = (np.concatenate(p) for p in zip(*held))
            order, starts = _runs(words)
            return words[order[starts]], ends[order[starts]], np.add.reduceat(n[order], starts)

        def out() -> pa.RecordBatch:
            words, ends, n = held[0]
            return pa.RecordBatch.from_pydict({"word": pa.array(words.view(np.int64)), "ending": pa.array(ends), "n": pa.array(n)})

        for batch in batches:
            for _, _, hashes, endings in tokens(batch.column(0).to_pylist(), tables):
                order, starts = _runs(hashes)
                held.append((hashes[order[starts]], endings[order[starts]], np.diff(starts, append=len(hashes)).astype(np.int64)))
                size += len(starts)
                if size > 2 * merged + 200_000:
                    held = [merge()]
                    size = merged = len(held[0][0])
                    if size > _HELD_WORDS:
                        yield out()
                        held, size, merged = [], 0, 0
        if held:
            held = [merge()]
            yield out()

    found = _each(training, run, "word bigint, ending int, n bigint")
    return materialize(found.groupBy("word", "ending").agg(F.sum("n").alias("n")), "words")


def _neighbours(training: DataFrame, model: dict) -> np.ndarray:
    """Occurrences of each bucket beside each kind of word, on the left and on the right."""
    kinds = LANDMARKS + REST_LANDMARKS
    total = OWN_CLASSED + ENDINGS
    sent = training.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables, model = word_hash_tables(_SEPARATORS), sent.value
        head = head_of(model)
        found = np.zeros(total * 2 * kinds, np.int64)
        for batch in batches:
            for _, lengths, hashes, endings in tokens(batch.column(0).to_pylist(), tables):
                _, bucket = buckets(model, head, hashes, endings)
                kind = np.where(bucket < LANDMARKS, bucket, LANDMARKS + bucket % REST_LANDMARKS)
                # Each text's end stands before its first word, too.
                left = np.concatenate((kind[-1:], kind[:-1]))
                left[np.cumsum(lengths) - lengths] = model["end_bucket"]
                right = np.concatenate((kind[1:], kind[:1]))
                for side, other in ((0, left), (1, right)):
                    found += np.bincount((bucket * 2 + side) * kinds + other, minlength=len(found))
        at = np.flatnonzero(found)
        for a in range(0, len(at), 50_000):
            yield pa.RecordBatch.from_pydict({"at": pa.array(at[a : a + 50_000].astype(np.int32)), "n": pa.array(found[at[a : a + 50_000]])})

    out = np.zeros(total * 2 * kinds)
    # As many rows as buckets times kinds of neighbours, whatever the corpus.
    got = _each(training, run, "at int, n bigint").groupBy("at").agg(F.sum("n").alias("n")).toArrow()
    out[got.column("at").to_numpy()] = got.column("n").to_numpy()
    sent.destroy()
    return out.reshape(total, 2 * kinds)


def _round(texts: DataFrame, model: dict, weights: np.ndarray, squares: np.ndarray, rate: float) -> tuple[np.ndarray, np.ndarray]:
    """Weights and squares after every task has gone through its texts; changes are averaged by row."""
    sent = texts.sparkSession.sparkContext.broadcast((model, weights, squares))
    width = weights.shape[1]

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = word_hash_tables(_SEPARATORS)
        model, given, before = sent.value
        head = head_of(model)
        mine, damped, met = given.copy(), before.copy(), np.zeros(len(given), np.float64)
        for batch in batches:
            for _, lengths, hashes, endings in tokens(batch.column(0).to_pylist(), tables):
                _, bucket = buckets(model, head, hashes, endings)
                rows, target = features(hashes, lengths), model["class"][bucket]
                for a in range(0, len(rows), STEP_TOKENS):
                    step(mine, damped, met, rows[a : a + STEP_TOKENS], target[a : a + STEP_TOKENS], rate)
        number = TaskContext.get().partitionId()
        for block in range(0, len(given), BLOCK):
            here = slice(block, block + BLOCK)
            if met[here].any():
                change = np.concatenate(((mine[here] - given[here]) * met[here, None], (damped[here] - before[here])[:, None], met[here, None]), 1)
                yield pa.RecordBatch.from_pydict({"block": pa.array([block], pa.int32()), "task": pa.array([number], pa.int32()), "change": pa.array([change.astype(np.float32).tobytes()], pa.binary())})

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, total = None, None
        for batch in batches:
            for block, change in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if block != held:
                    if held is not None:
                        yield pa.RecordBatch.from_pydict({"block": pa.array([held], pa.int32()), "change": pa.array([total.tobytes()], pa.binary())})
                    held, total = block, 0.0
                total = total + np.frombuffer(change, np.float32).astype(np.float64)
        if held is not None:
            yield pa.RecordBatch.from_pydict({"block": pa.array([held], pa.int32()), "change": pa.array([total.tobytes()], pa.binary())})

    # One row per block and task; the tasks' rows are added one after the other, in the same order each time.
    found = _each(texts, learn, "block int, task int, change binary")
    dealt = found.repartition("block").sortWithinPartitions("block", "task").select("block", "change")
    weights, squares = weights.copy(), squares.copy()
    for r in dealt.mapInArrow(add, "block int, change binary").collect():
        change = np.frombuffer(r.change, np.float64).reshape(-1, width + 2)
        here = slice(r.block, r.block + len(change))
        weights[here] += (change[:, :width] / np.maximum(change[:, -1:], 1.0)).astype(np.float32)
        squares[here] += change[:, width].astype(np.float32)
    sent.destroy()
    return weights, squares


def train(docs: DataFrame) -> dict:
    """The model of the training texts of (doc_id, text); ``words`` stays a table, all else is bounded."""
    training = docs.where(~held_out()).select("doc_id", "text")
    words = count_words(training)
    level = F.floor(F.log2("n") * 16).cast("int")
    levels = sorted(((r.level, r.words) for r in words.groupBy(level.alias("level")).agg(F.count("*").alias("words")).collect()), reverse=True)
    lowest, taken = None, 0
    for at, n in levels:
        if taken + n > HEAD:
            break
        lowest, taken = at, taken + n
    total = words.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count("*").alias("words")).first()
    # At most HEAD rows, by the choice of the lowest level.
    head = words.where(level >= lowest if lowest is not None else F.lit(False)).toArrow()
    hashes, n, ends = (head.column(c).to_numpy() for c in ("word", "n", "ending"))
    order = np.argsort(hashes.view(np.uint64))
    hashes, n, ends = hashes.view(np.uint64)[order], n[order], ends[order]
    own = np.full(len(hashes), -1)
    ranked = np.lexsort((hashes, -n))
    ranked = np.concatenate((ranked[hashes[ranked] == END], ranked[hashes[ranked] != END]))[:OWN_CLASSED]
    own[ranked] = np.arange(len(ranked))
    model = {"head": hashes, "n": n, "own": own, "end_bucket": 0, "tokens": int(total.n), "types": int(total.words)}

    # What the words of each ending have in common, less the words that stand for themselves.
    mass, types, once = (np.zeros(OWN_CLASSED + ENDINGS) for _ in range(3))
    by_ending = words.groupBy("ending").agg(F.sum("n").alias("n"), F.count("*").alias("words"), F.sum((F.col("n") == 1).cast("int")).alias("once"))
    for r in by_ending.collect():
        mass[OWN_CLASSED + r.ending], types[OWN_CLASSED + r.ending], once[OWN_CLASSED + r.ending] = r.n, r.words, r.once
    for a, per in ((mass, n), (types, np.ones(len(n))), (once, n == 1)):
        np.subtract.at(a, OWN_CLASSED + ends[ranked], per[ranked])
        a[: len(ranked)] = per[ranked]
    model["class"] = group_words(mass, _neighbours(training, model), CLASSES, 0) if total.n else np.zeros(len(mass), np.int32)
    width = int(model["class"].max()) + 1
    model["unseen"] = SMOOTH + np.bincount(model["class"], once, width)
    model["mass"] = np.bincount(model["class"], mass + SMOOTH * types, width) + model["unseen"]

    weights, squares = np.zeros((ROWS, width), np.float32), np.zeros(ROWS, np.float32)
    weights[0] = np.log(model["mass"] / model["mass"].sum())
    for number in range(ROUNDS if total.n and width > 1 else 0):
        share = training.where(F.pmod(F.xxhash64(F.lit(12), "doc_id"), F.lit(ROUNDS)) == number)
        weights, squares = _round(share, model, weights, squares, RATE[number])
    return model | {"weights": weights, "words": words}


# ---- scoring ----

def score(docs: DataFrame, trained: dict) -> DataFrame:
    """Per row of (doc_id, text): doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    spark = docs.sparkSession
    words = trained["words"]
    sent = spark.sparkContext.broadcast({k: v for k, v in trained.items() if k != "words"})
    given = docs.select("doc_id", held_out().alias("held_out"), "text").withColumn("row", F.monotonically_increasing_id())
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"row bigint, doc_id {kind}, held_out boolean, n_tokens bigint, n_known bigint, base double, score double, rare array<struct<word:bigint,kind:smallint>>"
    small_batches(spark)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables, model = word_hash_tables(_SEPARATORS), sent.value
        head = head_of(model)
        logs = np.log10(np.append(model["n"], 0) + SMOOTH)
        heavy = np.log10(model["mass"])
        for batch in batches:
            counts = [[] for _ in range(5)]
            for _, lengths, hashes, endings in tokens(batch.column(1).to_pylist(), tables):
                at, bucket = buckets(model, head, hashes, endings)
                classes = model["class"][bucket]
                rows = features(hashes, lengths)
                part = np.empty(len(rows))
                for a in range(0, len(rows), STEP_TOKENS):
                    here = slice(a, a + STEP_TOKENS)
                    x = logits(model["weights"], rows[here])
                    x -= x.max(1, keepdims=True)
                    chosen = x[np.arange(len(x)), classes[here]]
                    part[here] = chosen - np.log(np.exp(x, out=x).sum(1))
                known = at >= 0
                own = np.where(known, logs[at], 0.0)
                starts = np.cumsum(lengths) - lengths
                for to, values in zip(counts, (
                    lengths, np.add.reduceat(known.astype(np.int64), starts), np.add.reduceat(own, starts),
                    np.add.reduceat(part / np.log(10) + own - heavy[classes], starts),
                )):
                    to.append(values)
                counts[4].append((np.add.reduceat((~known).astype(np.int64), starts), hashes[~known].view(np.int64), classes[~known].astype(np.int16)))
            if not counts[0]:
                continue
            n, found, base, total = (np.concatenate(c) for c in counts[:4])
            rare, word, kinds = (np.concatenate(c) for c in zip(*counts[4]))
            offsets = np.concatenate(([0], np.cumsum(rare))).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.StructArray.from_arrays([pa.array(word), pa.array(kinds)], ["word", "kind"]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(3), batch.column(0), batch.column(2), pa.array(n.astype(np.int64)), pa.array(found), pa.array(base), pa.array(total), lists],
                ["row", "doc_id", "held_out", "n_tokens", "n_known", "base", "score", "rare"])

    scored = materialize(given.select("doc_id", "text", "held_out", "row").mapInArrow(run, schema), "scored")
    sent.destroy()
    unseen = F.array(*[F.lit(float(x)) for x in np.log10(trained["unseen"])])
    # Frequent words are no longer among these, so no word has more than a small part of the rows.
    rare = scored.select("row", F.explode("rare").alias("w")).select("row", F.col("w.word").alias("word"), F.col("w.kind").alias("kind"))
    looked = rare.join(words.select("word", "n"), "word", "left")
    own = F.log10(F.coalesce(F.col("n"), F.lit(0)) + SMOOTH)
    sums = looked.groupBy("row").agg(
        F.count("n").alias("more_known"), F.sum(own).alias("more_base"),
        F.sum(F.when(F.col("n").isNotNull(), own).otherwise(F.element_at(unseen, F.col("kind").cast("int") + 1))).alias("more_score"),
    )
    every = float(np.log10(trained["tokens"] + SMOOTH * (trained["types"] + 1)))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    return scored.drop("rare").join(sums, "row", "left").select(
        "doc_id", "held_out", "n_tokens", (F.col("n_known") + zero("more_known")).alias("n_known"),
        F.lit(trained["tokens"]).cast("long").alias("train_tokens"),
        (F.col("base") + zero("more_base") - F.col("n_tokens") * every).alias("base_score"),
        (F.col("score") + zero("more_score")).alias("score"),
    )
