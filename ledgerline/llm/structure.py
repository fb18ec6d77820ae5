"""Repair of the structure of conversations: roles that alternate, no blank, repeated or cut-off turns.

A good conversation is empty, or an optional system turn and then pairs of user and assistant. Every turn
is kept (0), given the role that fits (2) or deleted (3; blank and repeated turns have to be), turns
without text are inserted where a role is missing (2), and a cut-off turn that stays costs 1 more. The
cheapest list of edits is wanted, of equally cheap ones the first in ASCII order.

What is left to do from a turn on depends on the turns behind it alone: on the rest of the
conversation's signature (one letter per turn for its role and fault) and on the state of the
grammar. Signatures are therefore sorted by their reversed text, so that those with a common ending follow one
another; a sweep keeps the nodes of the current ending, and goes back only as far as the next
signature differs. Endings are minimised further: two of them are the same node when in all four
states of the grammar they have the same first edit and costs that differ by the same number, so
``Endings`` computes cost and best edit of a node and state once, and a node points to the one behind it instead
of holding the audit as text. Each task of the sweep has the nodes it needs; nothing is shared between tasks.

Signatures are made without gathering a conversation: equal turns are counted first, first
occurrences come from a window over equal turns, and a range partitioning by conversation and turn, whose bounds
may lie inside a conversation, is read in order. The pieces are then put together, a letter per turn.
Only the repaired texts of one conversation go through one task, in order and batch by batch, because
their SHA-256 is of all of them; nothing but the audit is held in memory there.

Defined results: a null role or text is one space; null turns come first; turns of one number go by
role, then by a digest of role and text. A null conv_id is a conversation. Roles count by their first
letter, those with another one (or none) are never kept. Columns with other names are not read. An empty table
gives no rows; conversations of which no row is left have zeros and an empty audit.
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql import types as T

from ledgerline.llm.common import small_batches
from ledgerline.session import materialize

BLANKS = " \t\n\x0b\f\r"
FINAL = (".", "!", "?")
# A letter per turn: four initials (s, u, a, other) by four faults (none, truncated, blank, duplicate).
LETTERS = "ABCDEFGHIJKLMNOP"
# Its part in the repair: capitals may be kept, small letters are truncated, x has to go.
SIGNATURE = "SsxxUuxxAaxxOoxx"

# States of the grammar: at the start, after system, after user, after assistant.
START, SYSTEM, USER, ASSISTANT = range(4)
FITTING = (USER, USER, ASSISTANT, USER)
ROLE_OF = {USER: "user", ASSISTANT: "assistant"}
KEPT = {("s", START): SYSTEM, ("u", START): USER, ("u", SYSTEM): USER, ("u", ASSISTANT): USER, ("a", USER): ASSISTANT}
DELETE, INSERT, REROLE, TRUNCATED = 3, 2, 2, 1
_NONE = 1 << 40


class Endings:
    """Nodes of the automaton of endings: per state of the grammar the first edit of the best
    audit and its cost above the node's cheapest state. Made once each, found by what they are."""

    def __init__(self):
        self.nodes: list[tuple[tuple[int, ...], str]] = []
        self._number: dict[tuple[tuple[int, ...], str], int] = {}
        self._before: dict[tuple[int, str], tuple[int, int]] = {}
        self.end, self.end_cost = self._node([0, _NONE, _NONE, 0], [{}, {}, {}, {}])

    def _node(self, costs: list[int], edits: list[dict[str, int]]) -> tuple[int, int]:
        while True:
            inserted = [INSERT + costs[FITTING[g]] for g in range(4)]
            better = [min(c, i) for c, i in zip(costs, inserted)]
            if better == costs:
                break
            costs = better
        firsts = ""
        for g in range(4):
            options = edits[g] | {"I": inserted[g]}
            # At the end of an accepted conversation there is nothing to do.
            firsts += min((e for e, c in options.items() if c == costs[g]), default=".")
        least = min(costs)
        key = (tuple(c - least for c in costs), firsts)
        if key not in self._number:
            self._number[key] = len(self.nodes)
            self.nodes.append(key)
        return self._number[key], least

    def before(self, node: int, letter: str) -> tuple[int, int]:
        """The node of an ending with one more turn in front, and what its cost has more."""
        known = self._before.get((node, letter))
        if known is None:
            behind = self.nodes[node][0]
            edits = []
            for g in range(4):
                options = {"D": DELETE + behind[g]}
                if letter != "x":
                    more = TRUNCATED if letter.islower() else 0
                    to = KEPT.get((letter.lower(), g))
                    if to is not None:
                        options["K"] = more + behind[to]
                    options["R"] = REROLE + more + behind[FITTING[g]]
                edits.append(options)
            known = self._before[(node, letter)] = self._node([min(o.values()) for o in edits], edits)
        return known


class Sweep:
    """Best audits of signatures that come in the order of their reversed text."""

    def __init__(self):
        self.endings = Endings()
        self.path = ""
        self.nodes = array("i", [self.endings.end])
        self.costs = array("q", [self.endings.end_cost])
        self.best = (0, "")

    def audit(self, reversed_signature: str) -> tuple[int, str]:
        if reversed_signature == self.path:
            return self.best
        same = _common(self.path, reversed_signature)
        del self.nodes[same + 1 :], self.costs[same + 1 :]
        node, cost = self.nodes[-1], self.costs[-1]
        for letter in reversed_signature[same:]:
            node, more = self.endings.before(node, letter)
            cost += more
            self.nodes.append(node)
            self.costs.append(cost)
        self.path = reversed_signature
        self.best = (cost + self.endings.nodes[node][0][START], self._read(reversed_signature))
        return self.best

    def _read(self, reversed_signature: str) -> str:
        nodes, known = self.nodes, self.endings.nodes
        edits = []
        at, state = len(reversed_signature), START
        while True:
            edit = known[nodes[at]][1][state]
            if edit == ".":
                return "".join(edits)
            edits.append(edit)
            if edit == "K":
                state = KEPT[reversed_signature[at - 1].lower(), state]
            elif edit != "D":
                state = FITTING[state]
            if edit != "I":
                at -= 1


def _common(a: str, b: str) -> int:
    """Length of the common beginning."""
    if b.startswith(a):
        return len(a)
    low, high = 0, min(len(a), len(b))
    while low < high:
        middle = (low + high + 1) // 2
        low, high = (middle, high) if a[low:middle] == b[low:middle] else (low, middle - 1)
    return low


# ---- signatures ----

def turns(df: DataFrame) -> DataFrame:
    """The four columns that are read, and ``digest`` of role and text."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("role", "text"))
    digest = F.unhex(F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary")))
    return df.select("conv_id", F.col("turn").cast("long").alias("turn"), role.alias("role"), text.alias("text"), digest.alias("digest"))


def _letter(initial: Column, fault: Column) -> Column:
    return F.substring(F.lit(LETTERS), initial * 4 + fault + 1, F.lit(1))


def _coded(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, role, digest, codes): equal turns of one number together, a letter for each."""
    end = F.rtrim("text", F.lit(BLANKS))
    fault = F.when(end == "", 2).when(F.substring(end, -1, 1).isin(*FINAL), 0).otherwise(1)
    together = rows.groupBy("conv_id", "turn", "role", "digest").agg(F.count("*").alias("n"), F.min(fault).alias("fault"))
    seen = F.row_number().over(Window.partitionBy("conv_id", "digest").orderBy(F.col("turn").asc_nulls_first())) > 1
    first = F.substring("role", 1, 1)
    initial = F.when(first == "s", 0).when(first == "u", 1).when(first == "a", 2).otherwise(3)
    fault = F.col("fault")
    codes = F.concat(
        _letter(initial, F.when((fault != 2) & F.col("seen"), 3).otherwise(fault)),
        F.repeat(_letter(initial, F.when(fault == 2, 2).otherwise(3)), (F.col("n") - 1).cast("int")),
    )
    return together.withColumn("seen", seen).select("conv_id", "turn", "role", "digest", codes.alias("codes"))


def _pieces(coded: DataFrame) -> DataFrame:
    """Per conversation and partition that holds some of it: letters in order, and its turn numbers."""
    order = ["conv_id", "turn", "role", "digest"]
    dealt = coded.repartitionByRange(*order).sortWithinPartitions(*order).select("conv_id", "turn", "codes")
    schema = T.StructType([
        coded.schema["conv_id"], T.StructField("piece", T.IntegerType()), T.StructField("codes", T.StringType()),
        T.StructField("low", T.LongType()), T.StructField("high", T.LongType()), T.StructField("turns", T.LongType()),
    ])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        piece = TaskContext.get().partitionId()
        held: list[list] = []
        for batch in batches:
            for conv, turn, codes in zip(*[c.to_pylist() for c in batch.columns]):
                if not held or held[-1][0] != conv:
                    if len(held) > 1000:
                        yield _batch(held, piece, arrow)
                        held = []
                    held.append([conv, [], None, None, 0])
                now = held[-1]
                now[1].append(codes)
                if turn is not None and turn != now[3]:
                    now[2] = turn if now[2] is None else now[2]
                    now[3] = turn
                    now[4] += 1
        if held:
            yield _batch(held, piece, arrow)

    return dealt.mapInArrow(run, schema)


def _batch(held: list[list], piece: int, arrow: pa.Schema) -> pa.RecordBatch:
    rows = [(conv, piece, "".join(codes), low, high, n) for conv, codes, low, high, n in held]
    return pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(zip(*rows), arrow)], schema=arrow)


_COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def report(rows: DataFrame, conversations: DataFrame | None = None) -> DataFrame:
    """Per conversation (those of ``rows`` and of ``conversations``): conv_id, gaps, blank, duplicate,
    truncated, illegal, cost and audit."""
    small_batches(rows.sparkSession)
    found = _pieces(_coded(turns(rows)))
    every = (rows if conversations is None else conversations).select("conv_id").distinct()
    kind = found.schema
    nothing = [F.lit(None).cast(f.dataType).alias(f.name) for f in kind.fields[1:]]
    both = found.unionByName(every.select("conv_id", *nothing))
    part = F.when(F.col("piece").isNotNull(), F.struct(*[f.name for f in kind.fields[1:]]))
    # As many entries as partitions hold rows of the conversation.
    whole = both.groupBy("conv_id").agg(F.sort_array(F.collect_list(part)).alias("parts"))
    codes = F.array_join(F.transform("parts", lambda p: p.codes), "")
    spans = F.transform("parts", lambda p: F.struct(p.low.alias("low"), p.high.alias("high"), p.turns.alias("turns")))
    whole = whole.select("conv_id", codes.alias("codes"), spans.alias("spans"))
    ending = F.reverse(F.translate("codes", LETTERS, SIGNATURE))
    whole = whole.withColumn("ending", ending)
    # The id behind the ending divides a frequent signature over tasks.
    dealt = whole.repartitionByRange("ending", "conv_id").sortWithinPartitions("ending")
    schema = T.StructType([
        whole.schema["conv_id"], *[T.StructField(c, T.LongType()) for c in _COUNTS], T.StructField("audit", T.StringType()),
    ])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sweep = Sweep()
        for batch in batches:
            out = []
            for conv, codes, spans, ending in zip(*[c.to_pylist() for c in batch.columns]):
                out.append((conv, _gaps(spans), *_faults(codes), *sweep.audit(ending)))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(zip(*out), arrow)], schema=arrow)

    return dealt.mapInArrow(run, schema)


def _gaps(spans: list[dict]) -> int:
    spans = [s for s in spans if s["turns"]]
    if not spans:
        return 0
    different = sum(s["turns"] for s in spans) - sum(a["high"] == b["low"] for a, b in zip(spans, spans[1:]))
    return min(spans[-1]["high"] - spans[0]["low"] + 1 - different, 2**63 - 1)


def _faults(codes: str) -> tuple[int, int, int, int]:
    """Blank, duplicate, truncated turns, and neighbours whose roles do not follow each other."""
    at = np.frombuffer(codes.encode(), np.uint8) - 65
    counts = np.bincount(at % 4, minlength=4)
    a, b = at[:-1] // 4, at[1:] // 4
    legal = ((a == 0) & (b == 1)) | ((a == 1) & (b == 2)) | ((a == 2) & (b == 1))
    return int(counts[2]), int(counts[3]), int(counts[1]), int(len(a) - legal.sum())


# ---- the edits applied ----

def _edited(rows: DataFrame, audits: DataFrame, begin: Callable, turn: Callable, end: Callable, schema: T.StructType) -> DataFrame:
    """Go through every conversation of ``audits`` in order: its row (``begin``), each turn of the
    repaired conversation (``turn``), its end (``end``); what these return are output rows."""
    given = turns(rows)
    extra = [f for f in audits.schema if f.name not in ("conv_id", "audit")]
    none = [F.lit(None).cast(f.dataType).alias(f.name) for f in extra]
    heads = audits.select(
        "conv_id", F.lit(0).alias("kind"), F.lit(None).cast("long").alias("turn"), F.lit(None).cast("string").alias("role"),
        F.lit(None).cast("binary").alias("digest"), F.col("audit").alias("text"), *[f.name for f in extra],
    )
    both = heads.unionByName(given.select("conv_id", F.lit(1).alias("kind"), "turn", "role", "digest", "text", *none))
    dealt = both.repartition("conv_id").sortWithinPartitions("conv_id", "kind", "turn", "role", "digest")
    dealt = dealt.select("conv_id", "kind", "role", "text", *[f.name for f in extra])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, place, audit, at, state = None, None, "", 0, START
        out: list[tuple] = []

        def inserts() -> None:
            nonlocal at, state
            while at < len(audit) and audit[at] == "I":
                state = FITTING[state]
                out.extend(turn(held, place, "I", ROLE_OF[state], ""))
                at += 1

        for batch in batches:
            for conv, kind, role, text, *rest in zip(*[c.to_pylist() for c in batch.columns]):
                if kind == 0:
                    if held is not None:
                        inserts()
                        out.extend(end(held))
                    held, audit, at, state, place = begin(conv, rest, text), text, 0, START, conv
                    continue
                inserts()
                edit = audit[at]
                at += 1
                if edit == "K":
                    state = KEPT[role[0], state]
                    out.extend(turn(held, place, "K", role, text))
                elif edit == "R":
                    state = FITTING[state]
                    out.extend(turn(held, place, "R", ROLE_OF[state], text))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(zip(*out), arrow)], schema=arrow)
                out.clear()
        if held is not None:
            inserts()
            out.extend(end(held))
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(zip(*out), arrow)], schema=arrow)

    return dealt.mapInArrow(run, schema)


def repaired(rows: DataFrame, audits: DataFrame) -> DataFrame:
    """The repaired conversations turn by turn: conv_id, place (from 0), edit, role, text."""
    schema = T.StructType([
        rows.schema["conv_id"], T.StructField("place", T.LongType()), T.StructField("edit", T.StringType()),
        T.StructField("role", T.StringType()), T.StructField("text", T.StringType()),
    ])

    def turn(held: list[int], conv, edit: str, role: str, text: str) -> list[tuple]:
        held[0] += 1
        return [(conv, held[0] - 1, edit, role, text)]

    return _edited(rows, audits.select("conv_id", "audit"), lambda conv, rest, audit: [0], turn, lambda held: [], schema)


def digests(rows: DataFrame, audits: DataFrame) -> DataFrame:
    """``audits`` with ``repaired_sha256``, of the repaired turns as role:text, joined by newlines."""
    extra = [f for f in audits.schema if f.name not in ("conv_id", "audit")]
    schema = T.StructType([
        audits.schema["conv_id"], *extra, T.StructField("audit", T.StringType()), T.StructField("repaired_sha256", T.StringType()),
    ])

    def begin(conv, rest: list, audit: str) -> list:
        return [conv, rest, audit, hashlib.sha256(), b""]

    def turn(held: list, conv, edit: str, role: str, text: str) -> list[tuple]:
        held[3].update(held[4] + f"{role}:{text}".encode())
        held[4] = b"\n"
        return []

    def end(held: list) -> list[tuple]:
        return [(held[0], *held[1], held[2], held[3].hexdigest())]

    return _edited(rows, audits, begin, turn, end, schema)


def damaged(df: DataFrame) -> DataFrame:
    """The conversations with known faults, by a checksum of id and turn: turns dropped, emptied, cut
    off, repeated or given to the user."""
    space = F.lit(" ")
    number = lambda c: F.coalesce(F.col(c).cast("string"), space)
    key = F.concat(number("conv_id"), F.lit(":"), number("turn"))
    kind = F.crc32(key.cast("binary")) % 20
    role, text = (F.coalesce(F.col(c), space) for c in ("role", "text"))
    copies = F.explode(F.when(kind == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy")
    return df.where(kind != 0).select(
        "conv_id", "turn", F.when(kind == 4, F.lit("user")).otherwise(role).alias("role"),
        F.when(kind == 1, F.lit("")).when(kind == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"), copies,
    ).drop("copy")


def repair(rows: DataFrame, conversations: DataFrame | None = None) -> DataFrame:
    """The report of every conversation with the digest of its repaired form."""
    return digests(rows, materialize(report(rows, conversations), "audits"))
