import hashlib
import random
import re
import zlib
from functools import lru_cache

import pytest
from pyspark.sql import types as T

from ledgerline.llm import structure as S

TALKS = T.StructType([
    T.StructField("conv_id", T.LongType()), T.StructField("turn", T.LongType()), T.StructField("role", T.StringType()),
    T.StructField("text", T.StringType()), T.StructField("codes", T.StringType()), T.StructField("audit", T.DoubleType()),
])
GOOD = re.compile(r"(s?(ua)+)?")


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 0.0) for r in rows], TALKS)


def cheapest(symbols):
    """(cost, audit, roles and rows of the result), by trying every edit; ``symbols`` are (initial, fault)."""

    @lru_cache(None)
    def go(at, made, fresh):
        # made: the last two role initials and whether there are more is all the grammar needs.
        options = []
        if at == len(symbols):
            if GOOD.fullmatch(made):
                options.append((0, "", ()))
        else:
            initial, fault = symbols[at]
            options.append(step(3, "D", at + 1, made, 0, None))
            if fault not in ("blank", "duplicate"):
                more = fault == "truncated"
                options.append(step(more, "K", at + 1, made + initial, 0, (at, None)))
                options += [step(2 + more, "R", at + 1, made + r, 0, (at, r)) for r in "ua"]
        if fresh < 3:
            options += [step(2, "I", at, made + r, fresh + 1, (None, r)) for r in "ua"]
        options = [o for o in options if o]
        return min(options, key=lambda o: o[:2], default=None)

    def step(cost, edit, at, made, fresh, turn):
        if not re.fullmatch(r"s?(ua)*u?", made):
            return None
        # Equal futures: what was made matters by its beginning and its end only.
        if len(made) > 4:
            made = made[:-4] + made[-2:] if made[-4:-2] == made[-2:] else made
        rest = go(at, made, fresh)
        return rest and (cost + rest[0], edit + rest[1], ((turn,) if turn else ()) + rest[2])

    return go(0, "", 0)


def brute(talks):
    """The contract's columns by conversation, straight from its rules."""
    found = {}
    for conv in {r[0] for r in talks}:
        rows = []
        for c, turn, role, text in talks:
            if c != conv:
                continue
            role, text = " " if role is None else role, " " if text is None else text
            kind = zlib.crc32(f"{' ' if c is None else c}:{' ' if turn is None else turn}".encode()) % 20
            if kind == 0:
                continue
            text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
            rows += [(turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
        digest = lambda r: hashlib.md5(f"{len(r[1])}:{r[1]}{r[2]}".encode()).digest()
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], digest(r)))
        faults = []
        for i, (_, role, text) in enumerate(rows):
            end = text.rstrip(" \t\n\x0b\f\r")
            earlier = any(r[1:] == (role, text) for r in rows[:i])
            faults.append("blank" if not end else "duplicate" if earlier else "truncated" if end[-1] not in ".!?" else "")
        initials = [r[1][:1] or "-" for r in rows]
        numbers = [r[0] for r in rows if r[0] is not None]
        cost, audit, made = cheapest(tuple(zip(initials, faults))) if rows else (0, "", ())
        name = {"u": "user", "a": "assistant"}
        said = [(name[r] if r else rows[i][1]) + ":" + (rows[i][2] if i is not None else "") for i, r in made]
        found[conv] = (
            max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0,
            *[faults.count(f) for f in ("blank", "duplicate", "truncated")],
            sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])),
            cost, audit, hashlib.sha256("\n".join(said).encode()).hexdigest(),
        )
    return found


def by_query(spark, talks):
    given = frame(spark, talks)
    got = S.repair(S.damaged(given), given).collect()
    assert len(got) == len({r.conv_id for r in got})
    return {r.conv_id: tuple(r[c] for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")) for r in got}


def random_talks(seed, n):
    rnd = random.Random(seed)
    talks = []
    for conv in range(n):
        for turn in range(rnd.choice([0, 1, 1, 2, 3, 5, 8])):
            role = rnd.choice(["system", "user", "assistant", "user", "assistant", "tool", "", None])
            text = rnd.choice(["Good.", "Good.", "Why?", "cut", " \n", "", None, "Done! \t", "a.b", "Ja… ", "x" * rnd.randrange(3)])
            talks.append((conv, rnd.choice([turn, turn, turn, turn + 3, None]), role, text))
    return talks


def test_against_every_edit(spark):
    talks = random_talks(1, 250)
    assert by_query(spark, talks) == brute(talks)


def test_awkward_rows(spark):
    talks = [
        (None, 0, "user", "Hi."), (None, 1, "assistant", "Yes."), (3, None, "user", None), (3, None, None, "ok."),
        (4, 5, "user", "same."), (4, 5, "user", "same."), (4, 5, "assistant", "same."), (5, -(2**62), "user", "a."), (5, 2**62, "assistant", "b."),
        (6, 1, "user", "Line.\n" * 100_000), (6, 2, "assistant", "漢字 😀!"),
    ]
    assert by_query(spark, talks) == brute(talks)
    assert by_query(spark, []) == {}


@pytest.fixture
def apart(spark):
    """Small partitions stay as they are."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_one_conversation_of_very_many_turns(spark, apart):
    """Its letters come from several partitions, its repaired turns go by one after the other."""
    talks = [(0, t, "user" if t % 2 == 0 else "assistant", f"Turn {t}.") for t in range(30_000)] + [(1, 0, "user", "Hi.")]
    given = frame(spark, talks).repartition(5)
    audits = S.report(given)
    got = {r.conv_id: r for r in audits.collect()}
    assert got[0].audit == "K" * 30_000 and got[0].cost == 0 and got[0].gaps == 0 and got[0].illegal == 0
    assert (got[1].audit, got[1].cost) == ("KI", 2)
    made = S.repaired(given, audits).where("conv_id = 0").orderBy("place").collect()
    assert [(r.role, r.text) for r in made] == [r[2:] for r in talks[:-1]]
    assert S._pieces(S._coded(S.turns(given))).where("conv_id = 0").count() > 1


@pytest.mark.parametrize("seed", [2, 3])
def test_nodes_are_few_and_right(seed):
    """Any signature gets the audit of full search, whatever came before it in the sweep."""
    rnd = random.Random(seed)
    fault = {"S": ("s", ""), "s": ("s", "truncated"), "U": ("u", ""), "u": ("u", "truncated"), "A": ("a", ""),
             "a": ("a", "truncated"), "O": ("o", ""), "o": ("o", "truncated"), "x": ("u", "blank")}
    signatures = {"".join(rnd.choice("SsUuUuAaAaOox") for _ in range(rnd.randrange(9))) for _ in range(1500)}
    sweep = S.Sweep()
    for back in sorted(s[::-1] for s in signatures):
        assert sweep.audit(back) == cheapest(tuple(fault[c] for c in back[::-1]))[:2], back[::-1]
    assert len(sweep.endings.nodes) < 100
