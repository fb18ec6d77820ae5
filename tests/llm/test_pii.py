import random
import re
import time
from hashlib import sha256

import edge
import pytest

from ledgerline.llm import pii as P

NORMAL = P.Normaliser()


def plain(text):
    """The base by the defining patterns."""
    def valid(digits):
        total = 0
        for i, n in enumerate(map(int, reversed(digits))):
            total += n if i % 2 == 0 else sum(map(int, str(2 * n)))
        return 13 <= len(digits) <= 19 and total % 10 == 0

    only = lambda s: re.sub("[^0-9]", "", s)
    found = {
        "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    }
    keep = {
        "email": lambda s: True, "ip": lambda s: all(int(x) <= 255 for x in s.split(".")),
        "card": lambda s: valid(only(s)), "phone": lambda s: 9 <= len(only(s)) <= 15,
    }
    return {k: [m.span() for m in re.finditer(p, text) if keep[k](m.group())] for k, p in found.items()}


def test_base_against_the_defining_patterns():
    rnd = random.Random(3)
    for _ in range(8000):
        letters = rnd.choice(["ab.@-1", "0123456789.", "01 -23456789", "+12 ()34567.-89", "a@.b@c-._"])
        text = "".join(rnd.choice(letters) for _ in range(rnd.randint(0, 60)))
        assert P.detect(text) == plain(text), text


DISGUISED = [
    ("email", "write to ", "john at example dot com", " now"),
    ("email", "", "john [at] example [dot] com", ""),
    ("email", "an ", "anna.b(at)mail(dot)example(dot)org", "!"),
    ("email", "mail ", "jоhn@exаmple.com", " please"),
    ("email", "", "j\u200bohn@exam\u200bple.com", "."),
    ("email", "to ", "first_dot_last_at_example_dot_net", ", thanks"),
    ("email", "ask ", "KIM AT EXAMPLE DOT ORG", ""),
    ("email", "schreib an ", "max arroba ejemplo punto es", ""),
    ("email", "write to ", "jane at firma dot pl", " today"),
    ("email", "", "bob at startup dot xyz", "."),
    ("email", "to ", "jane at example dot co dot nz", ", please"),
    ("ip", "host ", "192 dot 168 dot 1 dot 10", " is down"),
    ("phone", "call ", "plus four nine one five one two three four five six seven", " today"),
    ("phone", "tel ", "＋１ ５５５ １２３ ４５６７", ""),
    ("phone", "tel ", "+1 five five five, 1 2 3 4 five six seven", " ok"),
    ("phone", "ruf ", "plus vier neun eins fünf eins zwo drei vier fünf", " an"),
    ("ip", "at host ", "one nine two dot one six eight dot one dot one", " there"),
    ("ip", "", "192[.]168[.]1[.]10", " x"),
    ("ip", "on ", "l92.l68.O.1", " now"),
    ("card", "pay ", "４１１１ １１１１ １１１１ １１１１", ""),
    ("card", "pay ", "four one one one, one one one one one one one one one one one one", " soon"),
]


@pytest.mark.parametrize("kind,before,hidden,after", DISGUISED)
def test_disguises_are_found_at_their_place(kind, before, hidden, after):
    base, added = P.spans_of(before + hidden + after, NORMAL)
    assert not any(base.values())
    assert added == {k: [(len(before), len(before) + len(hidden))] if k == kind else [] for k in P.KINDS}


@pytest.mark.parametrize("text", [
    "Meet me at example.com today", "Look at this dot on the wall", "One or two of three or four were left at the point.",
    "Stand at the dot in the middle and at each point of the line", "We met at one point under the bridge", "Chapter 3 point 4 says so",
    "un deux trois, nous irons au bois", "The period dot matrix at noon", "Version 1.2.3 came out in 2019-10-11", "α + β = γ at best",
])
def test_clean_text_is_left_alone(text):
    assert P.spans_of(text, NORMAL) == ({k: [] for k in P.KINDS},) * 2


def test_base_finds_stay_beside_wider_ones():
    base, added = P.spans_of("jane(dot)doe@example.org", NORMAL)
    assert base["email"] == [(9, 24)] and added["email"] == [(0, 24)]


@pytest.mark.parametrize(("kind", "text"), [
    ("email", "jane [ at ] example.com"), ("email", "jane ( at ) example.com"), ("email", "jane < at > example.com"),
    ("email", "jane@example [ . ] com"), ("email", "jane_AT_example.com"), ("email", "jane@example . com"),
    ("phone", "plus four/nine/one/five/one/two/three/four/five/six"),
    ("phone", "plus (four)(nine)(one)(five)(one)(two)(three)(four)(five)(six)"),
])
def test_no_disguise_needs_another_hint(kind, text):
    assert P.spans_of(text, NORMAL)[1][kind] == [(0, len(text) - text.endswith(")"))]


def test_gates_leave_out_nothing(monkeypatch):
    rnd = random.Random(12)
    parts = ["jane", "example", "com", "at", "AT", "At", "dot", "DOT", "punkt", "arroba", "plus", "four", "nine", "one", "oh", "double", "7", "15"]
    marks = [" ", " ", " ", "  ", "\n", ".", " . ", "@", " @ ", "-", "_", "/", "(", ")", "[ ", " ]", "<", ">", ", "]
    texts = ["".join(rnd.choice(parts) + rnd.choice(marks) for _ in range(rnd.randint(2, 14))) for _ in range(20_000)]
    gated = [P.spans_of(t, NORMAL) for t in texts]
    monkeypatch.setattr(P, "_is_spoken", lambda lower: True)
    monkeypatch.setattr(P, "_is_address", lambda text, lower: True)
    assert gated == [P.spans_of(t, NORMAL) for t in texts]


def test_time_follows_length():
    for text in ["a" * 200_000, "1." * 100_000, "a@" * 100_000, "+1" * 100_000, "one " * 50_000, " at " * 50_000, "a dot " * 30_000, "x at " + "b dot " * 30_000, "а" * 100_000]:
        start = time.time()
        P.spans_of(text, NORMAL)
        assert time.time() - start < 10


def test_awkward_documents(spark):
    rows = {}
    for r in P.digests(P.find(edge.docs(spark, edge.ROWS + [edge.row(30, "é a@b.co, 1.2.3.4 (a at b dot com)")]))).collect():
        rows.setdefault(r.doc_id, r)
    r = rows[30]
    assert (r.n_email, r.n_ip, r.n_card, r.n_phone, r.n_added) == (1, 1, 0, 0, 1)
    assert r.base_sha256 == sha256(b"email:2:8,ip:10:17").hexdigest()
    assert r.spans == "email:2:8,email:19:33,ip:10:17"
    assert rows[3].base_sha256 == sha256(b"").hexdigest() and rows[None].n_email == 0
    assert P.find(edge.empty(spark)).collect() == []


def test_redact(spark):
    docs = edge.simple(spark, ["é a@b.co, 1.2.3.4 (a at b dot com)", None, "clean"])
    left = {r.doc_id: r for r in P.redact(docs).collect()}
    assert left[0].text == "é [email], [ip] ([email])" and left[0].n_chars == len(left[0].text)
    assert left[1].text is None and left[2].text == "clean" and P.redact(docs).columns == docs.columns


def test_recall_on_planted_addresses():
    """Spoken addresses under endings of any kind, in sentences: nearly all are found, where they stand."""
    rnd = random.Random(3)
    letters = "abcdefghijklmnopqrstuvwxyz"

    def name(a, b):
        return "".join(rnd.choice(letters) for _ in range(rnd.randint(a, b)))

    found, n = 0, 400
    for _ in range(n):
        ending = name(3, 6)
        hidden = rnd.choice(["{} at {} dot {}", "{}(at){}(dot){}", "{} [at] {} [dot] {}", "{} AT {} DOT {}", "{}_at_{}_dot_{}"]).format(name(4, 9), name(4, 9), ending)
        text = f"Send it to {hidden}, please."
        found += P.spans_of(text, NORMAL)[1]["email"] == [(11, 11 + len(hidden))]
    assert found >= 0.97 * n
