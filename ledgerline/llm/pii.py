"""Personal data, also where it is disguised, found at its place in the source text.

Detectors look for e-mail and IP addresses, card and phone numbers. They run on the text as it
is (the base), and on a normalised form of it made by a chain of transducers: look-alike
letters, full-width forms and foreign digits become ASCII; invisible characters go; letters
that stand for digits inside numbers and spelled-out digits become digits; "at" and "dot" in
their usual disguises become @ and a full stop. Every transducer keeps, for each character it
writes, where in its input that came from, so a find is mapped back to the characters of the
source. Normalised finds are added to the base; a find inside a base find of its kind is not.

All detectors and transducers take time in proportion to the text.

Defined results: null counts as empty and has no spans; spans are in code points, end
exclusive; repeated rows get repeated results; other columns are ignored by ``find`` and pass
through ``redact``.
"""

from __future__ import annotations

import re
import unicodedata
from bisect import bisect_right
from collections.abc import Callable, Iterator
from hashlib import sha256
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import map_rows, rewrite_text

KINDS = ["email", "ip", "card", "phone"]
Span = tuple[int, int]

# ---- detectors ----

_DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGIT = re.compile("[0-9]")


def emails(text: str) -> Iterator[Span]:
    """From every @ with a domain, back over the characters of a name that no earlier find has taken.

    A name's characters exclude @, so no character is passed twice.
    """
    end = 0
    at = text.find("@")
    while at >= 0:
        m = _DOMAIN.match(text, at)
        if m:
            start = at
            while start > end and text[start - 1] in _LOCAL:
                start -= 1
            if start < at:
                end = m.end()
                yield start, end
                at = text.find("@", end)
                continue
        at = text.find("@", at + 1)


def ips(text: str) -> Iterator[Span]:
    for m in _IP.finditer(text):
        parts = [p.lstrip("0") for p in m.group().split(".")]
        if all(len(p) <= 3 and int(p or 0) <= 255 for p in parts):
            yield m.span()


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = int(c) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def cards(text: str) -> Iterator[Span]:
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 13:
            digits = m.group().replace(" ", "").replace("-", "")
            if 13 <= len(digits) <= 19 and luhn(digits):
                yield m.span()


def phones(text: str) -> Iterator[Span]:
    if "+" not in text:
        return
    for m in _PHONE.finditer(text):
        if 9 <= len(_DIGIT.findall(m.group())) <= 15:
            yield m.span()


_DETECTORS: dict[str, Callable[[str], Iterator[Span]]] = {"email": emails, "ip": ips, "card": cards, "phone": phones}


def detect(text: str) -> dict[str, list[Span]]:
    return {kind: list(find(text)) for kind, find in _DETECTORS.items()}


# ---- transducers ----


class Alignment:
    """Where the pieces of a transducer's output came from: copied or rewritten stretches of its input."""

    def __init__(self) -> None:
        self.out: list[str] = []
        self.starts: list[int] = []
        self.pieces: list[tuple[int, int, bool]] = []
        self.length = 0

    def add(self, text: str, start: int, end: int, copied: bool) -> None:
        if text:
            self.starts.append(self.length)
            self.pieces.append((start, end, copied))
            self.out.append(text)
            self.length += len(text)

    def source(self, span: Span) -> Span:
        """The input characters that an output span stands for."""
        i, j = bisect_right(self.starts, span[0]) - 1, bisect_right(self.starts, span[1] - 1) - 1
        start, _, copied = self.pieces[i]
        if copied:
            start += span[0] - self.starts[i]
        first, end, copied = self.pieces[j]
        if copied:
            end = first + span[1] - self.starts[j]
        return start, end


def rewritten(text: str, changes: Iterator[tuple[int, int, str]]) -> tuple[str, Alignment] | None:
    """The text with (start, end, new) put in, in order, and where everything came from; None if nothing changes."""
    out, at = Alignment(), 0
    for start, end, new in changes:
        out.add(text[at:start], at, start, True)
        out.add(new, start, end, False)
        at = end
    if not at:
        return None
    out.add(text[at:], at, len(text), True)
    return "".join(out.out), out


# Letters of other scripts and the Latin letters that they look like.
_LOOK_ALIKES = {
    "а": "a", "в": "b", "е": "e", "ё": "e", "к": "k", "м": "m", "н": "h", "о": "o", "р": "p", "с": "c", "т": "t", "у": "y",
    "х": "x", "і": "i", "ї": "i", "ј": "j", "ѕ": "s", "ԁ": "d", "ԛ": "q", "ԝ": "w", "һ": "h", "ɡ": "g", "ı": "i", "ӏ": "l",
    "А": "A", "В": "B", "Е": "E", "К": "K", "М": "M", "Н": "H", "О": "O", "Р": "P", "С": "C", "Т": "T", "У": "Y", "Х": "X",
    "І": "I", "Ј": "J", "Ѕ": "S", "α": "a", "ο": "o", "ν": "v", "ρ": "p", "ι": "i", "κ": "k", "τ": "t", "υ": "u", "χ": "x",
    "ε": "e", "γ": "y", "Α": "A", "Β": "B", "Ε": "E", "Ζ": "Z", "Η": "H", "Ι": "I", "Κ": "K", "Μ": "M", "Ν": "N", "Ο": "O",
    "Ρ": "P", "Τ": "T", "Υ": "Y", "Χ": "X", "․": ".", "。": ".", "｡": ".", "﹒": ".", "﹫": "@", "‐": "-", "‑": "-", "‒": "-",
    "–": "-", "—": "-", "−": "-", "﹣": "-", "﹢": "+", "⁺": "+", "₊": "+",
}
_INVISIBLE = "­͏᠎​‌‍‎‏⁠⁡⁢⁣⁤﻿"


def _character_map() -> dict[int, str]:
    """One character for one: look-alikes, full-width forms, digits and spaces of any script, mathematical letters."""
    found = {ord(a): b for a, b in _LOOK_ALIKES.items()}
    for c in range(0x80, 0x20000):
        char = chr(c)
        digit = unicodedata.decimal(char, None)
        if digit is None:
            digit = unicodedata.digit(char, None)
        if digit is not None:
            found[c] = str(digit)
        elif unicodedata.category(char) == "Zs":
            found[c] = " "
        elif c >= 0x2000 and len(plain := unicodedata.normalize("NFKC", char)) == 1 and 0x20 < ord(plain) < 0x7F:
            found.setdefault(c, plain)
    return found


# The digits as words.
_DIGIT_WORDS = {
    "zero": "0", "oh": "0", "one": "1", "two": "2", "three": "3", "four": "4", "five": "5", "six": "6", "seven": "7", "eight": "8",
    "nine": "9", "null": "0", "eins": "1", "zwei": "2", "zwo": "2", "drei": "3", "vier": "4", "fünf": "5", "sechs": "6",
    "sieben": "7", "acht": "8", "neun": "9", "zéro": "0", "un": "1", "deux": "2", "trois": "3", "quatre": "4", "cinq": "5",
    "sept": "7", "huit": "8", "neuf": "9", "cero": "0", "uno": "1", "dos": "2", "tres": "3", "cuatro": "4", "cinco": "5",
    "seis": "6", "siete": "7", "ocho": "8", "nueve": "9",
}
_TIMES = {"double": 2, "triple": 3}
_PLUS = {"plus", "más"}
_DOTS = {"dot", "point", "period", "punkt", "punto"}
_WORD_OR_NUMBER = re.compile(r"[^\W\d_]+|[0-9]+")
_BETWEEN = re.compile(r"[\s,./()\-]{1,4}")
_AS_DIGIT = {"o": "0", "O": "0", "l": "1", "I": "1", "i": "1", "|": "1", "S": "5", "B": "8"}
_MIXED_NUMBER = re.compile(r"(?<![A-Za-z0-9])(?:(?=[OolIi|SB]{0,24}[0-9])[0-9OolIi|SB]{1,24}|(?<=[0-9][ .-])[OolI]{1,3}(?=[ .-][0-9OolI]))(?![A-Za-z0-9])")

# Endings of names that any kind of dot may lead to.
_ENDINGS = "com|org|net|edu|gov|mil|int|info|biz|io|co|ai|app|dev|me|de|fr|es|uk|us|eu|ch|at|it|nl|be|ca|au|mx|ar|example|test"
# Words that follow a "dot" in plain prose; any other word of two letters or more behind a spoken dot ends a name.
_PROSE = (
    "on|in|of|the|and|or|to|is|was|as|by|an|that|this|for|with|from|under|over|above|below|between|are|were|has|had|which|who|where|when|"
    "matrix|plot|product|und|der|die|das|im|am|auf|ist|war|von|mit|et|ou|le|la|les|des|du|sur|dans|est|el|los|las|en|con|que|por|para"
)
# A run of white space is entered at its first character only, which keeps the time in proportion.
_GAP = r"(?:(?<!\s)\s++)?"
_BRACKETED_AT = rf"{_GAP}[\[({{<]\s*(?:at|arroba|@)\s*[\])}}>]\s*"
_BRACKETED_DOT = rf"{_GAP}[\[({{<]\s*(?:dot|punto|punkt|point|\.)\s*[\])}}>]\s*"
_BRACKETED = re.compile(rf"(?P<at>{_BRACKETED_AT})|(?P<dot>{_BRACKETED_DOT})", re.IGNORECASE)
_JOIN_DOT = r"(?:\.|\s+\.\s+|[\s_-]+(?:dot|punto|punkt|point)[\s_-]+)"
_JOIN_AT = re.compile(rf"{_GAP}@\s*|(?:(?<![\s_-])|(?<=\s)(?=[_-]))[\s_-]++(?:at|arroba)[\s_-]+", re.IGNORECASE)
_NAME_BEFORE = re.compile(rf"(?<![A-Za-z0-9%+.])[A-Za-z0-9._%+-]{{1,64}}?(?:{_JOIN_DOT}[A-Za-z0-9%+-]{{1,64}}?){{0,3}}?\Z", re.IGNORECASE)
_SAID_DOT = r"[\s_-]+(?:dot|punto|punkt|point)[\s_-]+"
_ENDING = rf"(?:{_JOIN_DOT}(?:{_ENDINGS})|{_SAID_DOT}(?!(?:{_PROSE})(?![A-Za-z]))[A-Za-z]{{2,24}})(?![A-Za-z0-9])"
_LABELS = rf"[A-Za-z0-9-]{{1,63}}?(?:{_JOIN_DOT}[A-Za-z0-9-]{{1,63}}?)"
# A name goes on while a dot leads to one more ending, as in "example dot co dot nz".
_HOST_AFTER = re.compile(rf"{_LABELS}{{0,4}}?{_ENDING}(?:{_ENDING}){{0,3}}", re.IGNORECASE)
_NAME_REACH = 120
_SPOKEN_DOT = re.compile(r"\s+\.\s+|[\s_-]+(?:dot|punto|punkt|point)[\s_-]+", re.IGNORECASE)
# What the address transducers cannot do without: a word or sign of _JOIN_DOT or _JOIN_AT, a lone full stop, an "at" that is
# not in small letters, or a bracketed "at" (a bracketed dot has one of the words or is found here).
_HINTS = ("@", "arroba", "dot", "punkt", "punto", "point")
_HINT = re.compile(r"[\[({<]\s*(?:[Aa][Tt]|\.)\s*[\])}>]|\s\.\s|[\s_-](?:A[Tt]|aT)[\s_-]")
_LETTERS = re.compile(r"[^\W\d_]+")


def _spoken_numbers(text: str) -> Iterator[tuple[int, int, str]]:
    """Runs of digit words and numbers with at most a short gap in between, as digits without the gaps.

    A run counts from three digit words on, or with three spoken dots between numbers. "plus" before
    it, "dot" inside it and "double" are heard as well.
    """
    run: list[tuple[int, int, str]] = []
    spoken = 0

    def flush() -> Iterator[tuple[int, int, str]]:
        while run and run[-1][2] in (".", "x2", "x3", "+"):
            run.pop()
        if spoken < 3 and sum(new == "." for _, _, new in run) < 3:
            return
        times = 1
        for k, (start, end, new) in enumerate(run):
            if k and start > run[k - 1][1]:
                gap = text[run[k - 1][1] : start]
                yield run[k - 1][1], start, "." if "." in gap and run[k - 1][2] != "." and new != "." else ""
            if new in ("x2", "x3"):
                times = int(new[1])
                yield start, end, ""
            else:
                yield start, end, new * times
                times = 1

    for m in _WORD_OR_NUMBER.finditer(text):
        word = m.group().lower()
        new = _DIGIT_WORDS.get(word) or (word if word.isdigit() else "." if word in _DOTS else "+" if word in _PLUS else None)
        new = new or (f"x{_TIMES[word]}" if word in _TIMES else None)
        near = run and _BETWEEN.fullmatch(text, run[-1][1], m.start())
        if run and (new is None or not near or new == "+"):
            yield from flush()
            run, spoken = [], 0
        if new is not None and (run or new != "."):
            run.append((m.start(), m.end(), new))
            spoken += word in _DIGIT_WORDS
    yield from flush()


def _mixed_numbers(text: str) -> Iterator[tuple[int, int, str]]:
    for m in _MIXED_NUMBER.finditer(text):
        if not m.group().isdigit():
            yield m.start(), m.end(), "".join(_AS_DIGIT.get(c, c) for c in m.group())


def _plain_addresses(text: str) -> Iterator[tuple[int, int, str]]:
    end = 0
    for at in _JOIN_AT.finditer(text):
        host = _HOST_AFTER.match(text, at.end())
        if not host or at.start() < end:
            continue
        reach = max(end, at.start() - _NAME_REACH)
        name = _NAME_BEFORE.search(text[reach : at.start()])
        if not name:
            continue
        changes = [(d.start(), d.end(), ".") for d in _SPOKEN_DOT.finditer(text, reach + name.start(), at.start())]
        changes += [(d.start(), d.end(), ".") for d in _SPOKEN_DOT.finditer(text, at.end(), host.end())]
        if "@" not in at.group() and not changes and at.group().strip(" _-").islower():
            # "at" before a name that is written as usual is an ordinary word.
            continue
        if at.group() != "@":
            changes.append((at.start(), at.end(), "@"))
        yield from sorted(changes)
        end = host.end()


def _is_spoken(lower: str) -> bool:
    """Whether there are three digit words or three spoken dots, without which no run counts."""
    words = _LETTERS.findall(lower)
    return sum(map(_DIGIT_WORDS.__contains__, words)) >= 3 or sum(map(_DOTS.__contains__, words)) >= 3


def _is_address(text: str, lower: str) -> bool:
    return any(hint in lower for hint in _HINTS) or _HINT.search(text) is not None


class Normaliser:
    """The chain of transducers; each is left out where a cheap look shows that it has nothing to do."""

    def __init__(self) -> None:
        self.characters = _character_map()
        self.odd = frozenset(map(chr, self.characters))
        self.invisible = re.compile(f"[{_INVISIBLE}]")

    def steps(self, text: str) -> tuple[str, list[Alignment], bool]:
        """The normalised text, the alignments of its steps in order, and whether anything changed."""
        found: list[Alignment] = []
        changed = False
        if not text.isascii() and not self.odd.isdisjoint(set(text)):
            text, changed = text.translate(self.characters), True

        def step(changes: Iterator[tuple[int, int, str]]) -> None:
            nonlocal text, changed
            if (got := rewritten(text, changes)) is not None:
                text, changed = got[0], True
                found.append(got[1])

        if not text.isascii():
            step((m.start(), m.end(), "") for m in self.invisible.finditer(text))
        if _is_spoken(text.lower()):
            step(_spoken_numbers(text))
        if any(c in text for c in "0123456789"):
            step(_mixed_numbers(text))
        if _is_address(text, text.lower()):
            step((m.start(), m.end(), "@" if m.group("at") else ".") for m in _BRACKETED.finditer(text))
            step(_plain_addresses(text))
        return text, found, changed

    def added(self, text: str, base: dict[str, list[Span]]) -> dict[str, list[Span]]:
        """Finds of the normalised text, at their places in the source, that no base find covers."""
        normal, alignments, changed = self.steps(text)
        out: dict[str, list[Span]] = {kind: [] for kind in KINDS}
        if not changed:
            return out
        for kind, spans in detect(normal).items():
            known = base[kind]
            starts = [a for a, _ in known]
            for span in spans:
                for alignment in reversed(alignments):
                    span = alignment.source(span)
                i = bisect_right(starts, span[0]) - 1
                if i < 0 or known[i][1] < span[1]:
                    out[kind].append(span)
        return out


def spans_of(text: str | None, normaliser: Normaliser) -> tuple[dict[str, list[Span]], dict[str, list[Span]]]:
    """Base spans and added spans by kind."""
    base = detect(text or "")
    return base, normaliser.added(text or "", base)


def find(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: key and spans, an array of (kind, start, end, base) by kind and start."""

    def each(batches: Iterator[dict[str, list]]) -> Iterator[dict[str, Any]]:
        normaliser = Normaliser()
        for batch in batches:
            rows = []
            for doc in batch["text"]:
                base, more = spans_of(doc, normaliser)
                rows.append([
                    {"kind": kind, "start": a, "end": b, "base": own}
                    for kind in KINDS
                    for a, b, own in sorted([(*s, True) for s in base[kind]] + [(*s, False) for s in more[kind]])
                ])
            yield {"key": batch["key"], "spans": rows}

    kind = docs.schema[key].dataType.simpleString()
    given = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    schema = f"key {kind}, spans array<struct<kind: string, start: int, end: int, base: boolean>>"
    return map_rows(given, each, schema).withColumnRenamed("key", key)


def redact(docs: DataFrame) -> DataFrame:
    """``docs`` with every span of ``text`` replaced by its kind in brackets."""
    held: list[Normaliser] = []

    def mask(text: str) -> str:
        if not held:
            held.append(Normaliser())
        base, more = spans_of(text, held[0])
        spans = sorted((a, -b, kind) for kind in KINDS for a, b in base[kind] + more[kind])
        out, at = [], 0
        for a, b, kind in spans:
            if -b > at:
                out += [text[at:a], f"[{kind}]"] if a >= at else []
                at = -b
        return "".join([*out, text[at:]])

    return rewrite_text(docs, [], mask)


def _is(kind: str) -> Callable[[Column], Column]:
    return lambda span: span["kind"] == kind


def _written(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def digests(found: DataFrame, key: str = "doc_id") -> DataFrame:
    """Per document: base finds by kind, SHA-256 of the base spans, all spans as text, and finds added."""
    base = F.filter("spans", lambda s: s["base"])
    counts = [F.size(F.filter(base, _is(kind))).cast("long").alias(f"n_{kind}") for kind in KINDS]
    return found.select(
        key, *counts, F.sha2(_written(base), 256).alias("base_sha256"), _written(F.col("spans")).alias("spans"),
        F.size(F.filter("spans", lambda s: ~s["base"])).cast("long").alias("n_added"),
    )
