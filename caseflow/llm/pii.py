"""Personal data by anchor expansion.

One Aho-Corasick pass over a text finds the anchors: at-signs, schemes, plus signs before a digit, digits next to
digits, and words that introduce an identifier. From each anchor a deterministic parser expands to the boundaries of its
kind and validates the result. No parser looks at a character more than a few times, so long runs stay linear.

Kinds. Base: ``email``, ``ip``, ``card``, ``phone``; leftmost non-overlapping matches of fixed patterns, of which the ones
that fail validation are dropped. Added: ``url`` (scheme anchors with a host that has a dot) and ``account`` (the value after
an identifier word and ``=`` or ``:``, six or more characters with a digit), ``iban`` (country letters and check digits at the
start of a word, solid or in blocks of four, whose remainder by 97 is 1) and ``key`` (a word with a public key prefix and the
prefix's least length).
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import column, slices

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "url", "account", "iban", "key")
CUES = ("password", "passwd", "token", "secret", "api_key", "apikey", "access_key", "account", "iban", "ssn")
#: Prefixes of access keys and the least number of characters after each.
KEY_PREFIXES = {"AKIA": 16, "AIza": 35, "ghp_": 36, "github_pat_": 22, "glpat-": 20, "sk_live_": 16, "xoxb-": 10, "xoxp-": 10}

#: What may stand on either side of an anchor.
LOCAL_PART = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DIGITS = frozenset("0123456789")
SCHEME = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+.-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
FOUR_PARTS = re.compile(r"[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
DIGIT_RUN = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
LOCATOR = re.compile(r"://(?:[^\s/?#@\"'<>]*@)?([A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+)(?::[0-9]+)?(?:[/?#][^\s\"'<>]*)?")
ASSIGNED = re.compile(r"[\"']?[ ]?[=:][ ]?[\"']?(?=[A-Za-z0-9_+/=.-])")
VALUE = re.compile(r"[A-Za-z0-9_+/=.-]+")
BANK = re.compile(r"[A-Z]{2}[0-9]{2}(?:[A-Z0-9]{11,30}|(?: [A-Z0-9]{4}){2,7}(?: [A-Z0-9]{1,3})?)(?![A-Za-z0-9])")
KEY = re.compile(r"[A-Za-z0-9_-]+")


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        x = ord(d) - 48
        total += x if i % 2 == 0 else x * 2 - 9 * (x > 4)
    return total % 10 == 0


def automaton() -> ahocorasick.Automaton:
    anchors = ahocorasick.Automaton()
    anchors.add_word("@", ("email", 1))
    anchors.add_word("://", ("url", 3))
    for a in "0123456789":
        anchors.add_word(f"+{a}", ("phone", 2))
        for b in "0123456789":
            anchors.add_word(f"{a}.{b}", ("ip", 3))
            anchors.add_word(f"{a}{b}", ("card", 2))
            anchors.add_word(f"{a} {b}", ("card", 3))
            anchors.add_word(f"{a}-{b}", ("card", 3))
    for b in "0123456789":
        for letter in "ABCDEFGHIJKLMNOPQRSTUVWXYZ":
            anchors.add_word(f"{letter}{b}", ("iban", 2))
    for prefix in KEY_PREFIXES:
        anchors.add_word(prefix, ("key", len(prefix)))
    for cue in CUES:
        for form in {cue, cue.upper(), cue.capitalize()}:
            anchors.add_word(form, ("account", len(form)))
    anchors.make_automaton()
    return anchors


class Finder:
    """Spans of one text at a time."""

    def __init__(self):
        self.anchors = automaton()

    def spans(self, text: str) -> list[tuple[int, int, int]]:
        """(start, kind's index in KINDS, end) in order, code points, end exclusive."""
        done = dict.fromkeys(KINDS, 0)  # where each kind's next match may start
        self.plain = 0  # end of the last value without a digit: what starts before it has none either
        out = []
        for last, (kind, width) in self.anchors.iter(text):
            at = last + 1 - width
            if at < done[kind]:
                continue
            found = getattr(self, kind)(text, at, done[kind])
            if found is not None:
                start, end, valid = found
                done[kind] = end
                if valid:
                    out.append((start, KINDS.index(kind), end))
        out.sort()
        return out

    # Each parser returns the match's start and end and whether it is valid, or None where nothing matches.

    def email(self, text: str, at: int, floor: int):
        start = at
        while start > floor and text[start - 1] in LOCAL_PART:
            start -= 1
        domain = DOMAIN.match(text, at + 1) if start < at else None
        return (start, domain.end(), True) if domain else None

    def ip(self, text: str, at: int, floor: int):
        start = at
        while start > floor and text[start - 1] in DIGITS:
            start -= 1
        found = FOUR_PARTS.match(text, start)
        if not found:
            return None
        return start, found.end(), all(len(p.lstrip("0")) <= 3 and int(p[-4:]) <= 255 for p in found[0].split("."))

    def card(self, text: str, at: int, floor: int):
        found = DIGIT_RUN.match(text, at)
        digits = found[0].replace(" ", "").replace("-", "") if found.end() - at <= 40 else ""
        return at, found.end(), 12 <= len(digits) <= 19 and luhn(digits)

    def phone(self, text: str, at: int, floor: int):
        found = PHONE.match(text, at)
        return (at, found.end(), 9 <= sum(c in DIGITS for c in found[0]) <= 15) if found else None

    def url(self, text: str, at: int, floor: int):
        start = at
        while start > floor and text[start - 1] in SCHEME:
            start -= 1
        found = LOCATOR.match(text, at) if start < at and text[start].isalpha() else None
        if not found:
            return None
        end = found.end()
        while end > found.end(1) and text[end - 1] in ".,;:!?)]}":
            end -= 1
        return start, end, True

    def account(self, text: str, at: int, floor: int):
        end = at
        while end < len(text) and (text[end].isalnum() or text[end] == "_") and end - at < 16:
            end += 1
        assigned = ASSIGNED.match(text, end)
        if not assigned or assigned.end() < self.plain:
            return None
        value = VALUE.match(text, assigned.end())
        if not any(c in DIGITS for c in value[0]):
            self.plain = value.end()
            return None
        return (value.start(), value.end(), True) if len(value[0]) >= 6 else None

    def iban(self, text: str, at: int, floor: int):
        start = at - 1
        if start < floor or start and text[start - 1].isalnum():
            return None
        found = BANK.match(text, start)
        if not found:
            return None
        solid = found[0].replace(" ", "")
        return start, found.end(), len(solid) <= 34 and int("".join(str(int(c, 36)) for c in solid[4:] + solid[:4])) % 97 == 1

    def key(self, text: str, at: int, floor: int):
        if at and (text[at - 1].isalnum() or text[at - 1] in "_-"):
            return None
        found = KEY.match(text, at)
        least = min(len(p) + n for p, n in KEY_PREFIXES.items() if text.startswith(p, at))
        return (at, found.end(), True) if found.end() - at >= least else None


_FINDER: list[Finder] = []


def find_personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id and ``spans array<struct<kind, start, end>>`` of every whole text, by start, then kind as listed.

    One narrow pass without a shuffle. Null and empty texts have no spans; null and repeated ids keep their rows; an empty
    table gives no rows; other columns are not carried, so their names cannot clash.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    span = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())])
    kinds = pa.array(KINDS, pa.string())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not _FINDER:
            _FINDER.append(Finder())
        finder = _FINDER[0]
        for whole in batches:
            for batch in slices(whole, "text"):
                found = [finder.spans(t) if t else [] for t in column(batch, "text").to_pylist()]
                flat = [s for spans in found for s in spans]
                ends = [0]
                for spans in found:
                    ends.append(ends[-1] + len(spans))
                names = kinds.take(pa.array([s[1] for s in flat], pa.int32()))
                parts = [names, pa.array([s[0] for s in flat], pa.int32()), pa.array([s[2] for s in flat], pa.int32())]
                spans = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.StructArray.from_arrays(parts, fields=list(span)))
                yield pa.RecordBatch.from_arrays([column(batch, "id"), spans], ["id", "spans"])

    return rows.mapInArrow(run, "id long, spans array<struct<kind:string,start:int,end:int>>").withColumnRenamed("id", id_col)


def mask_personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id and ``masked string``: each span replaced by its kind in square brackets (of overlapping spans the first stands)."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))

    def masked(finder: Finder, text: str) -> str:
        out, at = [], 0
        for start, kind, end in finder.spans(text):
            if start >= at:
                out += [text[at:start], f"[{KINDS[kind]}]"]
                at = end
        return "".join([*out, text[at:]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not _FINDER:
            _FINDER.append(Finder())
        for whole in batches:
            for batch in slices(whole, "text"):
                texts = [masked(_FINDER[0], t) if t else "" for t in column(batch, "text").to_pylist()]
                yield pa.RecordBatch.from_arrays([column(batch, "id"), pa.array(texts, pa.string())], ["id", "masked"])

    return rows.mapInArrow(run, "id long, masked string").withColumnRenamed("id", id_col)
