"""Personal data, found in the text as written and behind disguises, with places in the source text.

The text as written is searched first. Then transducers rewrite it: look-alike characters become plain ones and invisible
ones vanish, spelled-out digits become digits, and at/dot disguises become ``@`` and ``.``. Each keeps, for every
character it writes, the source characters that it stands for, so what is found in the rewritten text is reported by
its place in the source. A span from there counts only if a transducer has changed something in it.

All searches take time linear in the text: where a pattern could begin at every character of a long run, runs are
taken whole and cut up.

Defined results: null text is empty, an empty table gives no rows, rows with one id are judged each by itself. All columns of
``docs`` come back in the struct ``doc``, so no name can clash.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KINDS = ("email", "ip", "card", "phone")
SPANS = "array<struct<kind:string,start:long,end:long,value:string,base:boolean>>"


class Span(NamedTuple):
    start: int
    end: int
    kind: str


# Detectors. Each yields (start, end) from left to right, not overlapping.

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DOTTED = re.compile(r"[0-9]++(?:\.[0-9]++)*+")
_NUMBER = re.compile(r"[0-9]+")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_NO_DIGIT = re.compile(r"[^0-9]+")


def emails(text: str) -> Iterator[tuple[int, int]]:
    done = 0  # no match may begin before
    at = text.find("@")
    while at >= 0:
        start = at
        while start > done and (text[start - 1].isascii() and (text[start - 1].isalnum() or text[start - 1] in "._%+-")):
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            yield start, domain.end()
            done = domain.end()
        else:
            done = at + 1
        at = text.find("@", done)


def addresses(text: str) -> Iterator[tuple[int, int]]:
    for run in _DOTTED.finditer(text):
        if run.end() - run.start() < 7:
            continue
        numbers = list(_NUMBER.finditer(text, run.start(), run.end()))
        for i in range(0, len(numbers) - 3, 4):
            four = numbers[i : i + 4]
            if all(len(n.group().lstrip("0")) <= 3 and int(n.group().lstrip("0") or 0) <= 255 for n in four):
                yield four[0].start(), four[3].end()


def cards(text: str) -> Iterator[tuple[int, int]]:
    for found in _CARD.finditer(text):
        if 14 <= found.end() - found.start() <= 37:
            digits = _NO_DIGIT.sub("", found.group())
            if 14 <= len(digits) <= 19 and luhn(digits):
                yield found.span()


def phones(text: str) -> Iterator[tuple[int, int]]:
    for found in _PHONE.finditer(text):
        if 10 <= sum("0" <= c <= "9" for c in found.group()) <= 15:
            yield found.span()


def luhn(digits: str) -> bool:
    doubled = [2 * int(d) - 9 * (d > "4") for d in digits[-2::-2]]
    return (sum(doubled) + sum(map(int, digits[-1::-2]))) % 10 == 0


_DETECTORS: dict[str, Callable[[str], Iterator[tuple[int, int]]]] = {
    "email": emails,
    "ip": addresses,
    "card": cards,
    "phone": phones,
}


def detect(text: str) -> list[Span]:
    """All spans of a text as written, by start, then kind."""
    found = [Span(start, end, kind) for kind in KINDS for start, end in _DETECTORS[kind](text)]
    return sorted(found, key=_place)


def _place(span: Span) -> tuple[int, int, int]:
    return span.start, KINDS.index(span.kind), span.end


# Transducers. Each takes a text to a list of edits (start, end, written), in order and not overlapping.

Edits = list[tuple[int, int, str]]

# Letters of other scripts that look like these, and signs that stand for these.
_LOOK_ALIKES = {
    "a": "аɑα", "c": "сϲ", "e": "е", "i": "іı", "j": "ј", "o": "оο",
    "p": "рρ", "s": "ѕ", "x": "х", "y": "у", "h": "һ", "k": "κ", "v": "ν", "n": "ո",
    "A": "АΑ", "B": "ВΒ", "C": "С", "E": "ЕΕ", "H": "НΗ", "I": "ІΙ",
    "K": "КΚ", "M": "МΜ", "N": "Ν", "O": "ОΟ", "P": "РΡ", "T": "ТΤ",
    "X": "ХΧ", "Y": "Υ", "Z": "Ζ",
    ".": "․。｡", "-": "‐‑‒–—−﹣", "@": "﹫", "+": "﹢",
    " ": "\u00a0\u2007\u2009\u202f\u3000",
    "": "\u00ad\u200b\u200c\u200d\u2060\ufeff",
}
# First characters of the decimal digits of other scripts; each stands before the other nine.
_DIGIT_ROWS = "٠۰०০๐０"


def _plain_characters() -> dict[str, str]:
    table = {alike: plain for plain, alikes in _LOOK_ALIKES.items() for alike in alikes}
    table |= {chr(ord(zero) + digit): str(digit) for zero in _DIGIT_ROWS for digit in range(10)}
    # Full-width forms stand in the order of the characters from ! to ~.
    return table | {chr(code + 0xFEE0): chr(code) for code in range(0x21, 0x7F)}


_PLAIN = _plain_characters()
_STRANGE = re.compile("[" + "".join(map(re.escape, _PLAIN)) + "]")


def plain_characters(text: str) -> Edits:
    if text.isascii():
        return []
    return [(m.start(), m.end(), _PLAIN[m.group()]) for m in _STRANGE.finditer(text)]


# Fixed values.
_DIGIT_WORDS = {
    "zero": "0", "oh": "0", "one": "1", "two": "2", "three": "3", "four": "4", "five": "5",
    "six": "6", "seven": "7", "eight": "8", "nine": "9",
}
_DIGIT_WORD = "(?:" + "|".join(_DIGIT_WORDS) + ")"
#: So many spelled-out digits in a row are digits; fewer are words, but for a dotted or dashed one beside a digit.
LEAST_DIGIT_WORDS = 3
_SPELLED = re.compile(rf"(?i)(?<![A-Za-z]){_DIGIT_WORD}(?:[ ,-]{{1,2}}{_DIGIT_WORD}){{{LEAST_DIGIT_WORDS - 1},}}+(?![A-Za-z])")
_ONE_SPELLED = re.compile(rf"(?i){_DIGIT_WORD}")
# A letter that looks like a digit, among digits.
_LETTER_DIGIT = re.compile(r"(?<=[0-9])[OoIl](?=[0-9])")


def spelled_digits(text: str) -> Edits:
    edits = []
    for run in _SPELLED.finditer(text):
        at = run.start()
        for word in _ONE_SPELLED.finditer(text, run.start(), run.end()):
            # What stands between two digits goes with the second.
            edits.append((at, word.end(), _DIGIT_WORDS[word.group().lower()]))
            at = word.end()
    for letter in _LETTER_DIGIT.finditer(text):
        edits.append((letter.start(), letter.end(), "0" if letter.group() in "Oo" else "1"))
    return sorted(edits)


# A sign in brackets, or a word that only an address would have there.
_BRACKETED = re.compile(r"(?i)[ \t]{0,3}[(\[{<][ \t]{0,3}(at|@|dot|\.|plus)[ \t]{0,3}[)\]}>][ \t]{0,3}")
# "look at the dot" is no address.
_BARE_AT = re.compile(
    r"(?i)(?<=[A-Za-z0-9_%+-])[ \t]{1,3}at[ \t]{1,3}(?!(?:a|an|the|this|that|my|your|our|his|her|its|their|every|each|one|at|dot)[ \t])"
    r"(?=[A-Za-z0-9-]{1,63}(?:(?:[ \t]{1,3}dot[ \t]{1,3}|[ \t]{0,3}[(\[{<][ \t]{0,3}(?:dot|\.)[ \t]{0,3}[)\]}>][ \t]{0,3})[A-Za-z0-9-]{1,63})+)"
)
_BARE_DOT = re.compile(r"(?i)(?<=[A-Za-z0-9-])[ \t]{1,3}dot[ \t]{1,3}(?=[A-Za-z0-9-])")
_SIGNS = {"at": "@", "@": "@", "dot": ".", ".": ".", "plus": "+"}


def at_and_dot(text: str) -> Edits:
    edits = [(m.start(), m.end(), _SIGNS[m.group(1).lower()]) for m in _BRACKETED.finditer(text)]
    edits += [(m.start(), m.end(), "@") for m in _BARE_AT.finditer(text)]
    edits += [(m.start(), m.end(), ".") for m in _BARE_DOT.finditer(text)]
    kept: Edits = []
    for edit in sorted(edits):
        if not kept or edit[0] >= kept[-1][1]:
            kept.append(edit)
    return kept


TRANSDUCERS = (plain_characters, spelled_digits, at_and_dot)


class Rewritten:
    """A text with, for each of its characters, the source characters from ``starts`` to ``ends`` that it stands for, and
    whether a transducer wrote it."""

    def __init__(self, text: str) -> None:
        self.text = text
        self.starts = np.arange(len(text))
        self.ends = self.starts + 1
        self.written = np.zeros(len(text), bool)
        self.changed = False

    def apply(self, edits: Edits) -> None:
        if not edits:
            return
        texts, starts, ends, written, at = [], [], [], [], 0
        gone = np.zeros(len(self.text) + 1, bool)  # before which characters something vanished
        for start, end, new in edits:
            texts += [self.text[at:start], new]
            starts += [self.starts[at:start], np.repeat(self.starts[start], len(new))]
            ends += [self.ends[at:start], np.repeat(self.ends[end - 1], len(new))]
            written += [self.written[at:start], np.ones(len(new), bool)]
            if not new:
                gone[end] = True
            at = end
        texts.append(self.text[at:])
        starts.append(self.starts[at:])
        ends.append(self.ends[at:])
        written.append(self.written[at:] | gone[at:-1])
        for i, (start, _, _) in enumerate(edits):
            # The plain stretch before an edit begins where the edit before it ended.
            begin = edits[i - 1][1] if i else 0
            written[2 * i] = self.written[begin:start] | gone[begin:start]
        self.text = "".join(texts)
        self.starts, self.ends, self.written = map(np.concatenate, (starts, ends, written))
        self.changed = True


def rewrite(text: str) -> Rewritten:
    rewritten = Rewritten(text)
    for transducer in TRANSDUCERS:
        rewritten.apply(transducer(rewritten.text))
    return rewritten


def find(text: str) -> list[tuple[str, int, int, str, bool]]:
    """(kind, start, end, value, base) of all spans, by start, kind and end. ``value`` is the rewritten text of a disguised span."""
    base = detect(text)
    found = [(s, text[s.start : s.end], True) for s in base]
    rewritten = rewrite(text)
    if rewritten.changed:
        known = {kind: [s for s in base if s.kind == kind] for kind in KINDS}
        for span in detect(rewritten.text):
            if not rewritten.written[span.start : span.end].any():
                continue
            source = Span(int(rewritten.starts[span.start]), int(rewritten.ends[span.end - 1]), span.kind)
            if not _inside(source, known[span.kind]):
                found.append((source, rewritten.text[span.start : span.end], False))
    found.sort(key=lambda one: (_place(one[0]), not one[2]))
    return [(s.kind, s.start, s.end, value, is_base) for s, value, is_base in found]


def _inside(span: Span, known: list[Span]) -> bool:
    """Whether one of ``known``, in order and not overlapping, holds the whole span."""
    low, high = 0, len(known)
    while low < high:
        middle = (low + high) // 2
        low, high = (middle + 1, high) if known[middle].start <= span.start else (low, middle)
    return low > 0 and known[low - 1].end >= span.end


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kind = pa.list_(
        pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("value", pa.string()), ("base", pa.bool_())])
    )
    names = ("kind", "start", "end", "value", "base")
    for batch in batches:
        spans = [[dict(zip(names, span)) for span in find(text or "")] for text in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("doc"), pa.array(spans, kind)], ["doc", "spans"])


def find_personal_data(docs: DataFrame) -> DataFrame:
    """doc (all columns of ``docs``) and spans: kind, start, end (code points, end exclusive), value, base."""
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), "text")
    schema = f"doc {rows.schema['doc'].dataType.simpleString()}, spans {SPANS}"
    return rows.mapInArrow(_scan, schema)
