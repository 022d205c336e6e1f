"""License scans: exact phrases, and fuzzy search for short notices.

A notice searched with k errors is cut into k + 1 pieces; a place with at most k errors holds one piece
unchanged, so exact search for the pieces finds every candidate. The regex library's bounded-error matching then
checks the text around each candidate and gives the span and the number of edits.
"""

from __future__ import annotations

import bisect
import heapq
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

#: The phrases of the base scan and their labels.
PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}
#: Notices for the fuzzy search: label and the characters that may be wrong, missing or too many.
NOTICES = {
    "under the mit license": ("mit", 2),
    "apache license version 2": ("apache-2", 2),
    "licensed under cc by nc": ("cc-by-nc", 2),
    "gnu general public license": ("gpl", 2),
    "gnu lesser general public license": ("lgpl", 3),
    "mozilla public license": ("mpl", 2),
    "bsd 3 clause license": ("bsd-3", 1),
    "all rights reserved": ("all-rights-reserved", 1),
}
#: Bytes of a word stay (A-Z in lower case), all others become a space; bytes above 127 belong to words.
_WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b > 127 else 32 for b in range(256)
)
SCHEMA = (
    "n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, "
    "score double, spans array<struct<label: string, start_word: long, n_words: long, edits: int, text: string>>"
)


def normal(text: str | None) -> list[bytes]:
    """The words of a text in UTF-8: runs of a-z, 0-9 and characters beyond ASCII, A-Z in lower case."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_WORD_BYTES).split()


def _places(text: bytes, what: bytes) -> Iterator[int]:
    at = text.find(what)
    while at >= 0:
        yield at
        at = text.find(what, at + 1)


class NoticeSearch:
    """One notice: its seeds with their offsets, and the bounded-error pattern."""

    def __init__(self, notice: str, label: str, errors: int) -> None:
        self.notice, self.label, self.errors = notice, label, errors
        cuts = [len(notice) * i // (errors + 1) for i in range(errors + 2)]
        self.seeds = [(a, notice[a:b].encode()) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
        # Whole words only: an edit may not eat into a neighbouring word's inside and call the rest a match.
        self.pattern = regex.compile(rf"(?b)(?<= )(?:{regex.escape(notice, special_only=True)}){{e<={errors}}}(?= )")

    def _best(self, text: bytes, low: int, high: int) -> tuple[int, int, int] | None:
        """(edits, start, end) of the best match in a stretch of the text."""
        if high - low < len(self.notice) - self.errors + 2:
            return None
        # Latin-1 keeps one character a byte, so positions stay byte positions.
        match = self.pattern.search(text[low:high].decode("latin-1"))
        return match and (sum(match.fuzzy_counts), low + match.start(), low + match.end())

    def spans(self, text: bytes) -> list[tuple[int, int, int]]:
        """(start, end, edits) of matches that do not overlap, those with the fewest edits first, then the leftmost.

        Each candidate has a stretch of its own, too short for two matches side by side. A match is taken unless it
        overlaps one already taken; what then is left of its stretch on both sides is searched again, so no place
        is lost to a better one beside it, and the time grows with the candidates only.
        """
        reach = len(self.notice) + self.errors
        near = {at - offset for offset, seed in self.seeds for at in _places(text, seed)}
        found: list[tuple[int, int, int, int, int]] = []

        def search(low: int, high: int) -> None:
            if best := self._best(text, low, high):
                heapq.heappush(found, (*best, low, high))

        for start in near:
            search(max(0, start - 2 * self.errors - 2), min(len(text), start + reach + 2 * self.errors + 2))
        taken: list[tuple[int, int, int]] = []
        while found:
            edits, start, end, low, high = heapq.heappop(found)
            i = bisect.bisect_left(taken, (end,))
            if i and taken[i - 1][1] > start:
                start, end, _ = taken[i - 1]
            else:
                taken.insert(i, (start, end, edits))
            search(low, start)
            search(end, high)
        return taken


def scan(text: str | None, searches: list[NoticeSearch], phrases: dict[str, str]) -> tuple:
    """One row of ``SCHEMA``."""
    words = normal(text)
    line = b" " + b" ".join(words) + b" "
    spaces: list[int] = []

    def word_at(byte: int) -> int:
        """The word that the space at or before ``byte`` opens; the spaces are found once a text, if at all."""
        if not spaces:
            spaces.extend(np.flatnonzero(np.frombuffer(line, "u1") == 32).tolist())
        return bisect.bisect_right(spaces, byte) - 1

    starts, base = [], set()
    for phrase, label in phrases.items():
        for at in _places(line, f" {phrase} ".encode()):
            starts.append(word_at(at))
            base.add(label)
    spans, score = [], 1.0 if base else 0.0
    for search in searches:
        for low, high, edits in search.spans(line):
            score = max(score, 1.0 - edits / len(search.notice))
            piece = line[low:high]
            n = len(piece.split())
            spans.append((search.label, word_at(low - 1), n, edits, piece.decode("utf-8", "replace")))
    labels = base | {s[0] for s in spans}
    return (
        len(words),
        len(starts),
        min(starts, default=None),
        max(starts, default=None),
        ",".join(sorted(base)),
        ",".join(sorted(labels)),
        score,
        sorted(spans, key=lambda s: (s[1], s[0], s[2])),
    )


_ARROW = pa.schema(
    [
        ("n_words", pa.int64()),
        ("n_base", pa.int64()),
        ("first_word", pa.int64()),
        ("last_word", pa.int64()),
        ("base_labels", pa.string()),
        ("labels", pa.string()),
        ("score", pa.float64()),
        (
            "spans",
            pa.list_(
                pa.struct(
                    [
                        ("label", pa.string()),
                        ("start_word", pa.int64()),
                        ("n_words", pa.int64()),
                        ("edits", pa.int32()),
                        ("text", pa.string()),
                    ]
                )
            ),
        ),
    ]
)


def scan_licenses(
    docs: DataFrame, phrases: dict[str, str] = PHRASES, notices: dict[str, tuple[str, int]] = NOTICES
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id`` and the columns of ``SCHEMA``.

    ``n_base``, ``first_word`` and ``last_word`` count the places of the exact phrases (words from 0; null without
    a place), ``base_labels`` names them; ``labels`` adds those of the fuzzy search, ``spans`` lists its matches
    and ``score`` is the best share of a notice's characters that match (1 for an exact phrase, 0 without
    any). Null and empty texts have no words, no labels and score 0. Long texts are searched whole. Repeated rows
    and null ids are scanned like others. Other columns are ignored. An empty table gives an empty result.
    Rows are independent, so nothing is shuffled.
    """
    types = {f.name: f.type for f in _ARROW}

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        searches = [NoticeSearch(notice, *how) for notice, how in notices.items()]
        for batch in batches:
            rows = [scan(text, searches, phrases) for text in batch.column(1).to_pylist()]
            columns = list(zip(*rows, strict=True)) or [()] * len(types)
            arrays = [pa.array(c, t) for c, t in zip(columns, types.values(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *arrays], names=["doc_id", *types])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, {SCHEMA}")
