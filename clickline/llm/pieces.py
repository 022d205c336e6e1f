"""Cuts texts where the public pre-tokenization pattern always cuts, so that equal stretches are encoded once."""

from __future__ import annotations

import itertools
import re
import sys
import types
from collections.abc import Callable, Iterable, Iterator
from typing import Any

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import regex

#: White space as ``str.isspace`` knows it, for Arrow's regular expressions, which know ASCII only.
SPACES = r"[\t-\r\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
_UNEVEN = rf"{SPACES} | {SPACES}|\A | \z"
_CUT = re.compile(r"(?<=\S) (?=\S)")
#: A stretch that is one word of the pattern, as most are; others are cut by the pattern.
_ONE_WORD = r"\A ?[A-Za-z]+\z"
#: Words in each of the two generations of a memory, about.
MAX_REMEMBERED = 150_000
#: Bytes of text that are worked on at once.
BLOCK_BYTES = 4 * 2**20


def cut(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Texts cut at each space between two characters that are not white space, without these spaces: all stretches one
    after the other, and how many each text has (one at least).

    In ``public_tokenizers.PATTERN`` only a run of white space can hold a space that is not its first character,
    and such a run has no place here: it always cuts before these spaces, and nothing before a cut
    changes what comes after. So stretch by stretch, each but the first with its space, gives the same tokens.
    """
    uneven = pc.match_substring_regex(texts, _UNEVEN).to_numpy(zero_copy_only=False)
    even = pc.split_pattern(texts.filter(pa.array(~uneven)), " ")
    counts = np.empty(len(texts), "i8")
    counts[~uneven] = even.value_lengths()
    if not uneven.any():
        return even.flatten(), counts
    others = [_CUT.split(text) for text in texts.filter(pa.array(uneven)).to_pylist()]
    counts[uneven] = [len(parts) for parts in others]
    pieces = pa.concat_arrays([even.flatten(), pa.array(itertools.chain.from_iterable(others), texts.type)])
    # The even texts' stretches come first here; back to the order of the texts.
    order = np.argsort(uneven, kind="stable")
    starts = np.empty(len(texts), "i8")
    starts[order] = np.cumsum(counts[order]) - counts[order]
    places = np.repeat(starts - (np.cumsum(counts) - counts), counts) + np.arange(counts.sum())
    return pieces.take(pa.array(places)), counts


def stretches(text: str) -> list[str]:
    """The stretches of one text, see ``cut``."""
    return cut(pa.array([text], pa.string()))[0].to_pylist()


class Memory:
    """Byte strings by word, in two generations of Arrow columns. When the younger one is full, the elder is forgotten:
    words in use stay."""

    def __init__(self, width: int, limit: int) -> None:
        self.limit = limit
        self.schema = pa.schema([("word", pa.large_string()), *((str(i), pa.large_binary()) for i in range(width))])
        self.young = self.old = self.schema.empty_table()

    def values(
        self, words: pa.LargeStringArray, make: Callable[[list[str]], list[tuple[bytes, ...]]]
    ) -> list[pa.LargeBinaryArray]:
        """The columns of values of ``words``, which are distinct; ``make`` gives those that are not known."""
        if len(self.young) > self.limit:
            self.old, self.young = self.young, self.schema.empty_table()
        at = pc.index_in(words, self.young["word"])
        rest = words.filter(at.is_null())
        at_old = pc.index_in(rest, self.old["word"])
        new = rest.filter(at_old.is_null())
        made = list(zip(*make(as_list(new)), strict=True)) if len(new) else [()] * (len(self.schema) - 1)
        columns = [new, *(pa.array(column, pa.large_binary()) for column in made)]
        # Behind the younger generation stand the words of the elder, then the new ones.
        order = np.argsort(at_old.is_null().to_numpy(zero_copy_only=False), kind="stable")
        behind = np.empty(len(rest), "i8")
        behind[order] = np.arange(len(self.young), len(self.young) + len(rest))
        unknown = at.is_null().to_numpy(zero_copy_only=False)
        places = at.fill_null(0).to_numpy().astype("i8")
        places[unknown] = behind
        added = [self.old.take(at_old.drop_null()), pa.table(columns, self.schema)]
        self.young = pa.concat_tables([self.young, *added]).combine_chunks()
        return [pa.concat_arrays(column.chunks).take(pa.array(places)) for column in self.young.columns[1:]]


class Remembered:
    """Encodes texts by words; ``make`` gets words not met before and returns one tuple of ``width`` byte strings for
    each."""

    def __init__(self, make: Callable[[list[str]], list[tuple[bytes, ...]]], width: int, limit: int | None = None) -> None:
        self.make, self.width, self.pattern = make, width, regex.compile(public_tokenizers.PATTERN)
        self.words = Memory(width, limit or MAX_REMEMBERED)

    def _cut_words(self, stretches: pa.LargeStringArray) -> tuple[pa.LargeStringArray, np.ndarray, np.ndarray]:
        """The words of stretches, one stretch after the other but in another order: all words, how many each stretch
        has, and which one it is."""
        single = pc.match_substring_regex(stretches, _ONE_WORD).to_numpy(zero_copy_only=False)
        others = as_list(stretches.filter(pa.array(~single)))
        # Stretches that stood between two others, without white space at their ends, are cut as the text that they make
        # together: the pattern cuts it before each of their spaces.
        inner = np.array([s[:1] == " " and len(s) > 1 and s[1:] == s.strip() for s in others], bool)
        order = np.argsort(inner, kind="stable")
        alone = len(others) - int(inner.sum())
        cut = [self.pattern.findall(others[i]) for i in order[:alone].tolist()]
        together = [others[i] for i in order[alone:].tolist()]
        words = self.pattern.findall("".join(together))
        ends = np.searchsorted(np.cumsum([len(w) for w in words]), np.cumsum([len(s) for s in together])) + 1
        every = [stretches.filter(pa.array(single)), pa.array(itertools.chain(*cut, words), pa.large_string())]
        counts = [np.ones(single.sum(), "i8"), [len(parts) for parts in cut], np.diff(ends, prepend=0)]
        which = [np.flatnonzero(single), np.flatnonzero(~single)[order]]
        return pa.concat_arrays(every), np.concatenate(counts).astype("i8"), np.concatenate(which)

    def encode(self, texts: pa.Array) -> list[pa.LargeBinaryArray]:
        """For each of the ``width`` values, the joined byte strings of each text; there are no null texts."""
        blocks = [self._block(block) for block in split(texts)]
        empty = pa.array([], pa.large_binary())
        return [pa.concat_arrays([empty, *(block[i] for block in blocks)]) for i in range(self.width)]

    def _block(self, texts: pa.Array) -> list[pa.LargeBinaryArray]:
        pieces, counts = cut(texts)
        ends = np.cumsum(counts)
        first = np.zeros(len(pieces), bool)
        first[ends - counts] = True
        heads = pieces.filter(pa.array(first)).dictionary_encode()
        tails = pieces.filter(pa.array(~first)).dictionary_encode()
        text = pa.large_string()
        spaced = pc.binary_join_element_wise(pa.scalar("", text), tails.dictionary.cast(text), pa.scalar(" ", text))
        words, lengths, which = self._cut_words(pa.concat_arrays([heads.dictionary.cast(text), spaced]))
        # Stretches stand in another order there.
        rows = np.empty(len(which), "i8")
        rows[which] = np.arange(len(which))
        places = np.empty(len(pieces), "i8")
        places[first] = rows[heads.indices]
        places[~first] = rows[len(heads.dictionary) + tails.indices.to_numpy()]
        places, word_ends, words = pa.array(places), np.cumsum(lengths), words.dictionary_encode()
        values = self.words.values(words.dictionary, self.make)
        return [joined(joined(column.take(words.indices), word_ends).take(places), ends) for column in values]


def split(texts: pa.Array) -> Iterator[pa.Array]:
    """Neighbouring texts of about ``BLOCK_BYTES`` together."""
    ends = np.cumsum(pc.binary_length(texts.fill_null("")).to_numpy(zero_copy_only=False), dtype="i8")
    bounds = [0, *(np.flatnonzero(np.diff(ends // BLOCK_BYTES)) + 1).tolist(), len(texts)]
    for a, b in itertools.pairwise(bounds):
        if b > a:
            yield texts.slice(a, b - a)


def by_blocks(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of batches (doc_id, text, ...) in batches of about ``BLOCK_BYTES`` of text."""
    for batch in batches:
        at = 0
        for texts in split(batch.column(1)):
            yield batch.slice(at, len(texts))
            at += len(texts)
        # Arrow keeps freed memory for later; here the JVM and other workers share an executor's.
        pa.default_memory_pool().release_unused()


def as_list(values: pa.Array) -> list[Any]:
    """``to_pylist`` of an array without nulls, in one conversion."""
    return values.to_numpy(zero_copy_only=False).tolist()


def joined(parts: pa.LargeBinaryArray, ends: np.ndarray) -> pa.LargeBinaryArray:
    """Neighbouring byte strings put together; ``ends`` says where each group ends. The bytes stay where they are."""
    offsets = byte_offsets(parts)[np.concatenate([[0], ends])]
    return pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(ends), [None, pa.py_buffer(offsets), parts.buffers()[2] or pa.py_buffer(b"")]
    )


def byte_offsets(parts: pa.LargeBinaryArray) -> np.ndarray:
    """Where each byte string starts in the data buffer, and where the last one ends."""
    return np.frombuffer(parts.buffers()[1], "i8")[parts.offset : parts.offset + len(parts) + 1]


def for_worker(key: str, make: Callable[[], Any]) -> Any:
    """What ``make`` gives, made once in the life of a Python worker: Spark reuses workers for many tasks, and what
    one task has encoded the next need not encode again."""
    kept = sys.modules.setdefault("clickline_worker", types.ModuleType("clickline_worker")).__dict__
    if key not in kept:
        kept[key] = make()
    return kept[key]
