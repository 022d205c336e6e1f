"""Spelling variants, grouped by reduced-alphabet generation.

Letters are hashed to a few symbols, so that words one edit apart have reduced words at most one edit apart. The
one-edit neighbourhoods of the distinct reduced words are generated and joined with the reduced vocabulary, and what
meets is verified on the original strings. An insertion into one reduced word is a deletion from the other, so it is
generated from there; substitutions and equal reduced words meet from both sides.

Reduced words travel as 64-bit polynomial hashes, from which each neighbour's hash follows in constant time, so a
very long word takes time and memory in its length times the number of symbols. Hash collisions only add candidates.

Defined results: null text has no words, a null id counts as empty text in the deletion rule, rows that repeat count as
often as they stand there, equal counts are settled by code-point order, an empty table gives no words. Other columns,
whatever their names, are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickline.llm.shared import stored

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
MIN_LENGTH, MIN_COUNT = 6, 5
#: A word's form is at least so many times as frequent.
RATIO = 5
#: One run in so many loses a code point.
DAMAGED = 199
#: Symbols of the reduced alphabet.
SYMBOLS = 8

#: An odd number, so it has an inverse modulo 2^64.
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 2**64)
_PER_LENGTH = 0xD6E8FEB86659FD93
_PAIRS_PER_BATCH = 1_000_000


def words_of(docs: DataFrame) -> DataFrame:
    """(word, n) of all words that are long and frequent enough, damaged as the contract says."""
    # A run with fewer code points gives no word.
    runs = F.regexp_extract_all(F.translate("text", UPPER, LOWER), F.lit(f"([A-Za-z\\u00C0-\\u00FF]{{{MIN_LENGTH},}})"), F.lit(1))
    found = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), F.explode(runs).alias("run"))
    digest = F.crc32(F.concat("id", F.lit(":"), "run").cast("binary"))
    at = F.pmod("h", F.length("run")).cast("int")
    cut = F.concat(F.substr("run", F.lit(1), at), F.substr("run", at + 2))
    word = F.when(F.pmod("h", F.lit(DAMAGED)) == 0, cut).otherwise(F.col("run"))
    words = found.withColumn("h", digest).select(word.alias("word")).where(F.length("word") >= MIN_LENGTH)
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= MIN_COUNT)


def spelling_variants(docs: DataFrame) -> DataFrame:
    """word, form, root, n, n_near, form_n."""
    return group_variants(stored(words_of(docs), "words"))


def group_variants(words: DataFrame, symbols: int = SYMBOLS) -> DataFrame:
    """The same for a vocabulary (word, n) of distinct words."""
    classed = stored(words.select("word", "n").mapInArrow(_classes(symbols), "word string, n long, class long, reduced binary"), "classes")
    reduced = classed.select("class", "reduced").distinct()
    near_classes = (
        reduced.mapInArrow(_neighbours(symbols), "source long, class long")
        .join(classed.select("class").distinct(), "class", "left_semi")
        .select("source", F.col("class").alias("target"))
        .distinct()
    )
    left = classed.select(F.col("class").alias("source"), "word", "n")
    right = classed.select(F.col("class").alias("target"), F.col("word").alias("other"), F.col("n").alias("other_n"))
    pairs = near_classes.join(left, "source").join(right, "target").where(_one_edit("word", "other"))
    # A deletion is met from the longer word only.
    shorter = F.length("word") > F.length("other")
    here = F.struct("word", "n", "other", "other_n")
    there = F.struct(
        F.col("other").alias("word"), F.col("other_n").alias("n"), F.col("word").alias("other"), F.col("n").alias("other_n")
    )
    links = pairs.select(F.explode(F.when(shorter, F.array(here, there)).otherwise(F.array(here))).alias("l")).select("l.*")
    best = F.min(F.struct((-F.col("other_n")).alias("minus_n"), F.col("other").alias("other"))).alias("best")
    near = links.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best)
    is_form = -F.col("best.minus_n") >= RATIO * F.col("n")
    formed = stored(
        words.select("word", "n")
        .join(near, "word", "left")
        .select(
            "word",
            "n",
            F.coalesce("n_near", F.lit(0)).alias("n_near"),
            F.when(is_form, F.col("best.other")).alias("form"),
            F.when(is_form, -F.col("best.minus_n")).alias("form_n"),
        ),
        "forms",
    )
    roots = _roots(formed.where(F.col("form").isNotNull()).select("word", "form"))
    rooted = formed.join(roots, "word", "left")
    return rooted.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def _one_edit(word: str, other: str) -> Column:
    """Whether two words of which the second is not longer are one edit apart. Spark's edit distance takes the square of the
    length, so long words are compared before and after the end of their common prefix."""
    a, b = F.col(word), F.col(other)
    steps = F.array(*[F.lit(1 << i) for i in reversed(range(30))])
    shared = F.aggregate(
        steps, F.lit(0), lambda upto, step: F.when(F.left(a, upto + step) == F.left(b, upto + step), upto + step).otherwise(upto)
    )
    rest = F.substr(b, shared + F.when(F.length(a) == F.length(b), 2).otherwise(1))
    by_prefix = (a != b) & (F.substr(a, shared + 2) == rest)
    near = F.when(F.length(a) <= 64, F.levenshtein(a, b, 1) == 1).otherwise(by_prefix)
    return (F.length(a) - F.length(b)).isin(0, 1) & near


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root) of every word that has a form. A form is five times as frequent as its word, so chains are short and
    have no circle; each round doubles the steps taken."""
    roots = stored(forms.withColumnRenamed("form", "root"), "roots")
    while not roots.join(forms.select(F.col("word").alias("root")), "root", "left_semi").isEmpty():
        further = roots.select(F.col("word").alias("root"), F.col("root").alias("further"))
        roots = stored(
            roots.join(further, "root", "left").select("word", F.coalesce("further", "root").alias("root")), "roots"
        )
    return roots


def _symbol(code_point: int, symbols: int) -> int:
    return zlib.crc32(chr(code_point).encode()) % symbols


def _wrapping(number: int) -> np.uint64:
    return np.uint64(number % 2**64)


def _powers(count: int) -> np.ndarray:
    factors = np.full(count + 1, _BASE, np.uint64)
    factors[0] = 1
    return np.cumprod(factors, dtype=np.uint64)


def _by_length(reduced: list[bytes]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(length, places, symbols as a matrix) of the words of each length."""
    lengths = np.array([len(r) for r in reduced])
    for length in np.unique(lengths):
        places = np.flatnonzero(lengths == length)
        joined = np.frombuffer(b"".join(reduced[i] for i in places), np.uint8)
        yield int(length), places, joined.reshape(len(places), length)


def _hashes(symbols: np.ndarray) -> np.ndarray:
    """Hash of each row of symbols: the sum of (symbol + 1) * base^place, and its length."""
    length = symbols.shape[1]
    with np.errstate(over="ignore"):
        sums = ((symbols.astype(np.uint64) + np.uint64(1)) * _powers(length)[:length]).sum(axis=1, dtype=np.uint64)
        return sums + _wrapping(length * _PER_LENGTH)


def _classes(symbols: int):
    """Adds a word's reduced word, one byte a letter, and its hash."""

    def classes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.array([_symbol(i, symbols) for i in range(256)], np.uint8)
        for batch in batches:
            # All letters lie below 256, so a byte holds one.
            words = [word.encode("latin-1") for word in batch.column("word").to_pylist()]
            reduced = [table[np.frombuffer(word, np.uint8)].tobytes() for word in words]
            keys = np.empty(len(words), np.uint64)
            for _, places, matrix in _by_length(reduced):
                keys[places] = _hashes(matrix)
            columns = [batch.column("word"), batch.column("n"), pa.array(keys.view(np.int64)), pa.array(reduced, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["word", "n", "class", "reduced"])

    return classes


def _neighbours(symbols: int):
    """(source, class): the hash of a reduced word, and those of itself, its deletions and its substitutions."""

    def neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held: list[np.ndarray] = []
            size = 0
            for source, target in _pairs(batch.column("reduced").to_pylist(), symbols):
                held.append(np.stack([source, target]))
                size += len(source)
                if size >= _PAIRS_PER_BATCH:
                    yield _batch(held)
                    held, size = [], 0
            if held:
                yield _batch(held)

    return neighbours


def _batch(held: list[np.ndarray]) -> pa.RecordBatch:
    source, target = np.concatenate(held, axis=1).view(np.int64)
    return pa.RecordBatch.from_arrays([pa.array(source), pa.array(target)], ["source", "class"])


def _pairs(reduced: list[bytes], symbols: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    for length, _, matrix in _by_length(reduced):
        own = _hashes(matrix)
        yield own, own
        powers = _powers(length)[:length]
        # Places of a word are worked on together, words of a length in blocks that bound what is held.
        block = max(1, _PAIRS_PER_BATCH // (length * symbols))
        for first in range(0, len(matrix), block):
            yield from _edited(matrix[first : first + block], own[first : first + block], powers, symbols)


def _edited(matrix: np.ndarray, own: np.ndarray, powers: np.ndarray, symbols: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    length = matrix.shape[1]
    with np.errstate(over="ignore"):
        here = matrix.astype(np.uint64)
        upto = np.cumsum((here + np.uint64(1)) * powers, axis=1, dtype=np.uint64)
        before = upto - (here + np.uint64(1)) * powers
        # Deleting one of several equal symbols in a row gives the same word: only the last one counts.
        ends = np.ones(matrix.shape, bool)
        ends[:, :-1] = matrix[:, :-1] != matrix[:, 1:]
        deleted = before + (upto[:, -1:] - upto) * np.uint64(_INVERSE) + _wrapping((length - 1) * _PER_LENGTH)
        sources = np.repeat(own, length).reshape(matrix.shape)
        yield sources[ends], deleted[ends]
        for step in range(1, symbols):
            other = (here + np.uint64(step)) % np.uint64(symbols)
            yield sources.ravel(), (sources + (other - here) * powers).ravel()
