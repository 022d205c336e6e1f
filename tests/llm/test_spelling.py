"""Spelling variants against a brute-force vocabulary."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from clickline.llm import queries, spelling

LOWER = str.maketrans(spelling.UPPER, spelling.LOWER)


def counted(rows):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-z\\u00C0-\\u00FF]+", text or ""):
            word = run.translate(LOWER)
            digest = zlib.crc32(f"{'' if doc_id is None else doc_id}:{word}".encode())
            at = digest % len(word)
            counts[word[:at] + word[at + 1 :] if digest % 199 == 0 else word] += 1
    return {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def grouped(vocabulary):
    """By comparing each word with those that share it, but for one code point."""
    masks = defaultdict(set)
    for word in vocabulary:
        masks[word].add(word)
        for i in range(len(word)):
            masks[word[:i] + word[i + 1 :]].add(word)
    near = {w: {o for i in range(len(w)) for o in masks[w[:i] + w[i + 1 :]] | masks[w] if one_edit(w, o)} for w in vocabulary}
    form = {}
    for word, others in near.items():
        best = min(others, key=lambda o: (-vocabulary[o], o), default=None)
        if best and vocabulary[best] >= 5 * vocabulary[word]:
            form[word] = best

    def root(word):
        while word in form:
            word = form[word]
        return word

    return {(w, form.get(w), root(w), n, len(near[w]), vocabulary.get(form.get(w))) for w, n in vocabulary.items()}


def result(df):
    return {tuple(r[c] for c in ("word", "form", "root", "n", "n_near", "form_n")) for r in df.collect()}


def test_query_equals_brute_force(spark, sf_dir):
    docs = queries.table(spark, sf_dir, "documents")
    got = queries.spelling_variants(spark, sf_dir)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    want = grouped(counted([(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]))
    assert result(got) == want and got.count() == len(want) > 500


@pytest.mark.parametrize("symbols", [2, 8])
def test_dense_vocabulary(spark, symbols):
    """Words of few letters: most are near each other, with chains of forms and many words in one reduced class."""
    draw = random.Random(symbols)
    vocabulary = {}
    while len(vocabulary) < 700:
        word = "".join(draw.choice("ab\u00e9c") for _ in range(draw.choice([6, 6, 7, 8])))
        vocabulary[word] = draw.choice([5, 6, 30, 31, 200, 1500])
    words = spark.createDataFrame(list(vocabulary.items()), "word string, n long").repartition(5)
    assert result(spelling.group_variants(words, symbols)) == grouped(vocabulary)


def test_neighbours_of_reduced_words():
    draw = random.Random(2)
    for length in (1, 2, 5, 9):
        for _ in range(40):
            word = bytes(draw.randrange(3) for _ in range(length))
            near = {word} | {word[:i] + word[i + 1 :] for i in range(length)}
            near |= {word[:i] + bytes([c]) + word[i + 1 :] for i in range(length) for c in range(3)}
            hashes = {int(h) for w in near for h in spelling._hashes(np.frombuffer(w, np.uint8).reshape(1, len(w)))}
            got = [int(t) for _, target in spelling._pairs([word], 3) for t in target]
            assert set(got) == hashes and len(got) == len(near)


def test_chains_of_forms_are_followed(spark):
    vocabulary = {"a" * 6 + "bcdefghij"[:i] + "z" * (9 - i): 5 ** (i + 1) for i in range(10)}
    words = spark.createDataFrame(list(vocabulary.items()), "word string, n long")
    got = {r["word"]: r["root"] for r in spelling.group_variants(words).collect()}
    assert set(got.values()) == {max(vocabulary, key=vocabulary.get)}


def test_nulls_empty_and_long_texts(spark, make_docs):
    long_word = "k" * 200
    rows = [(1, None), (2, ""), (3, "-- 12"), (None, "Colour " * 6), (4, "COLOURS " * 40), (4, "COLOURS " * 40), (5, f"{long_word} {long_word}x " * 6)]
    got = result(spelling.spelling_variants(make_docs(rows)))
    assert got == grouped(counted([r[:2] for r in rows])) and len(got) >= 4
    assert spelling.spelling_variants(make_docs([])).count() == 0


def test_very_long_words(spark):
    long_word = "kl" * 10_000
    words = spark.createDataFrame([(long_word, 100), (long_word + "x", 5), (long_word[:-1] + "x", 7), ("x" + long_word, 600)], "word string, n long")
    got = {len(r["word"]): r for r in spelling.group_variants(words).where("n != 7").collect()}
    assert got[20_000]["n_near"] == 3 and got[20_000]["form"] == "x" + long_word
    assert {(r["n"], r["root"] == "x" + long_word) for r in spelling.group_variants(words).collect()} == {(100, True), (5, True), (7, True), (600, True)}
