"""Long, repeated and hot inputs: results stay whole and work and memory stay in bounds."""

from __future__ import annotations

import collections
import time

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import regex
from pyspark.sql import functions as F

from clickline.llm import bpe, classifier, licenses, mixing, pieces, token_files, urls, vectors


def test_repeated_rows_share_what_the_mix_takes_of_them(make_docs):
    rows = [(i, "w " * (i % 17 + 1), "ab"[i % 2]) for i in range(120)]
    rows += [(7, rows[7][1], rows[7][2])] * 60 + [(None, None, None)] * 5 + [(200, "", "a"), (200, "", "a")]
    docs = make_docs(rows).withColumn("n_chars", F.when(F.col("doc_id") == 7, F.pmod(F.xxhash64("text"), F.lit(3))).otherwise(0))
    odd = make_docs([(7, rows[7][1], rows[7][2])] * 4).withColumn("n_chars", F.lit(99).cast("long"))
    docs = docs.unionByName(odd)
    want = collections.Counter()
    for r in mixing.mix(docs).collect():
        want[(r["doc_id"], r["source"])] += r["passes"]
    got = mixing.mixed_documents(docs)
    assert got.columns == docs.columns
    again = sorted(map(str, mixing.mixed_documents(docs).collect()))
    rows = got.collect()
    assert sorted(map(str, rows)) == again
    assert collections.Counter((r["doc_id"], r["source"]) for r in rows) == +want
    # No row goes more often than a document may.
    assert sum(r["n_chars"] == 99 for r in rows) <= 4 * mixing.MAX_PASSES


def test_mixed_documents_shuffle_texts_once(spark, make_docs):
    kept = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    try:
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        plan = mixing.mixed_documents(make_docs([(1, "a b", "s"), (2, "c", "t")]))._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in kept.items():
            spark.conf.set(k, v)
    lone, repeated = plan.split("HashAggregate", 1) if "HashAggregate" in plan else plan.split("SortAggregate", 1)
    # Lone rows meet the taken keys and are done; repeated ones come out of the same exchange, and counts go on to a window.
    assert lone.count("Exchange hashpartitioning") == 3 and lone.count("SortMergeJoin") == 1, plan
    assert "ReusedExchange" in repeated, plan


@pytest.mark.parametrize("dims", [1, 2, 3, 5, 20])
def test_links_are_found_whatever_the_number_of_directions(spark, dims):
    random = np.random.default_rng(dims)
    x = random.standard_normal((900, dims)) @ random.standard_normal((dims, 32))
    x = np.concatenate([x, x[:200] + 0.02 * random.standard_normal((200, 32)) * np.linalg.norm(x[:200], axis=1)[:, None]])
    frame = spark.createDataFrame([(i, [float(a) for a in v]) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    x = x / np.linalg.norm(x, axis=1)[:, None]
    want = (x @ x.T >= 0.95).sum(1) - 1
    got = {r["vec_id"]: r["n_links"] for r in vectors.near_duplicates(frame).collect()}
    found = sum(got.values())
    assert 0.99 * want.sum() <= found and all(got[i] <= want[i] for i in got)


def test_reach_follows_the_directions():
    random = np.random.default_rng(1)
    wide = vectors.unit(list(random.standard_normal((4000, 64))), 64)
    flat = vectors.unit(list(random.standard_normal((4000, 3)) @ random.standard_normal((3, 64))), 64)
    assert vectors.directions(wide) > 30 and vectors.directions(flat) < 4
    assert vectors.fit(wide, 4000).reach < 0.6 and vectors.fit(flat, 4000).reach == 1.0
    assert vectors.directions(np.ones((5, 8))) == 1.0


RULES = [("h.org", "/", "BLOCK"), ("g.org", "/a", "block"), ("g.org", "/a", "allow"), ("x.h.org", "/p", "deny"), ("e", "", "block")]


@pytest.mark.parametrize("bound", [urls.MAX_INDEX_BYTES, 0])
def test_verdicts_are_the_same_on_both_paths(spark, bound):
    hosts = ["h.org", "a.h.org", "x.h.org", "g.org", "ag.org", "e", ".e", "e.", "a.e", "1234567e", "123456.e", "12345.7e"]
    long_host = ".".join(["abc"] * 5000)
    found = [f"u://{h}{p}" for h in [*hosts, f"{long_host}.g.org", f"{long_host}g.org"] for p in ("", "/", "/a", "/p/q")]
    found.append("u://g.org/a" + "b" * 20_000)
    pages = spark.createDataFrame(list(enumerate(found)), "page_id long, url string")
    began = time.monotonic()
    judged = urls.judge_urls(pages, RULES, max_index_bytes=bound).collect()
    assert time.monotonic() - began < 60
    rules = {("h.org", "/"): "allow", ("g.org", "/a"): "block", ("x.h.org", "/p"): "allow", ("e", ""): "block"}
    for r in judged:
        host, path = r["host"], r["path"]
        fits = [x for x in rules if (host == x[0] or host.endswith("." + x[0])) and path.startswith(x[1])]
        best = max(fits, key=lambda x: len(x[0] + x[1]), default=None)
        assert (r["rule"], r["verdict"]) == ((best[0] + best[1], rules[best]) if best else (None, "allow")), r["page"]["url"][-30:]


def test_no_rule_on_either_path(spark):
    pages = spark.createDataFrame([(1, "u://a.b/c"), (2, None)], "page_id long, url string")
    for rules in ([], [("", "", "block")]):
        for bound in (urls.MAX_INDEX_BYTES, -1):
            assert {(r["rule"], r["verdict"]) for r in urls.judge_urls(pages, rules, max_index_bytes=bound).collect()} == {(None, "allow")}


def test_learning_takes_each_text_once_and_stays_in_its_bounds(spark, make_docs):
    rows = [(i, f"text {i} " * 60) for i in range(40)] + [(3, "text 3 " * 60)] * 500 + [(4, "other"), (4, None), (4, None), (None, "x")]
    rows.append((5, "long " * 120_000))
    docs = make_docs(rows)
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)] + [(3, 1), (None, 1)], "doc_id long, quality int")
    got = classifier.training_texts(docs, labels).collect()
    usable = {i for i in range(40) if not classifier_held_out(i)}
    pairs = [(r["_id"], r["text"]) for r in got]
    assert len(pairs) == len(set(pairs)) and {i for i, _ in pairs} == usable
    assert set(pairs) == {(i, t) for i, t in rows if i in usable}
    # 120 words are 3 passages, so 30 passages hold ten of them, and a text of more than 3 is not taken.
    few = classifier.training_texts(docs, labels, passages=30).collect()
    assert sum(max(1, -(-len((r["text"] or "").split()) // 50)) for r in few) <= 30 and 8 <= len(few) <= 13
    assert classifier.training_texts(docs, labels, limit=5).count() == 5
    model = classifier.train(docs, labels, passages_limit=30)
    assert len(classifier.score_documents(docs.limit(3), model).collect()) == 3


def classifier_held_out(i):
    import zlib

    return zlib.crc32(str(i).encode()) % 4 == 2


def test_words_of_many_notices_are_counted_in_one_pass():
    searches = [licenses.NoticeSearch(notice, *how) for notice, how in licenses.NOTICES.items()]
    text = "a b under the mit license " * 4_000
    began = time.monotonic()
    row = licenses.scan(text, searches, licenses.PHRASES)
    assert time.monotonic() - began < 20
    assert row[:4] == (24_000, 4_000, 2, 23_996)
    assert [s[1] for s in row[7] if s[0] == "mit"] == list(range(2, 24_000, 6))
    assert licenses.scan("nothing here", searches, licenses.PHRASES)[:4] == (2, 0, None, None)


def byte_ranks():
    return {bytes([b]): b for b in range(256)} | {t: 256 + i for i, t in enumerate((b"ab", b"bc", b"abc", b"aa", b"aaaa", b"bca"))}


def test_words_are_merged_leftmost_pair_of_lowest_rank_first():
    merger = bpe.Merger(byte_ranks())
    words = [b"x", b"ab", b"bca", b"xbcab", b"abcabca", b"aaaaaaa", b"cab" * 9, b"", b"bbb", b"z" * 300, b"aab" * 100]

    def one_by_one(word):
        parts = [word[i : i + 1] for i in range(len(word))] if word not in merger.ranks else [word]
        while True:
            pairs = [(merger.ranks[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:], strict=False)) if a + b in merger.ranks]
            if not pairs:
                return [merger.ranks[p] for p in parts]
            i = min(pairs)[1]
            parts[i : i + 2] = [parts[i] + parts[i + 1]]

    got = [np.frombuffer(x, "<i4").tolist() for x in merger.merge(words)]
    assert got == [one_by_one(w) for w in words]


def test_texts_keep_their_order_across_blocks_and_forgetting(monkeypatch):
    made = []

    def make(words):
        made.extend(words)
        return [(w.encode(), w[::-1].encode()) for w in words]

    monkeypatch.setattr(pieces, "MAX_REMEMBERED", 5)
    monkeypatch.setattr(pieces, "BLOCK_BYTES", 40)
    texts = ["", "a b", "a  b", " a", "b\n c", "a\u3000 b c", "long " * 30, "a b", "", "\x85 x y", "é 漢 é"] * 3
    remembered = pieces.Remembered(make, 2)
    plain, turned = remembered.encode(pa.array(texts))
    assert [x.decode() for x in plain.to_pylist()] == texts
    words = regex.compile(public_tokenizers.PATTERN)
    for text, got in zip(texts, turned.to_pylist(), strict=True):
        assert got.decode() == "".join(w[::-1] for w in words.findall(text))
    # What stays in use is not made again, and no more than two generations and a block are kept.
    assert made.count(" b") <= 2 and len(remembered.words.young) < 40
    assert [len(x) for x in remembered.encode(pa.array([], pa.string()))] == [0, 0]


def test_spaces_are_those_of_python():
    import sys

    every = [chr(i) for i in range(sys.maxunicode + 1) if not 0xD800 <= i < 0xE000]
    spaces = pa.compute.match_substring_regex(pa.array(every), pieces.SPACES).to_pylist()
    assert [c for c, s in zip(every, spaces, strict=True) if s] == [c for c in every if c.isspace()]


def test_many_new_words_in_several_blocks(monkeypatch):
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    random = np.random.default_rng(5)
    letters = random.choice(list("aeinrstlo"), (3_000, 12))
    words = pa.array([" ".join(map("".join, letters[i : i + 100].tolist())) for i in range(0, len(letters), 100)])
    whole, decoded = bpe.Coder(ranks).code(words)
    assert decoded.to_pylist() == [w.encode() for w in words.to_pylist()]
    monkeypatch.setattr(bpe, "BLOCK_BYTES", 2_000)
    monkeypatch.setattr(bpe, "BLOCK_SQUARES", 20_000)
    monkeypatch.setattr(pieces, "BLOCK_BYTES", 5_000)
    assert bpe.Coder(ranks).code(words)[0].equals(whole)
    assert bpe.id_lists(whole.slice(7, 3)).to_pylist() == [np.frombuffer(x, "<i4").tolist() for x in whole.to_pylist()[7:10]]


def test_added_tokens_and_plain_texts_keep_their_order():
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    texts = ["a b", "a <|endoftext|> b", "", "c  d", "<|endoftext|>", "e"]
    got = token_files.TextEncoder(path).encode(pa.array(texts)).to_pylist()
    library = Tokenizer.from_file(path)
    assert [np.frombuffer(x, "<i4").tolist() for x in got] == [library.encode(t, add_special_tokens=False).ids for t in texts]


def test_stretches_of_one_word_are_not_cut_by_the_pattern():
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    encoder, seen = token_files.TextEncoder(path), []
    pattern = encoder.remembered.pattern

    class Counted:
        def findall(self, text):
            seen.append(text)
            return pattern.findall(text)

    encoder.remembered.pattern = Counted()
    texts = [" ".join(f"{a}{b}" for b in "uvwxyz") + f" {a}'s, e\n" for a in ("so", "Le", "né", "x1")] + ["so solo", "", " ", "a\n"]
    got = encoder.encode(pa.array(texts)).to_pylist()
    library = Tokenizer.from_file(path)
    assert [np.frombuffer(x, "<i4").tolist() for x in got] == [library.encode(t, add_special_tokens=False).ids for t in texts]
    cut = "".join(seen)
    assert "né" in cut and "x1" in cut and "so's," in cut
    assert not any(word in cut for word in ("sou", "Lez", "solo"))


def test_words_in_use_pass_to_the_younger_generation():
    made, memory = [], pieces.Memory(2, 3)

    def make(words):
        made.append(words)
        return [(w.encode(), w.upper().encode()) for w in words]

    for words in (["a", "b", "c", "d"], ["x", "d", "b", "y"], ["b", "z"], ["c", "a", "b"], []):
        plain, upper = memory.values(pa.array(words, pa.large_string()), make)
        assert plain.to_pylist() == [w.encode() for w in words]
        assert upper.to_pylist() == [w.upper().encode() for w in words]
    # The third call forgets a and c, which were not asked for in between; b and d are made once.
    assert [w for words in made for w in words] == ["a", "b", "c", "d", "x", "y", "z", "c", "a"]
    assert len(memory.young) + len(memory.old) <= 8
