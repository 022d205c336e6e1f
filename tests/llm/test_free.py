"""Operators with Python in their tasks, against brute force, the libraries and exact round trips."""

from __future__ import annotations

import itertools
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from clickline.llm import bpe, classifier, jaccard, licenses, shared, token_files, urls, vectors
from clickline.llm.pieces import stretches

ODD = "ab  \n\t \x1c\x85'st1²½éñ漢,.!\x00\u2028\u3000dre"
TEXTS = [None, "", " ", "  a", "a  ", "\x00b", "a \x00b", "b", "a" * 3000, " " * 500, "ab" * 700, "it's <|endoftext|> 漢 \U0001f600"]


def drawn_texts(n, seed=1):
    draw = random.Random(seed)
    return TEXTS + ["".join(draw.choice(ODD) for _ in range(draw.randrange(60))) for _ in range(n)]


def test_stretches_keep_the_tokens():
    import regex

    pattern = regex.compile(public_tokenizers.PATTERN)
    for text in filter(None, drawn_texts(1500)):
        parts = stretches(text)
        parts = parts[:1] + [" " + p for p in parts[1:]]
        assert "".join(parts) == text
        assert [w for p in parts for w in pattern.findall(p)] == pattern.findall(text)


def test_bpe_is_what_tiktoken_gives(make_docs):
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    library = tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(path), special_tokens={}
    )
    texts = drawn_texts(400, 2)
    rows = bpe.encode_and_decode(make_docs([*enumerate(texts), (None, "x"), (3, texts[3])])).collect()
    assert len(rows) == len(texts) + 2
    for r in rows:
        text = "x" if r["doc_id"] is None else texts[r["doc_id"]] or ""
        assert r["ids"] == library.encode_ordinary(text)
        assert bytes(r["decoded"]) == text.encode()
    assert bpe.encode_and_decode(make_docs([])).count() == 0


def test_both_merge_queries_agree(monkeypatch):
    merger = bpe.Merger(bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken")))
    draw = random.Random(4)
    words = ["".join(draw.choice("aeinrst") for _ in range(draw.randrange(1, 40))).encode() for _ in range(300)]
    short = merger.merge(words)
    monkeypatch.setattr(bpe, "LONG_WORD", 0)
    monkeypatch.setattr(bpe, "MAX_STATE_ROWS", 4000)
    assert merger.merge(words) == short
    assert merger.decode(short) == words


def test_token_files_round_trip(spark, make_docs, tmp_path):
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    library.encode_special_tokens = True
    texts = drawn_texts(200, 3)
    docs = make_docs([*enumerate(texts), (None, "none"), (907, "again"), (907, "again")])
    path = str(tmp_path / "ids")
    token_files.write_token_files(docs, path, files=3)
    files = token_files.read_token_files(spark, path)
    assert files.where("doc_id = 11").count() == 1
    start = 0
    for r in token_files.token_index(files).orderBy("start").collect():
        text = {None: "none", 907: "again"}.get(r["doc_id"]) or texts[r["doc_id"]] or ""
        ids = [*library.encode(text, add_special_tokens=False).ids, 0]
        assert (r["n_tokens"], r["ids_crc32"]) == (len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        assert r["start"] == start
        start += r["n_tokens"]
    empty = str(tmp_path / "empty")
    token_files.write_token_files(make_docs([]), empty, files=1)
    assert token_files.token_index(token_files.read_token_files(spark, empty).select("doc_id", "ids", "part", "row")).count() == 0


def test_orc_has_bloom_filters_and_sorted_files(spark, make_docs, tmp_path):
    path = str(tmp_path / "ids")
    token_files.write_token_files(make_docs([(i, f"text {i}") for i in range(300)]), path, files=4)
    spans = token_files.read_token_files(spark, path).groupBy("part").agg(F.min("doc_id"), F.max("doc_id")).orderBy("part").collect()
    assert len(spans) > 1
    assert all(a[2] < b[1] for a, b in itertools.pairwise(spans))
    assert token_files.ORC_OPTIONS["orc.bloom.filter.columns"] == "doc_id"


RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"), ("com", "", "block"), ("a.com", "/x", "allow")]
URLS = [
    "http://EXAMPLE.org/es/1", "https://m.example.org/en/12?x#y", "x://example.org/EN/1", "http://com", "http://notcom/", "http://b.a.com/xyz",
    "http://a.com?x", None, "", "no scheme", "://org/", "http://org", "http:///path", "http://a.com/y#://org/", "http://.org/", "http://xn--é.org/",
]


@pytest.mark.parametrize("bound", [urls.MAX_INDEX_BYTES, 0])
def test_urls_match_plain_rules(spark, bound):
    pages = spark.createDataFrame([(i, u, "h") for i, u in enumerate([*URLS, URLS[0]])], "page_id long, url string, host string")
    judged = urls.judge_urls(pages, RULES, max_index_bytes=bound).collect()
    assert len(judged) == len(URLS) + 1
    for r in judged:
        url = r["page"]["url"] or ""
        found = re.match(r"(?s)^.*?://([^/?#]*)([^?#]*)", url)
        host, path = (found[1].translate({c: c + 32 for c in range(65, 91)}), found[2]) if found else ("", "")
        fits = [x for x in RULES if (host == x[0] or host.endswith("." + x[0])) and path.startswith(x[1])]
        best = max(fits, key=lambda x: len(x[0] + x[1]), default=None)
        assert (r["host"], r["path"]) == (host, path)
        assert (r["rule"], r["verdict"]) == ((best[0] + best[1], best[2]) if best else (None, "allow"))


def test_no_pages_or_rules(spark):
    pages = spark.createDataFrame([(1, "http://a.b/")], "page_id long, url string")
    assert [r["verdict"] for r in urls.judge_urls(pages, []).collect()] == ["allow"]
    assert urls.judge_urls(pages.limit(0), RULES).count() == 0


def test_colliding_digests_are_told_apart(monkeypatch):
    import pandas as pd

    monkeypatch.setattr(urls, "_digest", lambda host_bytes, key: 7)
    index = urls.RuleIndex(urls.write_index(pd.DataFrame(RULES, columns=["host", "path", "verdict"])))
    got = index.probe(pd.Series(["example.org", "x.y"]), pd.Series(["/es/1", "/"]))
    assert got["rule"].tolist() == ["example.org/es/", None]


def test_licenses(make_docs):
    texts = [
        "Licensed UNDER the MIT-License.", "undr the mitt license", "Apache License, Version 2.0", None, "", "word " * 20_000 + "CC-BY-NC 4.0",
        "apache license version 2 apache license version 2", "under the mitten", "é under the mit license漢", "cc by nc cc by nc",
        "gnu general public licence",
    ]
    for r in licenses.scan_licenses(make_docs(list(enumerate(texts)))).collect():
        text = (texts[r["doc_id"]] or "").translate({c: c + 32 for c in range(65, 91)})
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text)
        places = [
            (i, label)
            for phrase, label in licenses.PHRASES.items()
            for i in range(len(words))
            if words[i : i + len(phrase.split())] == phrase.split()
        ]
        starts = [i for i, _ in places]
        assert r["n_words"] == len(words) and r["n_base"] == len(places)
        assert (r["first_word"], r["last_word"]) == (min(starts, default=None), max(starts, default=None))
        assert r["base_labels"] == ",".join(sorted({x for _, x in places}))
        assert set(filter(None, r["base_labels"].split(","))) <= set(filter(None, r["labels"].split(",")))
        assert 0 <= r["score"] <= 1
    labels = {r["doc_id"]: r["labels"] for r in licenses.scan_licenses(make_docs(list(enumerate(texts)))).collect()}
    assert labels[1] == "mit" and labels[10] == "gpl" and labels[7] == ""
    assert licenses.scan_licenses(make_docs([])).count() == 0


def test_fuzzy_search_finds_every_edit():
    search = licenses.NoticeSearch("under the mit license", "mit", 2)
    draw = random.Random(6)
    for _ in range(300):
        text = list(search.notice)
        for _ in range(2):
            i = draw.randrange(1, len(text) - 1)
            kind = draw.randrange(3)
            text[i : i + (kind != 0)] = [] if kind == 1 else [draw.choice("abcxyz")]
        assert search.spans(f" foo {''.join(text)} bar ".encode()), text


def brute_classes(ids, linked):
    low = {i: i for i in ids}
    changed = True
    while changed:
        changed = False
        for a, b in linked:
            least = min(low[a], low[b])
            changed |= low[a] != least or low[b] != least
            low[a] = low[b] = least
    return low


@pytest.mark.parametrize("block", [512, 8])
def test_jaccard_matches_brute_force(make_docs, block):
    draw = random.Random(8)
    texts = []
    for _ in range(25):
        words = [f"w{draw.randrange(500)}" for _ in range(draw.choice([3, 5, 40, 120]))]
        for _ in range(draw.choice([1, 2, 6, 30])):
            changed = list(words)
            for _ in range(draw.randrange(3)):
                changed[draw.randrange(len(words))] = f"v{draw.randrange(99)}"
            texts.append(" ".join(changed))
    texts += [None, "", " \n", "one two", "one\ttwo", "long " * 30_000]
    docs = make_docs([*enumerate(texts), (None, "one two")])
    rows = {r["doc_id"]: r for r in jaccard.jaccard_join(docs, block_docs=block).collect()}
    sets = []
    for t in texts:
        w = (t or "").split()
        sets.append({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    links = [
        (a, b) for a, b in itertools.combinations(range(len(texts)), 2) if sets[a] and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])
    ]
    low = brute_classes(range(len(texts)), links)
    for i in range(len(texts)):
        assert rows[i]["n_links"] == sum(i in p for p in links)
        assert (rows[i]["class_id"], rows[i]["kept"]) == (low[i], low[i] == i)
    assert (rows[None]["n_links"], rows[None]["class_id"], rows[None]["kept"]) == (0, None, True)
    kept = sorted(r["doc_id"] for r in jaccard.one_of_each(docs).collect() if r["doc_id"] is not None)
    assert kept == [i for i in range(len(texts)) if low[i] == i]


def test_no_texts(make_docs):
    assert jaccard.jaccard_join(make_docs([])).count() == 0


def test_rows_with_one_id_are_one_document(make_docs):
    docs = make_docs([(5, "a b c d e f"), (5, "a b c d e f"), (5, "u v w x y z"), (6, "u v w x y z")])
    assert {r["class_id"] for r in jaccard.jaccard_join(docs).collect()} == {5}
    assert jaccard.one_of_each(docs).count() == 1


def test_bands_reach_the_recall():
    bands, rows = jaccard.choose_bands(0.8, 0.99999)
    assert 1 - (1 - 0.8**rows) ** bands >= 0.99999
    assert bands * rows <= jaccard.MAX_HASHES


def test_vectors_match_brute_force(spark):
    random_ = np.random.default_rng(3)
    base = random_.standard_normal((150, 16))
    near = base[:60] + 0.05 * random_.standard_normal((60, 16))
    hub = base[0] + 0.02 * random_.standard_normal((40, 16))
    rows = [[float(x) for x in v] for v in np.concatenate([base, near, hub, base[:5], 3 * base[5:8]])]
    odd = [None, [], [0.0] * 16, [float("nan")] * 16, [float("inf")] + [1.0] * 15, [None] + [1.0] * 15, [1.0, 2.0], [2.0, 4.0], [1e-200, 1e200]]
    frame = spark.createDataFrame([*enumerate(rows + odd), (None, rows[0])], "vec_id long, embedding array<double>")
    got = {r["vec_id"]: r for r in vectors.near_duplicates(frame, reach=1.0).collect()}
    links = []
    usable = {i: np.array(v) for i, v in enumerate(rows)} | {len(rows) + 6: np.array([1.0, 2.0]), len(rows) + 7: np.array([2.0, 4.0])}
    for a, b in itertools.combinations(usable, 2):
        x, y = usable[a], usable[b]
        if len(x) == len(y) and x @ y / np.sqrt((x @ x) * (y @ y)) >= 0.95:
            links.append((a, b))
    low = brute_classes(range(len(rows) + len(odd)), links)
    for i in low:
        assert (got[i]["n_links"], got[i]["component_id"], got[i]["kept"]) == (sum(i in p for p in links), low[i], low[i] == i)
    assert (got[None]["n_links"], got[None]["component_id"], got[None]["kept"]) == (0, None, True)
    assert vectors.near_duplicates(frame.limit(0)).count() == 0
    assert {r["n_links"] for r in vectors.near_duplicates(frame.where("vec_id is null or embedding is null")).collect()} == {0}


def test_vector_blocks_do_not_change_links(spark, monkeypatch):
    random_ = np.random.default_rng(5)
    hub = random_.standard_normal(8) + 0.03 * random_.standard_normal((120, 8))
    frame = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(hub)], "vec_id long, embedding array<float>")
    whole = sorted(vectors.near_duplicates(frame).collect())
    monkeypatch.setattr(vectors, "MEMBERS_PER_BLOCK", 9)
    monkeypatch.setattr(vectors, "PROBES_PER_BLOCK", 17)
    assert sorted(vectors.near_duplicates(frame).collect()) == whole


def test_recall_with_production_parameters(spark, sf_dir):
    """Rows moved to a cosine of just 0.95 of real vectors are found."""
    real = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("embedding").toPandas()["embedding"]
    x = vectors.unit([np.array(v) for v in real], 64)
    step = np.random.default_rng(2).standard_normal(x.shape)
    step -= (step * x).sum(1)[:, None] * x
    y = 0.951 * x + np.sqrt(1 - 0.951**2) * step / np.linalg.norm(step, axis=1)[:, None]
    both = [[float(a) for a in v] for v in np.concatenate([x, y])]
    frame = spark.createDataFrame(list(enumerate(both)), "vec_id long, embedding array<double>")
    want = (np.concatenate([x, y]) @ np.concatenate([x, y]).T >= 0.95).sum() - 2 * len(x)
    got = vectors.near_duplicates(frame).agg(F.sum("n_links")).first()[0]
    assert 0.99 * want <= got <= want


def test_components(spark):
    draw = random.Random(1)
    edges = [(draw.randrange(300), draw.randrange(300)) for _ in range(180)] + [(1000 + i, 1001 + i) for i in range(40)] + [(7, 7)]
    got = {r["node"]: r["component"] for r in shared.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    linked = [e for e in edges if e[0] != e[1]]
    low = brute_classes({x for e in linked for x in e}, linked)
    assert got == low


def quality_docs(n, seed):
    draw = random.Random(seed)
    vocabulary = ["".join(draw.choice("abcdefgh") for _ in range(draw.randrange(2, 8))) for _ in range(300)]
    rows, labels = [], []
    for i in range(n):
        lines = [" ".join(draw.choice(vocabulary) for _ in range(60)) + "." for _ in range(draw.randrange(1, 6))]
        bad = i % 4 == 0
        if bad:
            lines[draw.randrange(len(lines))] = " ".join(draw.choice(vocabulary).upper() + "!!" for _ in range(60))
        rows.append((i, "\n".join(lines)))
        labels.append((i, 0 if bad else 1))
    return rows, labels


def test_classifier_on_held_out_documents(spark, make_docs):
    rows, labels = quality_docs(400, 9)
    extra = [(900, None), (901, ""), (902, "word " * 50_000), (None, rows[1][1]), (1, rows[1][1])]
    docs = make_docs(rows + extra)
    known = spark.createDataFrame([*labels, (None, 1), (900, None)], "doc_id long, quality int")
    got = classifier.classify(docs, known).collect()
    assert len(got) == len(rows) + len(extra)
    right = [r["predicted"] == dict(labels)[r["doc"]["doc_id"]] for r in got if r["held_out"] and r["doc"]["doc_id"] in dict(labels)]
    assert len(right) > 50 and sum(right) / len(right) > 0.95
    for r in got:
        i = r["doc"]["doc_id"]
        assert r["held_out"] == (i is None or zlib.crc32(str(i).encode()) % 4 == 2)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7)
    assert len({round(r["score"], 9) for r in got if r["doc"]["text"] == rows[1][1]}) == 1


def test_classifier_without_anything_to_learn(spark, make_docs):
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert [r["score"] for r in classifier.classify(make_docs([(1, "a"), (2, None)]), none).collect()] == [0.5, 0.5]
    assert classifier.classify(make_docs([]), none).count() == 0


def test_gradients():
    x, counts = classifier.passages(["a b c! d " * 40, "X Y " * 90, "p q r " * 70])
    model = classifier.fit(x, counts, np.array([1, 0, 1]))
    again = classifier.fit(x, counts, np.array([1, 0, 1]))
    assert all((a == b).all() for a, b in zip(model.weights(), again.weights(), strict=True))
    assert ((model.predict(x, counts) > 0.5) == [True, False, True]).all()


def test_close_notices_are_all_found():
    search = licenses.NoticeSearch("gnu general public license", "gpl", 2)
    forms = {"gnu general public license": 0, "gnu generl public license": 1, "gnu generl public licens": 2}
    draw = random.Random(10)
    cases = [["gnu generl public license"] * 20 + ["gnu general public license"]]
    cases += [[draw.choice(list(forms)) for _ in range(draw.randrange(2, 30))] for _ in range(40)]
    for notices in cases:
        for gap in (" ", " x ", " and the "):
            text = gap + gap.join(notices) + gap
            want, at = [], 0
            for notice in notices:
                at = text.index(notice, at)
                want.append((at, at + len(notice), forms[notice]))
                at += len(notice)
            assert search.spans(text.encode()) == want


def test_token_files_are_what_the_library_gives_by_default(make_docs):
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    texts = [*drawn_texts(30, 5), "a <|endoftext|> b", "<|endoftext|>", "x<|endoftext|><|endoftext|>\n", "<|endoftext |>", "plain"]
    start = 0
    for r in token_files.round_trip(make_docs([*enumerate(texts)])).orderBy("start").collect():
        ids = [*library.encode(texts[r["doc_id"]] or "", add_special_tokens=False).ids, 0]
        assert (r["n_tokens"], r["ids_crc32"]) == (len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        assert r["start"] == start
        start += r["n_tokens"]
