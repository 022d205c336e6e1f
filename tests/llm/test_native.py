"""Chat formatting, mixing and quality rules against plain Python."""

from __future__ import annotations

import collections
import math
import random
import re
from collections import Counter

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from clickline.llm import chat, mixing, rules

EVENTS = "conv_id long, seq long, turn long, kind string, role string, text string, slice string"
NASTY = ["", "\\", "\\b", "#", "##", "###", "#####", "#\\#", "</turn>", "</turn", "<\\/turn", " </turn>\n", "### user: x"]


def folded(events):
    """The rules of chat.fold, event by event."""
    done = {}
    for conv in {e[0] for e in events}:
        log = sorted((e for e in events if e[0] == conv), key=lambda e: (e[1], chat.KINDS.index(e[3]), e[4] or "", e[5] or ""))
        turns = {}
        for _, _, turn, kind, role, text in log:
            if kind == "regenerate":
                turns = {t: v for t, v in turns.items() if t < turn}
            old_role, old = turns.get(turn, ("", ""))
            turns[turn] = (old_role if role is None else role, (old if kind == "delta" else "") + (text or ""))
        done |= {(conv, turn): v for turn, v in turns.items()}
    return done


@pytest.mark.parametrize("seed", range(3))
def test_fold_matches_plain_python(spark, seed):
    draw = random.Random(seed)
    events = []
    for conv in range(4):
        for seq in range(draw.randrange(1, 40)):
            kind = draw.choice(["message", "delta", "delta", "delta", "edit", "regenerate"])
            events.append((conv, seq, draw.randrange(5), kind, draw.choice([None, "user", "assistant"]), draw.choice("abc")))
    rows = spark.createDataFrame([(*e, "clash") for e in events], EVENTS)
    got = {(r["conv_id"], r["turn"]): (r["role"], r["text"]) for r in chat.fold(rows).collect()}
    assert got == folded(events)


def test_slices_do_not_change_the_fold(spark, monkeypatch):
    events = [(1, i, i % 7, "regenerate" if i % 11 == 0 else "delta", "user", str(i)) for i in range(60)]
    rows = spark.createDataFrame([(*e, "") for e in events], EVENTS)
    monkeypatch.setattr(chat, "EVENTS_PER_SLICE", 5)
    got = {(r["conv_id"], r["turn"]): (r["role"], r["text"]) for r in chat.fold(rows).collect()}
    assert got == folded(events)


def test_formatting_is_reversible(spark):
    texts = NASTY + [a + b for a in NASTY for b in NASTY]
    rows = [(1, i, i, "message", "assistant" if i % 2 else "a:b \\c ### ", t, "") for i, t in enumerate(texts)]
    rows += [(None, 0, 0, "message", None, None, ""), (2, 0, 0, "message", "assistant", "é漢\U0001f600", "")]
    formatted = chat.format_conversations(spark.createDataFrame(rows, EVENTS)).cache()
    back = {r["conv_id"]: r for r in chat.read_back(formatted).collect()}
    assert [t["text"] for t in back[1]["turns"]] == texts
    assert {t["role"] for t in back[1]["turns"]} == {"assistant", "a:b \\c ### "}
    assert back[1]["loss_texts"] == texts[1::2]
    assert back[2]["loss_texts"] == ["é漢\U0001f600"]
    assert [tuple(t) for t in back[None]["turns"]] == [("", "")]
    for row in formatted.collect():
        spans = [row["formatted"][a:b] for a, b in row["loss"]]
        assert len(spans) == len(back[row["conv_id"]]["loss_texts"])
    formatted.unpersist()


def test_long_conversations_read_back(spark, monkeypatch):
    monkeypatch.setattr(chat, "CHUNK", 4)
    texts = [NASTY[i % len(NASTY)] + "é" * (i % 3) for i in range(41)]
    rows = [(1, i, i, "message", "assistant" if i % 3 else "user", t, "") for i, t in enumerate(texts)]
    back = chat.read_back(chat.format_conversations(spark.createDataFrame(rows, EVENTS))).collect()[0]
    assert [t["text"] for t in back["turns"]] == texts
    assert list(back["loss_texts"]) == [t for i, t in enumerate(texts) if i % 3]


def test_many_turns_read_back_in_one_row(spark):
    rows = spark.range(30_000).selectExpr(
        "1L AS conv_id", "id AS seq", "id AS turn", "'message' AS kind", "'assistant' AS role", "string(id) AS text"
    )
    back = chat.read_back(chat.format_conversations(rows)).selectExpr("size(turns) AS n", "array_join(loss_texts, ',') AS t")
    assert back.collect()[0].asDict() == {"n": 30_000, "t": ",".join(map(str, range(30_000)))}


def test_no_events(spark):
    assert chat.format_conversations(spark.createDataFrame([], EVENTS)).count() == 0


def test_repeated_rows_are_turns_of_their_own(spark):
    rows = spark.createDataFrame([(1, 0, "user", "x"), (1, 0, "user", "x")], "conv_id long, turn long, role string, text string")
    back = chat.read_back(chat.format_conversations(chat.events_of_rows(rows))).first()
    assert len(back["turns"]) == 2


def level(sizes, weights, cap=mixing.MAX_PASSES):
    """Targets by repeated resharing."""
    budget, open_, target = sum(sizes.values()), set(sizes), {}
    while open_:
        rest, total = budget - sum(target.values()), sum(weights[s] for s in open_)
        full = {s for s in open_ if rest * weights[s] / total > cap * sizes[s]}
        if not full:
            return target | {s: rest * weights[s] / total for s in open_}
        target |= {s: cap * sizes[s] for s in full}
        open_ -= full
    return target


def test_mix_meets_targets(make_docs):
    draw = random.Random(5)
    docs = [(i, "w " * draw.randrange(1, 60), draw.choice(["a", "b", "c", "d", None])) for i in range(1500)]
    docs += [(5000 + i, "w " * 10, "tiny") for i in range(5)] + [(6000, None, "a"), (6001, "", None), (6002, "x", "a"), (6002, "x", "a")]
    frame = make_docs(docs)
    rows = mixing.mix(frame).collect()
    assert len(rows) == len(docs)
    sizes, taken, target = collections.Counter(), collections.Counter(), {}
    for r in rows:
        sizes[r["source"]] += r["size"]
        taken[r["source"]] += r["taken"]
        target[r["source"]] = r["target"]
        assert r["taken"] <= mixing.MAX_PASSES * r["size"]
    order = sorted((s for s in sizes if s is not None)) + [None]
    expected = level(sizes, {s: i % 3 + 1 for i, s in enumerate(order)})
    for s in sizes:
        assert target[s] == pytest.approx(expected[s])
        assert abs(taken[s] - target[s]) <= 60
    assert [r.asDict() for r in sorted(mixing.mix(frame).collect(), key=str)] == [r.asDict() for r in sorted(rows, key=str)]
    chosen = mixing.mixed_documents(frame)
    assert chosen.columns == frame.columns
    copies = collections.Counter(r["doc_id"] for r in chosen.collect())
    want = collections.Counter()
    for r in rows:
        want[r["doc_id"]] += r["passes"]
    assert copies == +want


def test_slices_do_not_change_the_mix(make_docs, monkeypatch):
    docs = make_docs([(i, "w " * (i % 13 + 1), "ab"[i % 5 == 0]) for i in range(400)])
    whole = {(r["doc_id"], r["taken"]) for r in mixing.mix(docs).collect()}
    monkeypatch.setattr(mixing, "ROWS_PER_SLICE", 7)
    assert {(r["doc_id"], r["taken"]) for r in mixing.mix(docs).collect()} == whole


def test_merged_slices_hold_similar_numbers_of_rows(make_docs, monkeypatch):
    """One long source beside short ones: ranges of virtual time must not gather the short ones' rows."""
    monkeypatch.setattr(mixing, "ROWS_PER_SLICE", 50)
    rows = [(i, "a b c " * 400, "long") for i in range(60)]
    rows += [(1000 + i, "a b c", f"s{i % 9}") for i in range(900)]
    sizes = mixing.document_sizes(make_docs(rows))
    sources = mixing.source_targets(sizes).cache()
    classes = mixing._expected_places(sources)
    at = sizes.join(sources, "source").withColumn(
        "n", F.row_number().over(Window.partitionBy("source").orderBy("key"))
    )
    times = at.select(F.explode(F.sequence(F.lit(0), F.lit(mixing.MAX_PASSES - 1))).alias("pass"), "*").select(
        ((F.col("pass") + F.col("n") / F.col("n_docs")) * F.col("source_size") / F.col("weight")).alias("finish")
    )
    times = times.withColumn("classes", classes.select("classes").scalar())
    held = times.groupBy(mixing._merged_slice(F.col("finish"), F.col("classes"))).count().collect()
    assert max(r["count"] for r in held) <= 2 * mixing.ROWS_PER_SLICE


def test_empty_mix(make_docs):
    assert mixing.mix(make_docs([])).count() == 0
    assert {r["taken"] for r in mixing.mix(make_docs([(1, None), (2, " ")])).collect()} == {0}


def measured(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    counts = collections.Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if counts[w] > 1 for k in range(3)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (
        len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered),
    )


def test_base_measures(spark, make_docs):
    draw = random.Random(2)
    texts = [" ".join(draw.choice("abcd") for _ in range(n)) for n in (0, 1, 2, 3, 4, 30, 200)]
    texts += [None, "", " \t\n", "a\nb\na\n\n \n \n", "x # | <\n\x0b y\u00a0z 漢字", "p q r " * 40, "\u3000a\u3000b", "long " * 30_000]
    texts += ["a b c d e f g h a b c", "a b c a b c"]
    labels = spark.createDataFrame([], "doc_id long, quality int")
    rows = rules.quality_rules(make_docs(list(enumerate(texts))), labels).collect()
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    for r in rows:
        want = measured(r["doc"]["text"])
        assert tuple(r[n] for n in names) == want, r["doc"]["text"]
        failed = want[0] < 50 or 100 * want[4] > 50 * want[0]
        assert (r["base_failed"], r["kept"], r["score"]) == (failed, not failed, 0.0)


def test_ratio_rejects_what_the_trusted_never_write(spark, make_docs):
    draw = random.Random(3)
    vocabulary = ["".join(draw.choice("abcdefg") for _ in range(4)) for _ in range(400)]
    good = [(i, " ".join(draw.choice(vocabulary) for _ in range(120))) for i in range(80)]
    bad = [(100 + i, " ".join(draw.choice(vocabulary) + "&&&" for _ in range(120))) for i in range(20)]
    labels = spark.createDataFrame([(i, 1) for i in range(40)] + [(100, 0), (None, 1)], "doc_id long, quality int")
    rows = rules.quality_rules(make_docs(good + bad + [(None, good[0][1])]), labels).collect()
    assert {r["doc"]["doc_id"] for r in rows if r["kept"]} == {i for i, _ in good} | {None}
    assert len({r["score"] for r in rows if r["doc"]["text"] == good[0][1]}) == 1


def test_ratios_match_plain_python(spark, make_docs):
    docs = make_docs([(1, "a b a"), (2, "b!! c")])
    trusted = spark.createDataFrame([(1,)], "doc_id long")
    ratios = rules.ratio_table(docs, trusted).first()["ratios"]
    bucket = docs.select("doc_id", rules._buckets(F.col("text")).alias("b")).collect()
    every = collections.Counter(x for r in bucket for x in r["b"])
    of_one = collections.Counter(x for r in bucket if r["doc_id"] == 1 for x in r["b"])
    assert sum(of_one.values()) == 5
    import math

    n = rules.N_BUCKETS
    for i in list(every)[:5] + [next(x for x in range(n) if x not in every)]:
        want = math.log((of_one[i] + 1) / (5 + n)) - math.log((every[i] + 1) / (sum(every.values()) + n))
        assert ratios[i] == pytest.approx(want)


def test_no_documents(spark, make_docs):
    labels = spark.createDataFrame([(1, 1)], "doc_id long, quality int")
    assert rules.quality_rules(make_docs([]), labels).count() == 0


def test_every_trusted_document_counts(spark):
    labels = spark.range(20_500).select(F.col("id").alias("doc_id"), F.lit(1).alias("quality"))
    bad = spark.createDataFrame([(7, 0), (None, 1)], "doc_id long, quality int")
    assert rules.trusted_ids(labels.unionByName(bad)).count() == 20_499


def test_trusted_documents_are_counted_apart_whatever_the_filter_lets_through(spark, make_docs, monkeypatch):
    """Counts by hand, with a filter so small that it lets most documents through, and repeated ids."""
    rows = [(i % 40, f"alpha beta{i % 3} gamma {i}") for i in range(60)] + [(None, "alpha"), (99, None)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(30)] + [(3, 0), (None, 1)], "doc_id long, quality int")
    trusted = {i for i in range(30) if i % 2} - {3}
    buckets = lambda texts: spark.createDataFrame([(t,) for t in texts], "text string").select(
        F.explode(rules._buckets(F.col("text"))).alias("b")
    )
    whole, part = buckets([t for _, t in rows]).collect(), buckets([t for i, t in rows if i in trusted]).collect()
    n, t = Counter(r["b"] for r in whole), Counter(r["b"] for r in part)
    share = lambda count, total: (count + rules.SMOOTHING) / (total + rules.SMOOTHING * rules.N_BUCKETS)
    for words in (1, 2**17):
        monkeypatch.setattr(rules, "FILTER_WORDS", words)
        ratios = rules.ratio_table(make_docs(rows), rules.trusted_ids(labels)).first()["ratios"]
        want = [math.log(share(t[b], len(part))) - math.log(share(n[b], len(whole))) for b in range(rules.N_BUCKETS)]
        assert max(abs(a - b) for a, b in zip(ratios, want, strict=True)) < 1e-12
