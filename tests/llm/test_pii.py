"""Personal data: as written against plain patterns, disguises with their places."""

from __future__ import annotations

import hashlib
import random
import re
import time

import pytest

from clickline.llm import pii, queries


def plainly(text):
    """The contract, pattern by pattern: (start, kind's place, end)."""
    found = [(m.start(), 0, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(part) <= 255 for part in m.group().split(".")):
            found.append((m.start(), 1, m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[^0-9]", "", m.group())
        total = sum(sum(divmod(int(d) * (1 + i % 2), 10)) for i, d in enumerate(reversed(digits)))
        if 14 <= len(digits) <= 19 and total % 10 == 0:
            found.append((m.start(), 2, m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 10 <= len(re.sub("[^0-9]", "", m.group())) <= 15:
            found.append((m.start(), 3, m.end()))
    return sorted(found)


def test_base_equals_plain_patterns():
    draw = random.Random(1)
    for i in range(20000):
        letters = draw.choice(["ab@.-+1 ", "0123456789 -.+()", "a@.1", "12.@+ -", "\u00e9@a.1%_", "0 -", "1.2"])
        text = "".join(draw.choice(letters) for _ in range(draw.randrange(60)))
        text += "4111 1111 1111 1111" + text if i % 7 == 0 else ""
        assert [(s.start, pii.KINDS.index(s.kind), s.end) for s in pii.detect(text)] == plainly(text), text


DISGUISES = [
    ("mail john (at) example (dot) com now", "email", "john (at) example (dot) com", "john@example.com"),
    ("john at example dot com", "email", "john at example dot com", "john@example.com"),
    ("[foo[at]bar.com]", "email", "foo[at]bar.com", "foo@bar.com"),
    ("at j\u043ehn@ex\u0430mple.com!", "email", "j\u043ehn@ex\u0430mple.com", "john@example.com"),
    ("jo\u200bhn@exa\u00admple.com", "email", "jo\u200bhn@exa\u00admple.com", "john@example.com"),
    ("host 10 dot 0 dot 0 dot 1.", "ip", "10 dot 0 dot 0 dot 1", "10.0.0.1"),
    ("\uff14\uff11\uff11\uff11 1111 1111 1111", "card", "\uff14\uff11\uff11\uff11 1111 1111 1111", "4111 1111 1111 1111"),
    ("x 4l11 1111 1111 1I11 x", "card", "4l11 1111 1111 1I11", "4111 1111 1111 1111"),
    ("call +1 (four one five) 555-2671", "phone", "+1 (four one five) 555-2671", "+1 (415) 555-2671"),
]


@pytest.mark.parametrize("text, kind, source, value", DISGUISES)
def test_disguises(text, kind, source, value):
    for before in ("", "\u00e9 \u0430\u200b one two three; " * 3):
        found = [s for s in pii.find(before + text) if s[0] == kind]
        assert [(found[0][3], found[0][4])] == [(value, False)] and len(found) == 1
        assert (before + text)[found[0][1] : found[0][2]] == source


@pytest.mark.parametrize(
    "text",
    ["look at the dot com", "we met at noon", "one two three four", "\u0430\u0435\u043e at home", "page 3 dot 4", "at at at dot dot", "(at) (dot)", "\u200b" * 9],
)
def test_clean_texts_are_left_alone(text):
    assert pii.find(text) == []


def test_base_spans_stay_among_disguises():
    text = "a@b.co, \u0441@d.eu; 1.2.3.4 at x dot y " * 20
    base = [s for s in pii.find(text) if s[4]]
    assert [(s[1], pii.KINDS.index(s[0]), s[2]) for s in base] == plainly(text)
    assert any(not s[4] for s in pii.find(text))


@pytest.mark.parametrize(
    "part", ["a", "1", "a@", "1.", "+1 ", "one ", " at a", "a dot ", "(", "(at", " ", "\u200b", "1 ", "+1(", "a@a.", "\uff11"]
)
def test_long_runs_take_linear_time(part):
    started = time.process_time()
    pii.find(part * (400_000 // len(part)))
    assert time.process_time() - started < 20


def test_query(spark, sf_dir):
    got = queries.personal_data(spark, sf_dir)
    assert got.columns == ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"]
    texts = queries.table(spark, sf_dir, "documents").select("doc_id", "text").collect()
    want = set()
    for row in texts:
        found = plainly(row["text"] or "")
        listed = ",".join(f"{pii.KINDS[kind]}:{start}:{end}" for start, kind, end in found)
        counts = [sum(f[1] == kind for f in found) for kind in range(4)]
        want.add((row["doc_id"], *counts, hashlib.sha256(listed.encode()).hexdigest(), listed))
    # No text of these tables is disguised.
    assert {tuple(r) for r in got.collect()} == want and got.count() == len(texts)


def test_nulls_and_other_columns(spark, make_docs):
    rows = [(1, None), (2, ""), (None, "a@b.co"), (3, "a@b.co"), (3, "a@b.co")]
    got = pii.find_personal_data(make_docs(rows))
    assert got.count() == 5 and got.select("doc.*").columns == make_docs(rows).columns
    assert sorted(len(r["spans"]) for r in got.collect()) == [0, 0, 1, 1, 1]
    assert pii.find_personal_data(make_docs([])).count() == 0
