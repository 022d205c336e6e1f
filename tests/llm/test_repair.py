"""Structure repair against an exhaustive search over edits."""

from __future__ import annotations

import hashlib
import random
import re
import zlib

import pytest

from clickline.llm import queries, repair

PREFIX = re.compile("s?(ua)*u?")


def faults_of(rows):
    seen, faults = set(), []
    for role, text in rows:
        visible = re.findall(r"[^\x20\x09-\x0D]", text)
        if not visible:
            faults.append("blank")
        elif (role, text) in seen:
            faults.append("duplicate")
        else:
            faults.append("truncated" if visible[-1] not in ".!?" else "")
        seen.add((role, text))
    return faults


def searched(rows):
    """(cost, audit, digest) of the best of all edits, with up to two insertions in a row."""
    faults, found = faults_of(rows), []

    def go(i, inserted, roles, cost, audit, kept):
        if not PREFIX.fullmatch(roles):
            return
        if i == len(rows) and re.fullmatch("(s?(ua)+)?", roles):
            found.append((cost, audit, kept))
        if inserted < 2:
            for new in ("user", "assistant"):
                go(i, inserted + 1, roles + new[0], cost + 2, audit + "I", [*kept, f"{new}:"])
        if i == len(rows):
            return
        (role, text), extra = rows[i], faults[i] == "truncated"
        go(i + 1, 0, roles, cost + 3, audit + "D", kept)
        if faults[i] in ("", "truncated"):
            if role:
                go(i + 1, 0, roles + role[0], cost + extra, audit + "K", [*kept, f"{role}:{text}"])
            for new in ("user", "assistant"):
                go(i + 1, 0, roles + new[0], cost + 2 + extra, audit + "R", [*kept, f"{new}:{text}"])

    go(0, 0, "", 0, "", [])
    cost, audit, kept = min(found, key=lambda f: f[:2])
    return cost, audit, hashlib.sha256("\n".join(kept).encode()).hexdigest()


def by_strings(rows):
    """The same, with whole audits as strings, for long conversations."""
    faults, best = faults_of(rows), {"": (0, "", ())}
    moves = {"": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}
    new = {"": "user", "s": "user", "u": "assistant", "a": "user"}

    def put(into, state, way):
        if state not in into or way[:2] < into[state][:2]:
            into[state] = way

    def insert():
        for state in ("", "s", "a", "u"):
            if state in best:
                cost, audit, kept = best[state]
                put(best, moves[state][new[state][0]], (cost + 2, audit + "I", (kept, f"{new[state]}:")))

    for (role, text), fault in zip(rows, faults):
        insert()
        then = {}
        for state, (cost, audit, kept) in best.items():
            put(then, state, (cost + 3, audit + "D", kept))
            if fault in ("", "truncated"):
                extra = fault == "truncated"
                if role[:1] in moves[state]:
                    put(then, moves[state][role[:1]], (cost + extra, audit + "K", (kept, f"{role}:{text}")))
                put(then, moves[state][new[state][0]], (cost + 2 + extra, audit + "R", (kept, f"{new[state]}:{text}")))
        best = then
    insert()
    cost, audit, kept = min((best[s] for s in ("", "a") if s in best), key=lambda w: w[:2])
    said = []
    while kept:
        kept, last = kept
        said.append(last)
    return cost, audit, hashlib.sha256("\n".join(reversed(said)).encode()).hexdigest()


def repaired(rows):
    one = repair.Repair()
    for turn, (role, text) in enumerate(rows):
        one.add(turn, role, text)
    got = one.result()
    faults = faults_of(rows)
    assert [got[f] for f in ("blank", "duplicate", "truncated")] == [faults.count(f) for f in ("blank", "duplicate", "truncated")]
    return got["cost"], got["audit"], got["repaired_sha256"]


@pytest.mark.parametrize("cut_after", [4096, 2])
def test_equals_exhaustive_search(monkeypatch, cut_after):
    monkeypatch.setattr(repair, "_CUT_AFTER", cut_after)
    draw = random.Random(cut_after)
    roles = ["user", "assistant", "system", "user", "assistant", "tool", ""]
    for _ in range(600):
        rows = [(draw.choice(roles), draw.choice(["a.", "b?", "c", "", " ", "d!"])) for _ in range(draw.randrange(6))]
        assert repaired(rows) == searched(rows), rows


@pytest.mark.parametrize("cut_after", [4096, 50])
def test_long_conversations_with_many_ties(monkeypatch, cut_after):
    monkeypatch.setattr(repair, "_CUT_AFTER", cut_after)
    draw = random.Random(cut_after)
    for roles in (["user"], ["assistant", "system"], ["user", "assistant", "system", "x"]):
        rows = [(draw.choice(roles), draw.choice([f"t{i}.", f"t{i}", "same.", "\t"])) for i in range(500)]
        assert repaired(rows) == by_strings(rows)


def test_audits_are_compared_like_strings():
    draw, tree = random.Random(4), repair.Tree()
    nodes = [0]
    for _ in range(400):
        nodes.append(tree.extend(draw.choice(nodes[-30:]), draw.choice("DIKR")))
    for _ in range(3000):
        a, b = draw.choice(nodes), draw.choice(nodes)
        assert tree.less(a, b) == (tree.path(a) < tree.path(b))


def test_equal_hashes_are_verified(monkeypatch):
    monkeypatch.setattr(repair, "_MODULUS", 1)
    rows = [("user", f"t{i}" + "."[: i % 2]) for i in range(60)]
    assert repaired(rows) == by_strings(rows)


def plain_damage(rows):
    out = []
    for conv_id, turn, role, text in rows:
        shown = [" " if v is None else str(v) for v in (conv_id, turn, role, text)]
        kind = zlib.crc32(f"{shown[0]}:{shown[1]}".encode()) % 20
        if kind == 0:
            continue
        said = "" if kind == 1 else re.sub("[.!?]", "", shown[3]) if kind == 2 else shown[3]
        row = (conv_id, turn, "user" if kind == 4 else shown[2], said)
        out += [row, row] if kind == 3 else [row]
    return out


def check_table(rows, got):
    left = {}
    for row in plain_damage(rows):
        left.setdefault(row[0], []).append(row)
    assert len(got) == len({r[0] for r in rows})
    for r in got:
        mine = sorted(left.get(r["conv_id"], []), key=lambda x: (x[1] is not None, x[1] or 0, x[2], x[3]))
        pairs = [row[2:] for row in mine]
        turns = {row[1] for row in mine} - {None}
        faults, initials = faults_of(pairs), [p[0][:1] for p in pairs]
        want = {
            "gaps": max(turns) - min(turns) + 1 - len(turns) if turns else 0,
            "blank": faults.count("blank"),
            "duplicate": faults.count("duplicate"),
            "truncated": faults.count("truncated"),
            "illegal": sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])),
        }
        cost, audit, digest = by_strings(pairs)
        assert r.asDict() == {"conv_id": r["conv_id"], **want, "cost": cost, "audit": audit, "repaired_sha256": digest}


def test_query(spark, sf_dir):
    rows = [tuple(r) for r in queries.table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").collect()]
    got = queries.structure_repair(spark, sf_dir)
    assert got.columns == ["conv_id", *repair.COUNTS, "audit", "repaired_sha256"]
    check_table(rows, got.collect())


def test_nulls_ties_repeats_and_other_columns(spark):
    draw = random.Random(9)
    rows = [
        (draw.choice([None, 1, 2, 3]), draw.choice([None, 0, 1, 2, 9]), draw.choice([None, "user", "assistant", "", "system"]),
         draw.choice([None, "", "yes.", "no", " \n", "x" * 100_000 + "!"]))
        for _ in range(120)
    ]
    rows += [(50 + i, 0, "user", "a.") for i in range(60)]  # some lose their only row
    frame = spark.createDataFrame([(*r, 1, "x", True) for r in rows], "conv_id long, turn long, role string, text string, kind int, copy string, gone boolean")
    got = repair.repair_conversations(repair.damaged(frame.repartition(4))).collect()
    check_table(rows, got)
    empty = hashlib.sha256(b"").hexdigest()
    assert any(r["audit"] == "" and r["repaired_sha256"] == empty for r in got)
    assert repair.repair_conversations(repair.damaged(frame.limit(0))).count() == 0
