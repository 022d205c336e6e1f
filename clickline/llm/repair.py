"""Conversation structure repair at the least cost, with an audit of the edits.

Rows of a conversation, in order, are kept (K), given another role (R), deleted (D), or have an empty turn inserted before
or after them (I), until the role initials read ``(s?(ua)+)?``. One pass keeps, for each of the four states of that
pattern, the cheapest edits so far. Their audits are paths in one tree of linked nodes, so states share prefixes. Each
node has binary-lifting ancestors and a rolling hash of its path; where two audits cost the same, the tree is searched
for their longest common prefix, and the first letters that differ decide. Nodes are unique by (parent, letter), so equal
hashes are verified by identity. Two audits of one state and cost never are prefixes of each other: both hold a
letter per row, so one would have insertions more, at the same cost.

Rows are shuffled by conversation and stream through their task in order; a state holds a running digest of its repaired
text, so texts are not held. What is held for a conversation is its audit, a letter per edit, the tree where
states still differ (cut down to it every so often), and a digest per distinct turn to know duplicates.

Defined results: null role or text is one space (as the contract says), a null turn stands first, rows of one turn stand by role,
then text; a null conversation id is a conversation of its own; rows that repeat are duplicates; an empty table
gives no rows. Other columns, whatever their names, are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

KEEP, REROLE, DELETE, INSERT = "K", "R", "D", "I"
COST = {KEEP: 0, REROLE: 2, DELETE: 3, INSERT: 2}
TRUNCATED_COST = 1

#: States of the pattern: nothing yet, after s, after u, after a. What may follow, and where it leads.
_START, _SYSTEM, _USER, _ASSISTANT = range(4)
_NEXT = {
    _START: {"s": _SYSTEM, "u": _USER},
    _SYSTEM: {"u": _USER},
    _USER: {"a": _ASSISTANT},
    _ASSISTANT: {"u": _USER},
}
#: The role that a new or changed turn gets in a state.
_ROLE = {_START: "user", _SYSTEM: "user", _USER: "assistant", _ASSISTANT: "user"}
_LEGAL = {"su", "ua", "au"}
_VISIBLE = re.compile(r"[^\x20\x09-\x0D]")
_SPACES = "\x20\x09\x0a\x0b\x0c\x0d"
#: Rows after which the tree is cut down.
_CUT_AFTER = 4096
_MODULUS, _BASE = 2**61 - 1, 1_000_003


class Tree:
    """Audits as paths from a root. Node 0 is the empty audit."""

    def __init__(self) -> None:
        self.letters, self.depths, self.hashes = [""], [0], [0]
        self.ancestors: list[list[int]] = [[]]  # the 1st, 2nd, 4th, ... above each node
        self.children: dict[tuple[int, str], int] = {}

    def extend(self, node: int, letter: str) -> int:
        known = self.children.get((node, letter))
        if known is not None:
            return known
        new = len(self.letters)
        above, i = [node], 0
        while i < len(self.ancestors[above[i]]):
            above.append(self.ancestors[above[i]][i])
            i += 1
        self.letters.append(letter)
        self.depths.append(self.depths[node] + 1)
        self.hashes.append((self.hashes[node] * _BASE + ord(letter)) % _MODULUS)
        self.ancestors.append(above)
        self.children[node, letter] = new
        return new

    def _lifted(self, node: int, depth: int) -> int:
        up = self.depths[node] - depth
        while up:
            step = up.bit_length() - 1
            node, up = self.ancestors[node][step], up - (1 << step)
        return node

    def _same(self, a: int, b: int) -> bool:
        """Equal paths; a hash alone does not prove it."""
        return self.hashes[a] == self.hashes[b] and a == b

    def common(self, a: int, b: int) -> int:
        """The node of the longest common prefix."""
        depth = min(self.depths[a], self.depths[b])
        a, b = self._lifted(a, depth), self._lifted(b, depth)
        if self._same(a, b):
            return a
        for step in reversed(range(len(self.ancestors[a]))):
            if step < len(self.ancestors[a]) and not self._same(self.ancestors[a][step], self.ancestors[b][step]):
                a, b = self.ancestors[a][step], self.ancestors[b][step]
        return self.ancestors[a][0]

    def less(self, a: int, b: int) -> bool:
        """Whether audit ``a`` stands before ``b``; a prefix stands first."""
        prefix = self.common(a, b)
        depth = self.depths[prefix] + 1
        if self.depths[b] < depth:
            return False
        if self.depths[a] < depth:
            return True
        return self.letters[self._lifted(a, depth)] < self.letters[self._lifted(b, depth)]

    def path(self, node: int, root: int = 0) -> str:
        """The letters below ``root`` down to ``node``."""
        letters = []
        while node != root:
            letters.append(self.letters[node])
            node = self.ancestors[node][0]
        return "".join(reversed(letters))


class _Best:
    """The cheapest way into a state: its cost, audit and digest of the repaired text so far."""

    __slots__ = ("cost", "node", "digest", "turns")

    def __init__(self, cost: int, node: int, digest, turns: int) -> None:
        self.cost, self.node, self.digest, self.turns = cost, node, digest, turns

    def said(self, role: str, text: str) -> None:
        self.digest = self.digest.copy()
        self.digest.update((("\n" if self.turns else "") + role + ":" + text).encode())
        self.turns += 1


class Repair:
    """Repairs one conversation, row by row."""

    def __init__(self) -> None:
        self.tree, self.settled, self.rows = Tree(), [], 0
        self.states: list[_Best | None] = [_Best(0, 0, hashlib.sha256(), 0), None, None, None]
        self.blank = self.duplicate = self.truncated = self.illegal = 0
        self.seen: set[bytes] = set()
        self.initial: str | None = None
        self.lowest = self.highest = None
        self.turns = 0

    def add(self, turn: int | None, role: str, text: str) -> None:
        if turn is not None:
            if self.highest != turn:
                self.turns += 1  # rows come in the order of their turns
            self.lowest = turn if self.lowest is None else self.lowest
            self.highest = turn
        if self.initial is not None and self.initial + role[:1] not in _LEGAL:
            self.illegal += 1
        self.initial = role[:1]

        key = hashlib.sha256(f"{len(role)}:{role}{text}".encode("utf-8", "surrogatepass")).digest()[:16]
        blank, duplicate = not _VISIBLE.search(text), key in self.seen
        self.seen.add(key)
        truncated = not blank and not duplicate and text.rstrip(_SPACES)[-1] not in ".!?"
        self.blank += blank
        self.duplicate += duplicate and not blank
        self.truncated += truncated
        self._insert()
        self._step(role, text, blank or duplicate, truncated)
        self.rows += 1
        if self.rows % _CUT_AFTER == 0:
            self._cut()

    def _better(self, cost: int, node: int, letter: str, than: tuple[int, int] | None) -> bool:
        """Whether (cost, the audit of ``node`` and ``letter``) beats (cost, audit)."""
        if than is None or cost != than[0]:
            return than is None or cost < than[0]
        return self.tree.less(self.tree.extend(node, letter), than[1])

    def _insert(self) -> None:
        """Empty turns where they make a state cheaper. Into u first, since from u one leads on to a."""
        for sources in ((_START, _SYSTEM, _ASSISTANT), (_USER,)):
            for source in sources:
                best = self.states[source]
                if best is None:
                    continue
                role = _ROLE[source]
                target = _NEXT[source][role[0]]
                now = self.states[target]
                cost = best.cost + COST[INSERT]
                if self._better(cost, best.node, INSERT, now and (now.cost, now.node)):
                    new = _Best(cost, self.tree.extend(best.node, INSERT), best.digest, best.turns)
                    new.said(role, "")
                    self.states[target] = new

    def _step(self, role: str, text: str, must_go: bool, truncated: bool) -> None:
        chosen: list[tuple[int, int, _Best, str] | None] = [None] * 4
        for state, best in enumerate(self.states):
            if best is None:
                continue
            ways = [(DELETE, state)]
            if not must_go:
                if role[:1] in _NEXT[state]:
                    ways.append((KEEP, _NEXT[state][role[:1]]))
                ways.append((REROLE, _NEXT[state][_ROLE[state][0]]))
            for letter, target in ways:
                cost = best.cost + COST[letter] + (TRUNCATED_COST if truncated and letter != DELETE else 0)
                now = chosen[target]
                if self._better(cost, best.node, letter, now and now[:2]):
                    becomes = {DELETE: "", KEEP: role, REROLE: _ROLE[state]}[letter]
                    chosen[target] = (cost, self.tree.extend(best.node, letter), best, becomes if letter != DELETE else None)
        self.states = [None] * 4
        for state, way in enumerate(chosen):
            if way is not None:
                cost, node, best, said = way
                self.states[state] = _Best(cost, node, best.digest, best.turns)
                if said is not None:
                    self.states[state].said(said, text)

    def _cut(self) -> None:
        """Settles the prefix that all states share and keeps the rest of their audits only."""
        live = [best for best in self.states if best is not None]
        shared = live[0].node
        for best in live[1:]:
            shared = self.tree.common(shared, best.node)
        rests = [self.tree.path(best.node, shared) for best in live]
        self.settled.append(self.tree.path(shared))
        self.tree = Tree()
        for best, rest in zip(live, rests):
            best.node = 0
            for letter in rest:
                best.node = self.tree.extend(best.node, letter)

    def result(self) -> dict:
        self._insert()
        ends = [best for best in (self.states[_START], self.states[_ASSISTANT]) if best is not None]
        best = ends[0]
        for other in ends[1:]:
            if other.cost < best.cost or (other.cost == best.cost and self.tree.less(other.node, best.node)):
                best = other
        gaps = 0 if self.highest is None else self.highest - self.lowest + 1 - self.turns
        return {
            "gaps": gaps,
            "blank": self.blank,
            "duplicate": self.duplicate,
            "truncated": self.truncated,
            "illegal": self.illegal,
            "cost": best.cost,
            "audit": "".join(self.settled) + self.tree.path(best.node),
            "repaired_sha256": best.digest.hexdigest(),
        }


COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def damaged(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, gone: the rows after the damage of the contract. A dropped row stays, marked, for its id."""

    def shown(column: str) -> Column:
        return F.coalesce(F.col(column).cast("string"), F.lit(" "))

    digest = F.crc32(F.concat(shown("conv_id"), F.lit(":"), shown("turn")).cast("binary"))
    kind, text = F.col("kind"), shown("text")
    said = F.when(kind == 1, "").when(kind == 2, F.regexp_replace(text, "[.!?]", "")).when(kind != 0, text)
    return (
        rows.select("conv_id", "turn", "role", "text", F.pmod(digest, F.lit(20)).alias("kind"))
        .withColumn("copy", F.explode(F.when(kind == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))
        .select("conv_id", "turn", F.when(kind == 4, "user").otherwise(shown("role")).alias("role"), said.alias("text"), (kind == 0).alias("gone"))
    )


def repair_conversations(rows: DataFrame) -> DataFrame:
    """One row per conversation of ``rows`` (conv_id, turn, role, text, and where true ``gone``)."""
    kept = rows if "gone" in rows.columns else rows.withColumn("gone", F.lit(False))
    kept = kept.select(
        "conv_id", F.col("turn").cast("long").alias("turn"), F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"), "gone"
    )
    order = [F.col(c).asc_nulls_first() for c in ("conv_id", "turn", "role", "text")]
    laid_out = kept.repartition("conv_id").sortWithinPartitions(*order)
    schema = T.StructType(
        [rows.schema["conv_id"]]
        + [T.StructField(name, T.LongType()) for name in COUNTS]
        + [T.StructField("audit", T.StringType()), T.StructField("repaired_sha256", T.StringType())]
    )
    return laid_out.mapInArrow(_repair, schema)


def _repair(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    conversation, repair, kind = None, None, None
    ids, results = [], []

    def finished() -> pa.RecordBatch:
        columns = {"conv_id": pa.array(ids, kind)}
        columns |= {c: pa.array([r[c] for r in results], pa.int64()) for c in COUNTS}
        columns |= {c: pa.array([r[c] for r in results], pa.string()) for c in ("audit", "repaired_sha256")}
        return pa.RecordBatch.from_pydict(columns)

    for batch in batches:
        kind = batch.schema.field("conv_id").type
        for conv_id, turn, role, text, gone in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "turn", "role", "text", "gone"))):
            if repair is None or conv_id != conversation:
                if repair is not None:
                    ids.append(conversation)
                    results.append(repair.result())
                conversation, repair = conv_id, Repair()
            if not gone:
                repair.add(turn, role, text)
        if len(ids) >= 1000:
            yield finished()
            ids, results = [], []
    if repair is not None:
        ids.append(conversation)
        results.append(repair.result())
        yield finished()
