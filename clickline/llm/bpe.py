"""Byte-level BPE in DuckDB, inside each Spark partition.

Words become rows (word, position, token). A recursive query joins neighbouring tokens with the merge table and
contracts each word's pair of lowest rank, leftmost first, until no word has a pair left to merge. Decoding is an
ordered aggregation of the tokens' bytes.
"""

from __future__ import annotations

import base64
from collections.abc import Iterable, Iterator

import duckdb
import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from clickline.llm.pieces import Remembered, by_blocks, byte_offsets, for_worker

#: Rows that one recursive query may hold; it stops after the steps that fit and goes on in another.
MAX_STATE_ROWS = 4_000_000
#: Bytes of the words that are merged together, and the sum of their squares: each step of a word keeps a list.
BLOCK_BYTES, BLOCK_SQUARES = 300_000, 8_000_000
#: Stands for the rank of a pair that does not merge.
NEVER = 2**31 - 1

#: Words with more bytes than this merge at all places of a pair in one step.
LONG_WORD = 256

# A row holds a word: its tokens, and beside each the rank at which it merges with the next one (NEVER: not at all). One
# step contracts the leftmost pair of lowest rank of each word, and only the two pairs that the new token is in meet
# the merge table again. What is left of a pair at 1 is nothing, and a slice [:-1] would not be.
_LEFTMOST = """
WITH RECURSIVE state(w, t, k, least) AS (
    SELECT w, t, k, coalesce(list_min(k), $never) FROM words
    UNION ALL (
        WITH places AS (
            SELECT *, list_position(k, least) AS p FROM state WHERE least < $never
        ), pairs AS (
            SELECT *, t[p - 1] AS before, t[p + 2] AS after FROM places
        ), merged AS (
            SELECT s.w, s.t[:p - 1] || [least] || s.t[p + 2:] AS t,
                CASE WHEN p > 1 THEN k[:p - 2] || [coalesce(a.t, $never), coalesce(b.t, $never)]
                ELSE [coalesce(b.t, $never)] END || k[p + 2:] AS k
            FROM pairs s
            LEFT JOIN merges a ON a.l = s.before AND a.r = s.least
            LEFT JOIN merges b ON b.l = s.least AND b.r = s.after
        )
        SELECT w, t, k, list_min(k) FROM merged
    )
)
SELECT w, t FROM state WHERE least = $never ORDER BY w
"""

# For long words, where one place a step would take the square of the length: a step contracts the lowest rank at
# all its places, from the left and without overlap. That equals one place after the other unless the new token
# makes a pair of lower rank with a neighbour; a word where it does (``early``) has its leftmost place contracted only.
_ALL_PLACES = """
WITH RECURSIVE state(step, w, p, t, live) AS (
    SELECT 0, w, p, t, true FROM tokens
    UNION ALL (
        WITH neighbours AS (
            SELECT step, w, row_number() OVER x AS p, t, lead(t) OVER x AS u
            FROM state WHERE live AND step < $steps WINDOW x AS (PARTITION BY w ORDER BY p)
        ), pairs AS (
            SELECT n.w, n.p, m.t FROM neighbours n JOIN merges m ON m.l = n.t AND m.r = n.u
        ), lowest AS (
            SELECT w, min(t) AS t, min_by(p, (t, p)) AS p FROM pairs GROUP BY w
        ), candidates AS (
            SELECT p.w, p.p, p.t FROM pairs p JOIN lowest l ON p.w = l.w AND p.t = l.t
        ), early AS (
            SELECT c.w FROM candidates c JOIN neighbours n ON n.w = c.w AND n.p = c.p - 1
                JOIN merges m ON m.l = n.t AND m.r = c.t AND m.t < c.t
            UNION
            SELECT c.w FROM candidates c JOIN neighbours n ON n.w = c.w AND n.p = c.p + 2
                JOIN merges m ON m.l = c.t AND m.r = n.t AND m.t < c.t
            UNION
            SELECT l.w FROM lowest l JOIN merges m ON m.l = l.t AND m.r = l.t AND m.t < l.t
        ), places AS (
            SELECT c.w, c.p, c.t, c.p - row_number() OVER (PARTITION BY c.w ORDER BY c.p) AS run
            FROM candidates c JOIN lowest l ON c.w = l.w
            WHERE c.p = l.p OR c.w NOT IN (SELECT w FROM early)
        ), hits AS (
            SELECT w, p, t FROM places
            QUALIFY row_number() OVER (PARTITION BY w, run ORDER BY p) % 2 = 1
        )
        SELECT n.step + 1, n.w, n.p, coalesce(h.t, n.t), l.w IS NOT NULL
        FROM neighbours n
        LEFT JOIN lowest l ON l.w = n.w
        LEFT JOIN hits h ON h.w = n.w AND h.p = n.p
        LEFT JOIN hits g ON g.w = n.w AND g.p = n.p - 1
        WHERE g.w IS NULL
    )
)
SELECT w, p, t, live FROM state WHERE NOT live OR step = $steps ORDER BY w, p
"""


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes to rank, of a file with base64 tokens and ranks."""
    with open(path, "rb") as file:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}


class Merger:
    """The merge table of one vocabulary in a DuckDB database that lives in this process only."""

    def __init__(self, ranks: dict[bytes, int]) -> None:
        self.ranks = ranks
        self.of_byte = np.array([ranks[bytes([b])] for b in range(256)], "i4")
        merges = [
            (ranks[token[:i]], ranks[token[i:]], rank)
            for token, rank in ranks.items()
            for i in range(1, len(token))
            if token[:i] in ranks and token[i:] in ranks
        ]
        columns = list(zip(*merges, strict=True)) or [(), (), ()]
        self.db = duckdb.connect()
        self.db.execute("SET threads = 1")
        self._table("merges", **{c: pa.array(x, pa.int32()) for c, x in zip("lrt", columns, strict=True)})
        # The ranks of pairs of bytes, which every word starts with.
        self.of_pair = np.full((256, 256), NEVER, "i4")
        for token, rank in ranks.items():
            if len(token) == 2:
                self.of_pair[token[0], token[1]] = rank
        self._table("vocabulary", t=pa.array(list(ranks.values()), pa.int64()), hex=pa.array([k.hex() for k in ranks]))

    def _table(self, name: str, **columns: pa.Array) -> None:
        self.db.register("given", pa.table(columns))
        self.db.execute(f"CREATE OR REPLACE TABLE {name} AS SELECT * FROM given")
        self.db.unregister("given")

    def merge(self, words: list[bytes]) -> list[bytes]:
        """The token ids of each word, as little-endian 32-bit integers."""
        # A word that is a token stays whole, even where no order of merges leads to it.
        ids = [self.ranks[w].to_bytes(4, "little") if w in self.ranks else None for w in words]
        long = [i for i, w in enumerate(words) if ids[i] is None and len(w) > LONG_WORD]
        short = [i for i, w in enumerate(words) if ids[i] is None and len(w) <= LONG_WORD]
        for places, query in ((short, self._leftmost), (long, self._all_places)):
            if places:
                coded, ends = query([words[i] for i in places])
                low = 0
                for i, high in zip(places, ends, strict=True):
                    ids[i] = coded[low:high]
                    low = high
        return ids

    def _bytes(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """All bytes, and where each word ends."""
        return np.frombuffer(b"".join(words), "u1"), np.cumsum([len(w) for w in words])

    def _leftmost(self, words: list[bytes]) -> tuple[bytes, list[int]]:
        flat, ends = self._bytes(words)
        ranks = self.of_pair[flat, np.append(flat[1:], 0)]
        ranks[ends - 1] = NEVER
        offsets = pa.array(np.concatenate([[0], ends]), pa.int32())
        lists = (pa.ListArray.from_arrays(offsets, pa.array(x, pa.int32())) for x in (self.of_byte[flat], ranks))
        self._table("words", w=pa.array(np.arange(len(words))), **dict(zip("tk", lists, strict=True)))
        found = self.db.sql(_LEFTMOST, params={"never": NEVER}).to_arrow_table().column("t").combine_chunks()
        ends = 4 * np.cumsum(found.value_lengths().to_numpy(), dtype="i8")
        return found.flatten().to_numpy().astype("<i4").tobytes(), ends.tolist()

    def _all_places(self, words: list[bytes]) -> tuple[bytes, list[int]]:
        flat, ends = self._bytes(words)
        lengths = np.diff(ends, prepend=0)
        w, p, t = np.repeat(np.arange(len(words)), lengths), np.arange(len(flat)), self.of_byte[flat]
        done: list[tuple[np.ndarray, np.ndarray]] = []
        while len(w):
            self._table("tokens", w=pa.array(w, pa.int64()), p=pa.array(p, pa.int64()), t=pa.array(t, pa.int64()))
            got = self.db.execute(_ALL_PLACES, {"steps": max(1, MAX_STATE_ROWS // len(w))}).fetchnumpy()
            live = np.asarray(got["live"], bool)
            done.append((np.asarray(got["w"])[~live], np.asarray(got["t"])[~live]))
            w, p, t = (np.asarray(got[c])[live] for c in ("w", "p", "t"))
        w, t = (np.concatenate(x) for x in zip(*done, strict=True))
        order = np.argsort(w, kind="stable")
        return t[order].astype("<i4").tobytes(), (4 * np.cumsum(np.bincount(w, minlength=len(words)))).tolist()

    def decode(self, ids: list[bytes]) -> list[bytes]:
        """The bytes of each list of ids."""
        row = np.repeat(np.arange(len(ids)), [len(x) // 4 for x in ids])
        flat = np.frombuffer(b"".join(ids), "<i4")
        self._table("coded", row=pa.array(row, pa.int64()), p=pa.array(np.arange(len(row))), t=pa.array(flat, pa.int64()))
        found = self.db.execute(
            "SELECT row, string_agg(hex, '' ORDER BY p) AS hex FROM coded JOIN vocabulary USING (t) GROUP BY row"
        ).fetchnumpy()
        texts = [b""] * len(ids)
        for i, text in zip(found["row"].tolist(), found["hex"], strict=True):
            texts[i] = bytes.fromhex(text)
        return texts


class Coder:
    """Whole texts to (ids, decoded bytes); what repeats in a partition is merged once."""

    def __init__(self, ranks: dict[bytes, int]) -> None:
        self.merger = Merger(ranks)
        self.remembered = Remembered(self._merge_new, 2)

    def _merge_new(self, words: list[str]) -> list[tuple[bytes, bytes]]:
        coded = [w.encode() for w in words]
        lengths = np.array([len(w) for w in coded], "i8")
        # Words of similar length take similarly many steps.
        order = np.argsort(lengths, kind="stable")
        filled = np.cumsum(lengths[order]) // BLOCK_BYTES + np.cumsum(lengths[order] ** 2) // BLOCK_SQUARES
        made: list[tuple[bytes, bytes]] = [(b"", b"")] * len(words)
        for block in np.split(order, np.flatnonzero(np.diff(filled)) + 1):
            ids = self.merger.merge([coded[i] for i in block.tolist()])
            for i, pair in zip(block.tolist(), zip(ids, self.merger.decode(ids), strict=True), strict=True):
                made[i] = pair
        return made

    def code(self, texts: pa.Array) -> tuple[pa.LargeBinaryArray, pa.LargeBinaryArray]:
        """Little-endian 32-bit ids and decoded bytes of each text; null texts have none."""
        ids, decoded = self.remembered.encode(texts.fill_null(""))
        return ids, decoded


def id_lists(coded: pa.LargeBinaryArray) -> pa.ListArray:
    """Little-endian 32-bit ids of each row as one Arrow list array."""
    offsets = byte_offsets(coded)
    values = np.frombuffer(coded.buffers()[2] or b"", "u1")[offsets[0] : offsets[-1]].view("<i4")
    return pa.ListArray.from_arrays(pa.array(((offsets - offsets[0]) // 4).astype("i4")), pa.array(values))


def encode_and_decode(docs: DataFrame, ranks_path: str | None = None) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): ``doc_id``, ``ids`` (array of int) and ``decoded`` (binary).

    ``ranks_path`` names a file of base64 tokens and ranks on every executor. Each match of the public
    pre-tokenization pattern is merged separately, without special tokens; ``decoded`` comes from the ids. Null
    and empty texts give no ids and empty bytes. Long texts and long words are coded whole: a recursive query holds at most
    ``MAX_STATE_ROWS`` rows, or one step's, at a time. Repeated rows and null ids are kept. Other columns are ignored. An
    empty table gives an empty result. Nothing is shuffled; a lost task is simply run again.
    """
    path = ranks_path or public_tokenizers.path("byte_bpe_multi_50k.tiktoken")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = for_worker(f"bpe {path}", lambda: Coder(read_ranks(path)))
        for batch in by_blocks(batches):
            ids, decoded = coder.code(batch.column(1))
            columns = [batch.column(0), id_lists(ids), decoded.cast(pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "ids", "decoded"])

    schema = T.StructType(
        [
            T.StructField("doc_id", docs.schema["doc_id"].dataType),
            T.StructField("ids", T.ArrayType(T.IntegerType())),
            T.StructField("decoded", T.BinaryType()),
        ]
    )
    return docs.select("doc_id", "text").mapInArrow(run, schema)
