"""N-gram Jaccard join: MinHash banding, then verification on the full n-gram sets.

Equal texts are first reduced to one. Documents that share a band hash are candidates; a bucket adds one edge from
each member to its smallest, never all pairs, and connected candidates form a neighbourhood. Inside a neighbourhood
all pairs whose sizes allow it are compared exactly, in blocks of documents, and what leaves a block is one row per
document: how many links it has there and one edge towards its class.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clickline.llm.shared import components, stored, text_key

WORDS = 5
SIMILARITY = 0.8
#: A pair at exactly ``SIMILARITY`` shares a band with this probability.
RECALL = 0.99999
#: Hash functions that a signature may take at most.
MAX_HASHES = 160
#: Documents on either side of a comparison.
BLOCK_DOCS = 512
SEED = 7


def choose_bands(similarity: float = SIMILARITY, recall: float = RECALL, max_hashes: int = MAX_HASHES) -> tuple[int, int]:
    """(bands, rows): as many rows per band as the hash functions allow, for fewest false candidates, and as many
    bands as the recall asks for."""
    best = None
    for rows in range(1, max_hashes + 1):
        hit = similarity**rows
        bands = 1 if hit >= 1 else math.ceil(math.log1p(-recall) / math.log1p(-hit))
        if bands * rows <= max_hashes:
            best = (bands, rows)
    if best is None:
        raise ValueError("max_hashes is too small for this recall")
    return best


def _mix(x: np.ndarray) -> np.ndarray:
    """Spreads 64-bit numbers evenly."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Shingler:
    """Texts to sets of hashed word n-grams, and those to band hashes."""

    def __init__(self, n_words: int = WORDS, bands: tuple[int, int] | None = None) -> None:
        random = np.random.default_rng(SEED)
        self.n_words, (self.bands, self.rows) = n_words, bands or choose_bands()
        self.step = random.integers(1, 2**63, 1, "u8") * np.uint64(2) + np.uint64(1)
        self.powers = np.cumprod(np.repeat(self.step, 1 << 16), dtype="u8")
        self.numbers = random.integers(1, 2**63, 256, "u8")
        self.places = random.integers(1, 2**63, n_words, "u8") * np.uint64(2) + np.uint64(1)
        n = self.bands * self.rows
        self.factors = (random.integers(0, 2**31, (n, 1), "u4") * np.uint32(2) + np.uint32(1)).astype("u4")
        self.offsets = random.integers(0, 2**32, (n, 1), "u8").astype("u4")
        self.row_factors = random.integers(1, 2**63, (1, self.rows), "u8") * np.uint64(2) + np.uint64(1)
        self.band_numbers = _mix(np.arange(1, self.bands + 1, dtype="u8"))

    def shingles(self, words: list[bytes]) -> np.ndarray:
        """Sorted distinct hashes of all runs of ``n_words`` words; a shorter text is one run, an empty one none."""
        if not words:
            return np.zeros(0, "u8")
        data = np.frombuffer(b"".join(words), "u1")
        lengths = np.array([len(w) for w in words])
        starts = np.cumsum(lengths) - lengths
        inside = np.arange(len(data)) - np.repeat(starts, lengths)
        hashes = _mix(np.add.reduceat(self.numbers[data] * self.powers[inside & 0xFFFF], starts) + lengths.astype("u8"))
        n = min(len(words), self.n_words)
        runs = len(words) - n + 1
        total = np.zeros(runs, "u8")
        for i in range(n):
            total += hashes[i : i + runs] * self.places[i]
        return np.unique(_mix(total + np.uint64(n)))

    def band_hashes(self, shingles: np.ndarray) -> np.ndarray:
        """One 64-bit number per band."""
        x = (shingles >> np.uint64(32)).astype("u4")
        lowest = np.full(len(self.factors), 0xFFFFFFFF, "u4")
        for at in range(0, len(x), 4096):
            part = self.factors * x[None, at : at + 4096]
            part += self.offsets
            np.minimum(lowest, part.min(axis=1), out=lowest)
        rows = lowest.reshape(self.bands, self.rows).astype("u8")
        return _mix((rows * self.row_factors).sum(axis=1) + self.band_numbers)


def _words(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").split()


def _content(words: list[bytes]) -> bytes:
    return hashlib.blake2b(b" ".join(words), digest_size=16).digest()


def fingerprints(docs: DataFrame, shingler: Shingler) -> DataFrame:
    """doc_id, content (16 bytes that name the text's words; null without words), n (n-grams), bands (array)."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            contents, sizes, bands = [], [], []
            for text in batch.column(1).to_pylist():
                words = _words(text)
                shingles = shingler.shingles(words)
                contents.append(_content(words) if words else None)
                sizes.append(len(shingles))
                bands.append(shingler.band_hashes(shingles).view("i8") if words else np.zeros(0, "i8"))
            ends = np.cumsum([0] + [len(b) for b in bands]).astype("i4")
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(bands) if bands else np.zeros(0, "i8")))
            columns = [batch.column(0), pa.array(contents, pa.binary()), pa.array(sizes, pa.int64()), lists]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "content", "n", "bands"])

    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return ids.mapInArrow(run, "doc_id long, content binary, n long, bands array<long>")


def linked(similarity: float, a: list[np.ndarray], b: list[np.ndarray]) -> np.ndarray:
    """Which sets of ``a`` and ``b`` have at least this Jaccard similarity, exactly, as a matrix."""
    sizes = np.array([len(x) for x in a + b], "i8")
    row = np.repeat(np.arange(len(sizes)), sizes)
    _, column, seen = np.unique(np.concatenate(a + b), return_inverse=True, return_counts=True)
    shared = seen[column] > 1  # an n-gram in one set only adds to no intersection
    row, column = row[shared], np.unique(column[shared], return_inverse=True)[1]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    common = np.zeros((len(a), len(b)), "f8")
    n_columns = int(column[-1]) + 1 if len(column) else 0
    for low in range(0, n_columns, 4096):
        i, j = np.searchsorted(column, [low, low + 4096])
        there = np.zeros((len(sizes), min(4096, n_columns - low)), "f4")
        there[row[i:j], column[i:j] - low] = 1
        common += there[: len(a)] @ there[len(a) :].T
    union = sizes[: len(a), None] + sizes[None, len(a) :] - common
    return common >= similarity * union - 1e-9


def spanning(links: np.ndarray) -> np.ndarray:
    """For each row of a symmetric link matrix, the smallest index in its connected part."""
    label = np.arange(len(links))
    while True:
        near = np.where(links, label[None, :], len(links)).min(axis=1, initial=len(links))
        lower = np.minimum(label, near)
        lower = lower[lower]
        if (lower == label).all():
            return label
        label = lower


def _compare(similarity: float):
    schema = pa.schema([("node", pa.int64()), ("links", pa.int64()), ("root", pa.int64())])

    def run(group: pa.Table) -> pa.Table:
        node, copies = (np.asarray(group[c]) for c in ("node", "copies"))
        sets = [np.frombuffer(x, "u8") for x in group["shingles"].to_pylist()]
        right = np.asarray(group["is_right"].to_numpy(zero_copy_only=False), bool)
        one_block = not right.any()
        a = np.flatnonzero(~right)
        b = a if one_block else np.flatnonzero(right)
        if not len(a) or not len(b):
            return schema.empty_table()
        links = np.zeros((len(node), len(node)), bool)
        links[np.ix_(a, b)] = linked(similarity, [sets[i] for i in a], [sets[i] for i in b])
        links |= links.T
        links &= node[:, None] != node[None, :]
        root = node[spanning(links)]
        # Links count documents, so each text counts with its copies.
        counts = links @ copies
        some = counts > 0
        return pa.table([node[some], counts[some], root[some]], schema=schema)

    return run


def _block_pairs(members: DataFrame, similarity: float, block_docs: int) -> DataFrame:
    """node, content and the comparisons (group, is_right) it takes part in.

    A neighbourhood that fits a block is one comparison. A larger one is divided by size, so that only documents of
    the same or the next size class can be similar enough, and each class into blocks by a hash of the id; then
    blocks are compared pairwise.
    """
    size_class = F.floor(F.log(F.col("n").cast("double")) / F.lit(-math.log(similarity) * (1 - 1e-9))).cast("long")
    counted = members.groupBy("component").agg(F.count("*").alias("whole"))
    members = members.join(counted, "component").withColumn("class", F.when(F.col("whole") > block_docs, size_class).otherwise(0))
    classes = members.groupBy("component", "class").agg(F.ceil(F.count("*") / block_docs).alias("blocks"))
    lower = classes.select("component", (F.col("class") + 1).alias("class"), F.col("blocks").alias("blocks_below"))
    upper = classes.select("component", (F.col("class") - 1).alias("class"), F.col("blocks").alias("blocks_above"))
    key = ["component", "class"]
    sized = classes.join(lower, key, "left").join(upper, key, "left").na.fill(0, ["blocks_below", "blocks_above"])
    members = members.join(sized, key).withColumn("block", F.pmod(F.xxhash64("node", "content"), "blocks"))

    def others(n: str):
        return F.when(F.col(n) > 0, F.sequence(F.lit(0).cast("long"), F.col(n) - 1)).otherwise(F.array().cast("array<bigint>"))

    here, mine = F.col("class"), F.col("block")

    def comparison(class_a, block_a, class_b, block_b, is_right):
        group = F.struct(class_a.alias("ca"), block_a.alias("ba"), class_b.alias("cb"), block_b.alias("bb"))
        return F.struct(group.alias("group"), is_right.alias("is_right"))

    within = F.transform(
        others("blocks"), lambda j: comparison(here, F.least(mine, j), here, F.greatest(mine, j), mine > j)
    )
    above = F.transform(others("blocks_above"), lambda j: comparison(here, mine, here + 1, j, F.lit(False)))
    below = F.transform(others("blocks_below"), lambda j: comparison(here - 1, j, here, mine, F.lit(True)))
    pairs = members.select("component", "node", "content", "copies", F.explode(F.concat(within, above, below)).alias("c"))
    return pairs.select("component", "node", "content", "copies", "c.group", "c.is_right")


def jaccard_join(
    docs: DataFrame,
    similarity: float = SIMILARITY,
    n_words: int = WORDS,
    recall: float = RECALL,
    block_docs: int = BLOCK_DOCS,
) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): ``doc_id``, ``n_links`` (other rows whose Jaccard similarity
    over n-grams of words is at least ``similarity``), ``class_id`` (smallest doc_id reachable by links, itself
    included) and ``kept`` (doc_id = class_id).

    Words are separated by ASCII white space. Texts shorter than ``n_words`` are one n-gram; null and blank texts
    have none and link with nothing. Equal texts link. Rows that repeat a doc_id are one document: they share a class.
    Rows without doc_id cannot be named: n_links 0, no class_id, kept. Other columns are ignored. An empty table
    gives an empty result. Long texts count whole. A link at ``similarity`` is found with probability ``recall`` and
    more similar ones more surely; no pair below it is linked, and groups of any size are compared in full.
    """
    shingler = Shingler(n_words, choose_bands(similarity, recall))
    prints = stored(fingerprints(docs, shingler), "prints")
    named = prints.where("doc_id is not null and content is not null")
    texts = stored(
        named.groupBy("content").agg(
            F.min("doc_id").alias("node"), F.count("*").alias("copies"), F.first("n").alias("n"), F.first("bands").alias("bands")
        ),
        "texts",
    )
    banded = texts.select("node", F.explode("bands").alias("band"))
    buckets = banded.groupBy("band").agg(F.min("node").alias("low"), F.max("node").alias("high")).where("low < high")
    candidates = banded.join(buckets.select("band", "low"), "band").select(F.col("low").alias("a"), F.col("node").alias("b"))
    near = components(candidates.where("a != b").distinct())

    members = texts.select("node", "content", "copies", "n").join(near, "node")
    comparisons = _block_pairs(stored(members, "members"), similarity, block_docs)

    def expand(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = [_words(t) for t in batch.column(1).to_pylist()]
            sets = [shingler.shingles(w).tobytes() for w in words]
            columns = [batch.column(0), pa.array([_content(w) for w in words], pa.binary()), pa.array(sets, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["_node", "_content", "shingles"])

    ids = near.select(F.col("node").alias("_id")).distinct()
    wanted = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(ids, F.col("doc_id") == F.col("_id"), "left_semi")
    sets = wanted.mapInArrow(expand, "_node long, _content binary, shingles binary").dropDuplicates(["_node", "_content"])
    here = (F.col("node") == F.col("_node")) & (F.col("content") == F.col("_content"))
    blocks = comparisons.join(sets, here).select("component", "group", "is_right", "node", "copies", "shingles")
    found = blocks.groupBy("component", "group").applyInArrow(_compare(similarity), "node long, links long, root long")
    found = stored(found, "links")

    links = found.groupBy("node").agg(F.sum("links").alias("_links"))
    classes = components(found.select(F.col("root").alias("a"), F.col("node").alias("b")))
    # Versions of one document share its class: a text's class is found by its smallest id, which is its node.
    of_text = (
        texts.select("content", "node", "copies")
        .join(links, "node", "left")
        .join(classes, "node", "left")
        .select(
            "content",
            (F.col("copies") - 1 + F.coalesce("_links", F.lit(0))).alias("n_links"),
            F.coalesce("component", "node").alias("class_id"),
        )
    )
    joined = prints.select("doc_id", F.when(F.col("doc_id").isNotNull(), F.col("content")).alias("content")).join(
        of_text, "content", "left"
    )
    class_id = F.coalesce("class_id", "doc_id")
    return joined.select(
        "doc_id",
        F.coalesce("n_links", F.lit(0)).alias("n_links"),
        class_id.alias("class_id"),
        F.coalesce(class_id == F.col("doc_id"), F.lit(True)).alias("kept"),
    )


def one_of_each(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that ``jaccard_join`` keeps: one of each class, that with the smallest doc_id.

    Of rows that repeat this id the one with the smallest text hash stays. Rows without doc_id stay.
    """
    kept = jaccard_join(docs).where("kept and doc_id is not null").select(F.col("doc_id").alias("_id")).distinct()
    packed = docs.select(F.struct("*").alias("doc"))
    named = packed.where("doc.doc_id is not null").join(kept, F.col("doc.doc_id") == F.col("_id"), "left_semi")
    order = Window.partitionBy("doc.doc_id").orderBy(text_key(F.col("doc.text")))
    first = named.withColumn("_number", F.row_number().over(order)).where("_number = 1").drop("_number")
    return first.unionByName(packed.where("doc.doc_id is null")).select("doc.*")
