"""Embedding near-duplicates by product quantisation.

Every vector is put into the inverted list of its nearest coarse centre, and its residual is coded in subspaces.
Every vector then probes the lists that a neighbour may be in. Inside a list the distance to each member
comes from lookup tables of the probing vector (asymmetric distances); members that can be near enough
are compared exactly. No pair leaves a list: per vector the number of links, and one edge towards its component.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickline.llm.jaccard import spanning
from clickline.llm.shared import components, stored

SIMILARITY = 0.95
#: Vectors that the centres and codes are fitted on, at most (smallest hash first). Every vector is indexed.
FIT_ROWS = 20_000
MAX_LISTS = 4_096
SUBSPACES, CODES, ROUNDS, SEED = 8, 256, 8, 11
#: A list is probed if a vector within ``reach`` times the link distance could lie in it. 1 finds every link, whatever its
#: direction. Among d directions a step goes about 1 / sqrt(d) of its length towards a given centre, so the reach is this
#: many times that, and 1 where the vectors have few directions.
DEVIATIONS = 2.8
#: Places in the sample, and their nearest sample vectors, that the number of directions is measured on.
PLACES, NEAREST = 64, 256
MEMBERS_PER_BLOCK, PROBES_PER_BLOCK = 512, 2_048


def _squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances of all rows of ``a`` to all rows of ``b``."""
    return np.maximum((a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2 * (a @ b.T), 0)


def _centres(x: np.ndarray, k: int, random: np.random.Generator) -> np.ndarray:
    """k-means with a few rounds; an empty centre stays where it was."""
    distinct = np.unique(x, axis=0)
    centres = distinct[random.permutation(len(distinct))[:k]]
    for _ in range(ROUNDS):
        nearest = np.concatenate([_squared(x[i : i + 4096], centres).argmin(1) for i in range(0, len(x), 4096)])
        count = np.bincount(nearest, minlength=len(centres))
        total = np.zeros_like(centres)
        np.add.at(total, nearest, x)
        centres = np.where(count[:, None] > 0, total / np.maximum(count, 1)[:, None], centres)
    return centres


@dataclass
class Index:
    """Coarse centres and, for each subspace, the codes of the residuals."""

    centres: np.ndarray
    codes: list[np.ndarray]
    cuts: list[int]
    similarity: float
    reach: float

    @property
    def radius(self) -> float:
        """Distance of two unit vectors with the smallest linked cosine."""
        return math.sqrt(max(0.0, 2 - 2 * self.similarity))

    def parts(self, x: np.ndarray) -> list[np.ndarray]:
        return [x[:, a:b] for a, b in zip(self.cuts[:-1], self.cuts[1:], strict=True)]

    def place(self, x: np.ndarray) -> tuple[np.ndarray, list[np.ndarray], np.ndarray, np.ndarray]:
        """Of unit vectors: home list, lists to probe (home first), codes, and distance to the decoded vector."""
        far = _squared(x, self.centres)
        home = far.argmin(1)
        between = np.sqrt(_squared(self.centres, self.centres))[home]
        # How far behind the plane midway between the home centre and each other centre the vector lies.
        margin = far - far[np.arange(len(x)), home][:, None] - 2 * self.reach * self.radius * between
        margin[np.arange(len(x)), home] = -np.inf
        probes = [np.flatnonzero(m <= 0) for m in margin]
        residual = x - self.centres[home]
        codes, error = [], np.zeros(len(x))
        for part, book in zip(self.parts(residual), self.codes, strict=True):
            distance = _squared(part, book)
            codes.append(distance.argmin(1))
            error += distance[np.arange(len(x)), codes[-1]]
        return home, probes, np.stack(codes, 1).astype("u1"), np.sqrt(error)

    def asymmetric(self, queries: np.ndarray, one_list: int, codes: np.ndarray) -> np.ndarray:
        """Distances of probing vectors to the decoded members of a list, by table lookup."""
        total = np.zeros((len(queries), len(codes)))
        for i, (part, book) in enumerate(zip(self.parts(queries - self.centres[one_list]), self.codes, strict=True)):
            total += _squared(part, book)[:, codes[:, i]]
        return np.sqrt(total)


def directions(sample: np.ndarray) -> float:
    """In how many directions the vectors near one another differ: the participation ratio of the variances around
    places of the sample, of which nine in ten have more."""
    random = np.random.default_rng(SEED)
    found = []
    for at in random.permutation(len(sample))[:PLACES]:
        near = sample[np.argsort(_squared(sample[at : at + 1], sample)[0], kind="stable")[:NEAREST]]
        variances = np.linalg.svd(near - near.mean(0), compute_uv=False) ** 2
        squares = float((variances**2).sum())
        found.append(float(variances.sum()) ** 2 / squares if squares > 0 else 1.0)
    return float(np.quantile(found, 0.1)) if found else 1.0


def fit(sample: np.ndarray, n_vectors: int, similarity: float = SIMILARITY, reach: float | None = None) -> Index:
    """An index for ``n_vectors``, about as many lists as the root of their number, from a sample of unit vectors. Without
    ``reach`` the sample's number of directions sets it."""
    if reach is None:
        reach = min(1.0, DEVIATIONS / math.sqrt(directions(sample)))
    random = np.random.default_rng(SEED)
    dims = sample.shape[1]
    subspaces = min(SUBSPACES, dims)
    cuts = [dims * i // subspaces for i in range(subspaces + 1)]
    lists = max(1, min(MAX_LISTS, math.isqrt(n_vectors), len(sample)))
    centres = _centres(sample, lists, random)
    nearest = np.concatenate([_squared(sample[i : i + 4096], centres).argmin(1) for i in range(0, len(sample), 4096)])
    residual = sample - centres[nearest]
    codes = [_centres(residual[:, a:b], CODES, random) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
    return Index(centres, codes, cuts, similarity, reach)


def unit(vectors: list[np.ndarray], dims: int) -> np.ndarray:
    """Rows of length one in double precision, padded with zeros to ``dims``."""
    out = np.zeros((len(vectors), dims))
    for i, v in enumerate(vectors):
        v = np.asarray(v, "f8")
        v = v / np.abs(v).max()  # very large and very small components stay in range when squared
        out[i, : len(v)] = v / np.sqrt((v * v).sum())
    return out


def _usable(vector: Column) -> Column:
    """Not null, not empty, not all zero, and every component there and finite."""

    def finite(x: Column) -> Column:
        return x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))

    return F.coalesce(F.forall(vector, finite) & F.exists(vector, lambda x: x != 0), F.lit(False))


def _search(index: Index):
    schema = pa.schema([("node", pa.int64()), ("links", pa.int64()), ("root", pa.int64())])
    dims = index.cuts[-1]

    def run(group: pa.Table) -> pa.Table:
        member = np.asarray(group["is_member"].to_numpy(zero_copy_only=False), bool)
        node, copies, home, size = (np.asarray(group[c]) for c in ("node", "copies", "home", "size"))
        m, q = np.flatnonzero(member), np.flatnonzero(~member)
        if not len(m) or not len(q):
            return schema.empty_table()
        x = unit([np.frombuffer(v, "f8") for v in group["vector"].to_pylist()], dims)
        one_list = int(home[m[0]])
        codes = np.array([np.frombuffer(group["codes"][int(i)].as_py(), "u1") for i in m])
        error = np.asarray(group["error"])[m]
        near = index.asymmetric(x[q], one_list, codes) <= index.radius + error[None, :] + 1e-9
        near &= (size[q][:, None] == size[m][None, :]) & (node[q][:, None] != node[m][None, :])
        # A pair meets in the list of either vector; it counts in its own list once, else in the lower list
        # if it meets there.
        probes = [set(p) for p in group["probes"].to_pylist()]
        same = home[q] == one_list
        near[same] &= node[q][same][:, None] > node[m][None, :]
        for h in np.unique(home[q][~same]):
            if h < one_list:
                rows = np.flatnonzero(home[q] == h)
                met = np.array([int(h) in probes[i] for i in m])
                near[np.ix_(rows, np.flatnonzero(met))] = False
        rows, columns = np.flatnonzero(near.any(1)), np.flatnonzero(near.any(0))
        if not len(rows):
            return schema.empty_table()
        q, m = q[rows], m[columns]
        linked = near[np.ix_(rows, columns)] & (x[q] @ x[m].T >= index.similarity)
        used = np.concatenate([q, m])
        links = np.zeros((len(used), len(used)), bool)
        links[: len(q), len(q) :] = linked
        # One vector may be here as member and as probe; both are one node.
        _, place = np.unique(node[used], return_inverse=True)
        merged = np.zeros((place.max() + 1, place.max() + 1), bool)
        a, b = np.nonzero(links)
        merged[place[a], place[b]] = merged[place[b], place[a]] = True
        nodes, weight = np.zeros(len(merged), "i8"), np.zeros(len(merged), "i8")
        nodes[place], weight[place] = node[used], copies[used]
        counts = merged @ weight
        some = counts > 0
        return pa.table([nodes[some], counts[some], nodes[spanning(merged)][some]], schema=schema)

    return run


def index_vectors(vectors: DataFrame, index: Index) -> DataFrame:
    """Adds home, probes, codes and error to rows with a ``vector`` of doubles."""
    dims = index.cuts[-1]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                raw = [np.array(v, "f8") for v in part.column(2).to_pylist()]
                home, probes, codes, error = index.place(unit(raw, dims))
                columns = [
                    part.column(0),
                    part.column(1),
                    pa.array([len(v) for v in raw], pa.int64()),
                    pa.array([v.tobytes() for v in raw], pa.binary()),
                    pa.array(home, pa.int64()),
                    pa.array([p.tolist() for p in probes], pa.list_(pa.int64())),
                    pa.array([c.tobytes() for c in codes], pa.binary()),
                    pa.array(error, pa.float64()),
                ]
                yield pa.RecordBatch.from_arrays(
                    columns, names=["node", "copies", "size", "vector", "home", "probes", "codes", "error"]
                )

    schema = "node long, copies long, size long, vector binary, home long, probes array<long>, codes binary, error double"
    return vectors.select("node", "copies", "vector").mapInArrow(run, schema)


def near_duplicates(
    embeddings: DataFrame, similarity: float = SIMILARITY, reach: float | None = None, fit_rows: int = FIT_ROWS
) -> DataFrame:
    """One row per row of ``embeddings`` (vec_id, embedding): ``vec_id``, ``n_links`` (other rows with a cosine of at
    least ``similarity``, in double precision), ``component_id`` (smallest vec_id reachable by links, itself
    included), ``kept`` (vec_id = component_id).

    Null, empty and zero vectors and those with null or non-finite components link with nothing; neither do vectors of
    different lengths. Equal vectors link and are searched once. Rows that repeat a vec_id share a component. Rows
    without vec_id cannot be named: n_links 0, no component, kept. Other columns are ignored. An empty table gives an
    empty result. No pair below ``similarity`` is linked; ``reach`` sets how surely links across lists are found;
    by default it follows from the number of directions in the fitted sample.
    """
    vector = F.transform("embedding", lambda x: x.cast("double"))
    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), vector.alias("vector"))
    # -0.0 and 0.0 are one number here, so that equal vectors group together.
    rows = rows.withColumn("vector", F.when(_usable(F.col("vector")), F.transform("vector", lambda x: x + F.lit(0.0))))
    named = rows.where("vec_id is not null and vector is not null")
    distinct = named.groupBy("vector").agg(F.min("vec_id").alias("node"), F.count("*").alias("copies"))
    distinct = stored(distinct, "vectors")
    n, dims = distinct.agg(F.count("*"), F.max(F.size("vector"))).first()
    plain = rows.select("vec_id", "vector")
    if not n:
        return _result(plain, None, None, None)
    sample = distinct.orderBy(F.xxhash64("node"), "node", "vector").limit(fit_rows).select("vector").collect()
    index = fit(unit([r["vector"] for r in sample], dims), n, similarity, reach)
    placed = stored(index_vectors(distinct, index), "lists")

    # Lists and those who probe them are divided into blocks, so no task depends on a list's length.
    probing = placed.withColumn("list", F.explode("probes")).withColumn("is_member", F.lit(False))
    members = placed.withColumn("list", F.col("home")).withColumn("is_member", F.lit(True))
    sizes = members.groupBy("list").agg(F.ceil(F.count("*") / MEMBERS_PER_BLOCK).alias("member_blocks"))
    asked = probing.groupBy("list").agg(F.ceil(F.count("*") / PROBES_PER_BLOCK).alias("probe_blocks"))
    blocks = sizes.join(asked, "list")
    mine = F.xxhash64("node", "vector")
    every = lambda count: F.sequence(F.lit(0).cast("long"), F.col(count) - 1)
    one = lambda count: F.pmod(mine, F.col(count))
    members = members.join(blocks, "list").withColumn("m", one("member_blocks")).withColumn("q", F.explode(every("probe_blocks")))
    probing = probing.join(blocks, "list").withColumn("q", one("probe_blocks")).withColumn("m", F.explode(every("member_blocks")))
    both = members.unionByName(probing).drop("member_blocks", "probe_blocks")
    found = both.groupBy("list", "m", "q").applyInArrow(_search(index), "node long, links long, root long")
    found = stored(found, "links")
    links = found.groupBy("node").agg(F.sum("links").alias("_links"))
    parts = components(found.select(F.col("root").alias("a"), F.col("node").alias("b")))
    return _result(plain, distinct, links, parts)


def _result(rows: DataFrame, distinct: DataFrame | None, links: DataFrame | None, parts: DataFrame | None) -> DataFrame:
    if distinct is None:
        joined = rows.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.lit(None).cast("long").alias("c"))
    else:
        of_vector = distinct.join(links, "node", "left").join(parts, "node", "left")
        of_vector = of_vector.select(
            F.col("vector").alias("_vector"),
            (F.col("copies") - 1 + F.coalesce("_links", F.lit(0))).alias("_n"),
            F.coalesce("component", "node").alias("c"),
        )
        usable = F.when(F.col("vec_id").isNotNull(), F.col("vector"))
        joined = rows.withColumn("vector", usable).join(of_vector, F.col("vector") == F.col("_vector"), "left")
        joined = joined.select("vec_id", F.coalesce("_n", F.lit(0)).alias("n_links"), "c")
    component = F.coalesce("c", "vec_id")
    return joined.select(
        "vec_id",
        "n_links",
        component.alias("component_id"),
        F.coalesce(component == F.col("vec_id"), F.lit(True)).alias("kept"),
    )
