"""Quality classifier: attention-based multiple-instance learning over passages.

A document is a bag of passages. Each passage is encoded on its own; a gated attention layer weighs the encoded
passages, and the weighted sum is scored. Only documents carry labels, so the attention learns by itself which
passages speak for or against a document.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickline.llm.shared import WORD_PATTERN, text_key

#: Words of a passage.
PASSAGE_WORDS = 50
#: Labelled documents the model is fitted on, at most (smallest md5 of the id first).
TRAIN_DOCS = 4_000
#: Passages of these documents together, at most; a document with more than a tenth of it is not learned from.
TRAIN_PASSAGES = 200_000
#: Text that is turned into features at once.
BLOCK_BYTES = 2 * 2**20
#: From this score on a document is predicted to be good.
GOOD = 0.7
HASHED, HIDDEN, ATTENTION = 64, 24, 16
STEPS, RATE, DECAY, SEED = 250, 0.02, 1e-4, 20240601

_CLASSES = ("#*$%&|<>", "!?", ".,;:", "'\"()[]{}", "-_/\\=+~^`@")
N_FEATURES = HASHED + len(_CLASSES) + 8


def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Class of each byte, a random number for each byte, and powers for positions in a word."""
    kind = np.zeros(256, "u1")
    for i, characters in enumerate(_CLASSES):
        kind[[ord(c) for c in characters]] = i + 1
    n = len(_CLASSES)
    kind[65:91], kind[97:123], kind[48:58], kind[128:] = n + 1, n + 2, n + 3, n + 4
    random = np.random.default_rng(SEED)
    odd = random.integers(0, 2**63, 1, "u8") * np.uint64(2) + np.uint64(1)
    powers = np.cumprod(np.repeat(odd, 256), dtype="u8")
    return kind, random.integers(1, 2**63, 256, "u8"), powers


_KIND, _NUMBER, _POWER = _tables()
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def passages(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Features of all passages, one row each, and the number of passages of each text (at least one)."""
    blocks, counts, block, size = [], [], [], 0
    for i, text in enumerate(texts):
        block.append((text or "").encode("utf-8", "surrogatepass"))
        size += len(block[-1])
        if size >= BLOCK_BYTES or i + 1 == len(texts):
            features, n = _block(block)
            blocks.append(features)
            counts.append(n)
            block, size = [], 0
    if not blocks:
        return np.zeros((0, N_FEATURES), "f4"), np.zeros(0, "i8")
    return np.concatenate(blocks), np.concatenate(counts)


def _block(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    data = np.frombuffer(b"\n".join(texts) + b"\n", "u1")
    text_ends = np.cumsum([len(t) + 1 for t in texts])
    space = _SPACE[data]
    begins = np.flatnonzero(~space & np.concatenate([[True], space[:-1]]))
    text_of_word = np.searchsorted(text_ends, begins, "right")
    words = np.bincount(text_of_word, minlength=len(texts))
    n = np.maximum(1, -(-words // PASSAGE_WORDS))
    out = np.zeros((int(n.sum()), N_FEATURES), "f4")
    if not len(begins):
        return out, n
    first_passage, first_word = np.cumsum(n) - n, np.cumsum(words) - words
    passage = first_passage[text_of_word] + (np.arange(len(begins)) - first_word[text_of_word]) // PASSAGE_WORDS
    used, opening, n_words = np.unique(passage, return_index=True, return_counts=True)

    # Bytes of words, by class; a word runs to the next white space.
    position = np.flatnonzero(~space)
    word = np.cumsum(~space & np.concatenate([[True], space[:-1]]))[position] - 1
    kinds = np.bincount(passage[word] * 16 + _KIND[data[position]], minlength=len(out) * 16).reshape(-1, 16)
    total = np.maximum(kinds.sum(1), 1)
    inside = position - begins[word]
    hashes = np.add.reduceat(_NUMBER[data[position]] * _POWER[inside & 255], np.searchsorted(position, begins))

    # Repetition: distinct words of a passage, and words like the one before.
    mixed = hashes ^ (passage.astype("u8") * np.uint64(0x9E3779B97F4A7C15))
    order = np.lexsort((mixed, passage))
    fresh = np.concatenate([[True], mixed[order][1:] != mixed[order][:-1]])
    distinct = np.bincount(passage, weights=fresh[np.argsort(order)], minlength=len(out))
    again = np.concatenate([[False], (hashes[1:] == hashes[:-1]) & (passage[1:] == passage[:-1])])
    repeats = np.bincount(passage, weights=again, minlength=len(out))
    count = np.bincount(passage, minlength=len(out))
    at_least = np.maximum(count, 1)
    hashed = np.bincount(passage * HASHED + (hashes >> np.uint64(40)).astype("i8") % HASHED, minlength=len(out) * HASHED)
    lines = np.concatenate([np.cumsum(data == 10)[begins], [(data == 10).sum()]])
    breaks = np.bincount(passage, weights=np.diff(lines) > 0, minlength=len(out))

    share = kinds / total[:, None]
    classes = len(_CLASSES)
    out[:, :HASHED] = hashed.reshape(-1, HASHED) / at_least[:, None]
    out[:, HASHED : HASHED + classes] = 5 * share[:, 1 : classes + 1]
    out[:, HASHED + classes :] = np.column_stack(
        [
            3 * share[:, classes + 1],
            share[:, classes + 2],
            3 * share[:, classes + 3],
            share[:, classes + 4],
            3 * (1 - distinct / at_least) * (count > 0),
            3 * repeats / at_least,
            total / at_least / 10 * (count > 0),
            breaks / at_least,
        ]
    )
    return out, n


@dataclass
class Model:
    """Weights: encoder, gated attention (V, U, w) and the scorer."""

    encode: np.ndarray
    encode_bias: np.ndarray
    v: np.ndarray
    u: np.ndarray
    w: np.ndarray
    score: np.ndarray
    bias: np.ndarray

    def weights(self) -> list[np.ndarray]:
        return [self.encode, self.encode_bias, self.v, self.u, self.w, self.score, self.bias]

    def forward(self, x: np.ndarray, counts: np.ndarray) -> dict[str, np.ndarray]:
        starts, bag = np.cumsum(counts) - counts, np.repeat(np.arange(len(counts)), counts)
        h = np.tanh(x @ self.encode + self.encode_bias)
        t, g = np.tanh(h @ self.v), 1 / (1 + np.exp(-(h @ self.u)))
        raw = (t * g) @ self.w
        e = np.exp(raw - np.maximum.reduceat(raw, starts)[bag])
        a = e / np.add.reduceat(e, starts)[bag]
        z = np.add.reduceat(a[:, None] * h, starts)
        logit = z @ self.score + self.bias[0]
        return {"starts": starts, "bag": bag, "h": h, "t": t, "g": g, "a": a, "z": z, "logit": logit}

    def predict(self, x: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Scores from 0 to 1, in double precision: what else is in a batch changes none beyond rounding errors."""
        if not len(counts):
            return np.zeros(0)
        return 1 / (1 + np.exp(-np.clip(self.forward(x.astype("f8"), counts)["logit"], -50, 50)))


def fit(x: np.ndarray, counts: np.ndarray, labels: np.ndarray) -> Model:
    """Trains by Adam on the mean cross-entropy over all documents; the same input gives the same model.

    Without both labels present there is nothing to tell apart: the model then gives every text the share of
    label 1 (or one half without any document).
    """
    random = np.random.default_rng(SEED)

    def drawn(*shape: int) -> np.ndarray:
        return (random.standard_normal(shape) / np.sqrt(shape[0])).astype("f4")

    model = Model(
        drawn(N_FEATURES, HIDDEN), np.zeros(HIDDEN, "f4"), drawn(HIDDEN, ATTENTION), drawn(HIDDEN, ATTENTION),
        drawn(ATTENTION), drawn(HIDDEN), np.zeros(1, "f4"),
    )
    share = float(labels.mean()) if len(labels) else 0.5
    model.bias[0] = np.log((share + 0.01) / (1.01 - share))
    if len(set(labels.tolist())) < 2:
        model.score[:] = 0
        return model
    weights = model.weights()
    first, second = [np.zeros_like(p) for p in weights], [np.zeros_like(p) for p in weights]
    y = labels.astype("f4")
    for step in range(1, STEPS + 1):
        f = model.forward(x, counts)
        bag, starts, h, a = f["bag"], f["starts"], f["h"], f["a"]
        d_logit = (1 / (1 + np.exp(-f["logit"])) - y) / len(y)
        d_z = d_logit[:, None] * model.score
        d_a = (h * d_z[bag]).sum(1)
        d_raw = a * (d_a - np.add.reduceat(a * d_a, starts)[bag])
        d_gate = d_raw[:, None] * model.w
        d_t, d_g = d_gate * f["g"] * (1 - f["t"] ** 2), d_gate * f["t"] * f["g"] * (1 - f["g"])
        d_h = (a[:, None] * d_z[bag] + d_t @ model.v.T + d_g @ model.u.T) * (1 - h**2)
        gradients = [
            x.T @ d_h, d_h.sum(0), h.T @ d_t, h.T @ d_g, (f["t"] * f["g"]).T @ d_raw, f["z"].T @ d_logit, d_logit.sum()[None],
        ]
        for p, g, m, v in zip(weights, gradients, first, second, strict=True):
            g = g + DECAY * p
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            p -= (RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)).astype("f4")
    return model


def held_out(doc_id: Column) -> Column:
    """Whether crc32 of the id as text leaves 2 when divided by 4: such rows are never learned from. Null ids are
    held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(True))


def training_texts(
    docs: DataFrame, labels: DataFrame, limit: int = TRAIN_DOCS, passages: int = TRAIN_PASSAGES
) -> DataFrame:
    """``_id``, ``_label`` and ``text`` of the sample to learn from: labelled rows that are not held out, one for each
    id and text, in the order of the id's md5, at most ``limit`` of them with ``passages`` passages together.

    Repeated rows count once, map-side, however many they are. Choosing moves ids and sizes only; texts are shuffled for
    the chosen rows alone.
    """
    known = labels.where(F.col("quality").isNotNull() & ~held_out(F.col("doc_id")))
    known = known.groupBy("doc_id").agg(F.min("quality").cast("long").alias("_label"))
    order = [F.md5(F.col("_id").cast("string")), F.col("_id")]
    known = known.withColumnRenamed("doc_id", "_id").orderBy(*order).limit(limit)
    keyed = docs.select("doc_id", "text").join(F.broadcast(known), F.col("doc_id") == F.col("_id"))
    keyed = keyed.select("_id", "_label", "text", text_key(F.col("text")).alias("_key"))
    words = F.regexp_count(F.coalesce("text", F.lit("")), F.lit(WORD_PATTERN))
    n = F.greatest(F.lit(1), F.ceil(words / PASSAGE_WORDS)).cast("long")
    sizes = keyed.groupBy("_id", "_key").agg(F.max(n).alias("_n")).where(F.col("_n") * 10 <= passages)
    # At most ``limit`` rows, so one window over them is small.
    upto = F.sum("_n").over(Window.orderBy(*order, "_key").rowsBetween(Window.unboundedPreceding, 0))
    chosen = sizes.orderBy(*order, "_key").limit(limit).withColumn("_upto", upto).where(F.col("_upto") <= passages)
    texts = keyed.join(F.broadcast(chosen.select("_id", "_key")), ["_id", "_key"])
    return texts.dropDuplicates(["_id", "_key"]).select("_id", "_label", "text")


def train(docs: DataFrame, labels: DataFrame, limit: int = TRAIN_DOCS, passages_limit: int = TRAIN_PASSAGES) -> Model:
    """A model fitted on ``training_texts``, at most ``limit`` of them with ``passages_limit`` passages together.

    Rows that label a document both ways count as label 0, null labels not at all. Passages are encoded on the
    executors; the features of the bounded sample come to the driver, of whole documents.
    """

    def run(batches):
        for batch in batches:
            for i, text, label in zip(batch["_id"], batch["text"], batch["_label"], strict=True):
                x, _ = passages([text])
                yield pd.DataFrame({"id": [str(i)], "label": [label], "n": [len(x)], "x": [x.tobytes()]})

    got = training_texts(docs, labels, limit, passages_limit).mapInPandas(run, "id string, label long, n long, x binary")
    rows = sorted(got.collect(), key=lambda r: (r["id"], r["label"], r["x"]))
    x = np.frombuffer(b"".join(r["x"] for r in rows), "f4").reshape(-1, N_FEATURES)
    return fit(x, np.array([r["n"] for r in rows], "i8"), np.array([r["label"] for r in rows]))


def score_documents(docs: DataFrame, model: Model) -> DataFrame:
    """One row per row of ``docs``: ``doc`` (the input row as a struct), ``held_out``, ``score`` (0 to 1, higher:
    label 1 likelier) and ``predicted`` (1 from ``GOOD`` on).

    The score depends on the whole text and nothing else. Null and empty texts are one passage without words.
    Repeated rows and null ids are scored like others. Input columns are kept inside ``doc``. An empty table gives an
    empty result. Nothing is shuffled.
    """

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            # A few documents at a time keep the passages of a batch of long texts in bounds.
            parts = [model.predict(*passages(texts.iloc[i : i + 256].tolist())) for i in range(0, len(texts), 256)]
            yield pd.Series(np.concatenate(parts) if parts else [], dtype="float64")

    scored = docs.select(F.struct("*").alias("doc")).withColumn("score", score(F.col("doc.text")))
    return scored.select(
        "doc",
        held_out(F.col("doc.doc_id")).alias("held_out"),
        "score",
        F.when(F.col("score") >= GOOD, 1).otherwise(0).alias("predicted"),
    )


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``score_documents`` with a model trained on ``labels`` (doc_id, quality) of ``docs``."""
    return score_documents(docs, train(docs, labels))
