"""Token ids in ORC: stripes with run-length encoded integers, row indexes, and Bloom filters on document ids.

Files are sorted by document id and cover separate ranges of it, so a lookup of one id prunes by file, stripe
and row-group statistics and then by the Bloom filters, and stripes are read in parallel.
"""

from __future__ import annotations

import json
import zlib
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickline.llm.bpe import id_lists
from clickline.llm.pieces import Remembered, by_blocks, for_worker
from clickline.llm.shared import running_total, scratch_path, stored, text_key

#: Appended to each document.
END_ID = 0
#: Text that one file's task takes, about.
BYTES_PER_FILE = 64 * 2**20
ORC_OPTIONS = {
    "compression": "zstd",
    "orc.bloom.filter.columns": "doc_id",
    "orc.bloom.filter.fpp": "0.01",
    "orc.create.index": "true",
    "orc.row.index.stride": "10000",
    "orc.stripe.size": str(64 * 2**20),
}


def _byte_characters() -> dict[int, str]:
    """The printable character by which a byte-level vocabulary writes each byte: itself if it has a visible form in
    Latin-1, else the next free one from 256 up."""
    visible = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    hidden = [b for b in range(256) if b not in visible]
    return {b: chr(b) for b in visible} | {b: chr(256 + i) for i, b in enumerate(hidden)}


class TextEncoder:
    """Whole texts to ids by a tokenizers file. Its added tokens are found inside texts, as the library does by
    default; with ``special_as_text`` the special ones are ordinary text.

    A plain byte-level BPE file (no normalizer, the public pattern) is applied stretch by stretch, each distinct one
    once; any other file, and any text that holds an added token, is left to the library as a whole.
    """

    def __init__(self, path: str, special_as_text: bool = False) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = special_as_text
        added = self.tokenizer.get_added_tokens_decoder().values()
        self.added = [t.content for t in added if not (special_as_text and t.special)]
        with open(path, encoding="utf-8") as file:
            form = json.load(file)
        before, model = form.get("pre_tokenizer") or {}, form["model"]
        self.plain = (
            form.get("normalizer") is None
            and before.get("type") == "ByteLevel"
            and not before.get("add_prefix_space")
            and before.get("use_regex", True)
            and model["type"] == "BPE"
            and not model.get("ignore_merges")
        )
        self.characters = _byte_characters()
        self.remembered = Remembered(self._tokenize_new, 1)

    def _tokenize_new(self, words: list[str]) -> list[tuple[bytes]]:
        tokenize, characters = self.tokenizer.model.tokenize, self.characters
        written = [w.encode().decode("latin-1").translate(characters) for w in words]
        return [(array("i", [token.id for token in tokenize(w)]).tobytes(),) for w in written]

    def encode(self, texts: pa.Array) -> pa.LargeBinaryArray:
        """Little-endian 32-bit ids of each text; there are no null texts."""
        whole = np.full(len(texts), not self.plain)
        for token in self.added:
            whole |= pc.match_substring(texts, token).to_numpy(zero_copy_only=False)
        if not whole.any():
            return self.remembered.encode(texts)[0]
        by_library = self.tokenizer.encode_batch(texts.filter(pa.array(whole)).to_pylist(), add_special_tokens=False)
        others = self.remembered.encode(texts.filter(pa.array(~whole)))[0]
        coded = pa.array([np.array(x.ids, "<i4").tobytes() for x in by_library], pa.large_binary())
        # Row i is the next one of its kind.
        places = np.where(whole, len(others) + np.cumsum(whole), np.cumsum(~whole)) - 1
        return pa.concat_arrays([others, coded]).take(pa.array(places))


def write_token_files(
    docs: DataFrame,
    path: str,
    tokenizer: str | None = None,
    files: int | None = None,
    special_as_text: bool = True,
) -> None:
    """Encodes ``docs`` (doc_id, text) and writes ORC files to ``path``: doc_id, ids, part, row.

    ``part`` numbers the files and ``row`` the rows in each, in ascending order of doc_id (nulls first; rows that
    share an id by a hash of their text, so that they too spread over files). Null and empty texts hold only the
    end id. Long texts are encoded whole. Repeated rows are all written. Other columns are ignored; an empty table
    writes a folder with no rows. ``files`` defaults to one for each ``BYTES_PER_FILE`` of text. ``special_as_text``
    writes special tokens that stand in a text as ordinary text; without it they are found there, as the library does by
    default.
    """
    tokenizer = tokenizer or public_tokenizers.path("byte_bpe_50k.json")
    spark = docs.sparkSession
    if files is None:
        size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
        files = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // BYTES_PER_FILE))
    ordered = (
        docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), text_key(F.col("text")).alias("key"))
        .repartitionByRange(files, F.col("doc_id").asc_nulls_first(), "key")
        .sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "key")
        .select("doc_id", "text", F.spark_partition_id().cast("long").alias("part"))
    )

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = f"tokenizer {tokenizer} {special_as_text}"
        encoder = for_worker(key, lambda: TextEncoder(tokenizer, special_as_text))
        row, end = 0, pa.scalar(np.array([END_ID], "<i4").tobytes(), pa.large_binary())
        for batch in by_blocks(batches):
            ids = id_lists(pc.binary_join_element_wise(encoder.encode(batch.column(1)), end, pa.scalar(b"", pa.large_binary())))
            rows = pa.array(np.arange(row, row + len(ids)))
            row += len(ids)
            columns = [batch.column(0), ids, batch.column(2), rows]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "ids", "part", "row"])

    schema = T.StructType(
        [
            T.StructField("doc_id", docs.schema["doc_id"].dataType),
            T.StructField("ids", T.ArrayType(T.IntegerType())),
            T.StructField("part", T.LongType()),
            T.StructField("row", T.LongType()),
        ]
    )
    ordered.mapInArrow(run, schema).write.options(**ORC_OPTIONS).orc(path)


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, ids, part, row of the files; filters on doc_id prune files, stripes and row groups."""
    return spark.read.orc(path)


def token_index(files: DataFrame) -> DataFrame:
    """Per document, from ``read_token_files``: doc_id, ``start`` (ids of all documents before it), ``n_tokens`` and
    ``ids_crc32`` of its ids as little-endian unsigned 32-bit integers, end id included."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(1)
            data = memoryview(ids.values.to_numpy().astype("<i4").tobytes())
            ends = ids.offsets.to_numpy() * 4
            sums = [zlib.crc32(data[a:b]) for a, b in zip(ends[:-1], ends[1:], strict=True)]
            counts = pa.array((ends[1:] - ends[:-1]) // 4, pa.int64())
            columns = [batch.column(0), batch.column(2), batch.column(3), counts, pa.array(sums, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "part", "row", "n_tokens", "ids_crc32"])

    kind = files.schema["doc_id"].dataType.simpleString()
    sums = files.select("doc_id", "ids", "part", "row").mapInArrow(
        run, f"doc_id {kind}, part long, row long, n_tokens long, ids_crc32 long"
    )
    # Stored, so that the files are read once: the totals of the parts come before the sums in them.
    placed = running_total(stored(sums, "token-sums"), "n_tokens", "_stop", slice_by="part", order_by=["row"])
    return placed.select("doc_id", (F.col("_stop") - F.col("n_tokens")).alias("start"), "n_tokens", "ids_crc32")


def round_trip(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """``token_index`` of files written to the shared folder and read back; ids are the library's by default, so added
    tokens inside texts are found."""
    path = scratch_path(docs.sparkSession, "tokens")
    write_token_files(docs, path, tokenizer, special_as_text=False)
    return token_index(read_token_files(docs.sparkSession, path))
