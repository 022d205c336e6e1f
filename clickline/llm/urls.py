"""URL filters: rules in a sorted array of 64-bit digests, memory-mapped by the tasks that probe it.

A rule is a host and the start of a path, written together ("example.org/es/"). It fits its host and every
subdomain of it. Each URL probes all endings of its host with all path starts that are as long as some rule's
path. The keys are xxhash digests, found by binary search; what is found is then compared as full strings, so
two strings with one digest do no harm.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Rule text that is shipped to every executor at most; longer lists are joined instead.
MAX_INDEX_BYTES = 64 * 2**20
VERDICT_WITHOUT_RULE = "allow"
RULES_SCHEMA = "host string, path string, verdict string"
_FOUND = T.StructType().add("rule", T.StringType()).add("verdict", T.StringType())
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    """After the first "://" up to "/", "?", "#" or the end, A-Z in lower case; empty without "://"."""
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(host, _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    """From the host's end up to "?", "#" or the end; empty without "://"."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def write_index(rules: pd.DataFrame) -> str:
    """Writes sorted digests, string offsets, strings, verdicts and path lengths to one file for memory mapping.

    Layout, little-endian 64-bit numbers: count of rules, count of path lengths, total bytes of strings; then
    digests, offsets (one more than rules), host lengths, verdict flags (1 blocks), path lengths; then strings.
    """
    keys = [(host + path).encode() for host, path in zip(rules["host"], rules["path"], strict=True)]
    digests = np.array([_digest(len(h.encode()), k) for h, k in zip(rules["host"], keys, strict=True)], "<u8")
    order = np.argsort(digests, kind="stable")
    strings = [keys[i] for i in order]
    hosts = np.array([len(rules["host"].iloc[i].encode()) for i in order], "<u8")
    offsets = np.concatenate([[0], np.cumsum([len(s) for s in strings])]).astype("<u8")
    blocks = np.array([rules["verdict"].iloc[i] == "block" for i in order], "<u8")
    lengths = np.array(sorted({len(p) for p in rules["path"]}), "<u8")
    path = os.path.join(tempfile.mkdtemp(prefix="clickline-urls-"), f"rules-{uuid.uuid4().hex}.bin")
    with open(path, "wb") as f:
        np.array([len(strings), len(lengths), int(offsets[-1])], "<u8").tofile(f)
        for block in (digests[order], offsets, hosts, blocks, lengths):
            block.astype("<u8").tofile(f)
        f.write(b"".join(strings))
    return path


def _digest(host_bytes: int, key: bytes) -> int:
    """Host and path stay apart in the digest's seed: "a.b/c" with host "a.b" is not host "a.b/c"."""
    return xxhash.xxh64_intdigest(key, seed=host_bytes)


class RuleIndex:
    """A memory-mapped index file and the vectorised probe of it."""

    def __init__(self, path: str) -> None:
        numbers = np.memmap(path, "<u8", "r", shape=((os.path.getsize(path)) // 8,))
        n, k, _ = (int(x) for x in numbers[:3])
        ends = np.cumsum([3, n, n + 1, n, n, k])
        self.digests, self.offsets, self.hosts, self.blocks, lengths = (
            numbers[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True)
        )
        self.path_lengths = [int(x) for x in lengths]
        self.longest_host = int(self.hosts.max()) if n else 0
        self.strings = np.memmap(path, "u1", "r", offset=int(ends[-1]) * 8) if self.offsets[-1] else b""

    def string(self, i: int) -> bytes:
        return bytes(self.strings[int(self.offsets[i]) : int(self.offsets[i + 1])])

    def probe(self, hosts: pd.Series, paths: pd.Series) -> pd.DataFrame:
        """The longest rule that fits each URL, and its verdict."""
        rows, keys, host_bytes = [], [], []
        for row, (host, path) in enumerate(zip(hosts, paths, strict=True)):
            if not host:
                continue
            starts = [path[:length].encode() for length in self.path_lengths if length <= len(path)]
            # Endings longer than every rule's host fit none, so a long host costs no more than a long rule.
            at = 0
            if len(host) > self.longest_host:
                at = host.find(".", len(host) - self.longest_host - 1) + 1 or -1
            while at >= 0:
                ending = host[at:].encode()
                for start in starts:
                    rows.append(row)
                    keys.append(ending + start)
                    host_bytes.append(len(ending))
                at = host.find(".", at) + 1 or -1
        best: dict[int, tuple[int, int, int]] = {}
        if keys and len(self.digests):
            wanted = np.array([_digest(h, k) for h, k in zip(host_bytes, keys, strict=True)], "<u8")
            first = np.searchsorted(self.digests, wanted, "left")
            last = np.searchsorted(self.digests, wanted, "right")
            for j in np.flatnonzero(first < last):
                for i in range(int(first[j]), int(last[j])):
                    if int(self.hosts[i]) == host_bytes[j] and self.string(i) == keys[j]:
                        # Longest in characters; of equally long rules the one with the longer host, then "block".
                        text = keys[j].decode()
                        rank = (len(text), host_bytes[j], int(self.blocks[i]), text)
                        best[rows[j]] = max(best.get(rows[j], rank), rank)
        found = [best.get(row) for row in range(len(hosts))]
        return pd.DataFrame(
            {
                "rule": [f[3] if f else None for f in found],
                "verdict": [("block" if f[2] else "allow") if f else None for f in found],
            }
        )


def _rules_frame(spark: SparkSession, rules: DataFrame | list[tuple[str, str, str]]) -> DataFrame:
    """Rules without nulls and repeats; a host and path ruled both ways is blocked. A verdict other than "block" allows."""
    df = rules if isinstance(rules, DataFrame) else spark.createDataFrame(rules, RULES_SCHEMA)
    whole = df.where("host is not null and path is not null and verdict is not null")
    blocks = F.max(F.col("verdict") == "block")
    return whole.groupBy("host", "path").agg(F.when(blocks, "block").otherwise("allow").alias("verdict"))


def judge_urls(
    pages: DataFrame,
    rules: DataFrame | list[tuple[str, str, str]],
    *,
    url: str = "url",
    max_index_bytes: int = MAX_INDEX_BYTES,
) -> DataFrame:
    """One row per row of ``pages``: ``page`` (the input row as a struct), ``host``, ``path``, ``rule``, ``verdict``.

    ``rules`` holds (host, path start, "allow" or "block"). The longest fitting rule decides; without one,
    ``rule`` is null and the verdict "allow". Null URLs and those without "://" have an empty host and path, which no
    rule fits. Repeated rows are judged alike; repeated rules count once, a rule given both ways blocks, and one with another
    verdict than "block" allows. An
    empty table of pages or of rules gives that many or only "allow" rows. Input columns are kept inside ``page``.

    The rule list's size is measured first. Up to ``max_index_bytes`` it becomes one index file, which Spark
    copies to every executor, a new one after a loss included. A longer list stays distributed: the probes of the
    distinct hosts and paths meet the rules in a join on the digest, with the same result.
    """
    spark = pages.sparkSession
    rules = _rules_frame(spark, rules)
    packed = pages.select(F.struct("*").alias("page"), F.col(url).alias("_url"))
    packed = packed.select("page", host_of(F.col("_url")).alias("host"), path_of(F.col("_url")).alias("path"))
    size = rules.agg(F.sum(F.octet_length("host") + F.octet_length("path") + F.lit(32))).first()[0] or 0
    if size > max_index_bytes:
        return _judge_by_join(packed, rules)
    path = write_index(rules.toPandas())
    spark.sparkContext.addFile(path)
    name = os.path.basename(path)

    @F.pandas_udf(_FOUND)
    def find(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        index = RuleIndex(SparkFiles.get(name))
        for hosts, paths in batches:
            yield index.probe(hosts, paths)

    return _with_verdict(packed.withColumn("_found", find("host", "path")))


def _judge_by_join(packed: DataFrame, rules: DataFrame) -> DataFrame:
    """The same verdicts for lists too long to ship: distinct hosts and paths probe the rules in one join."""
    keyed = rules.select(
        F.xxhash64("host", "path").alias("_digest"),
        F.col("host").alias("_rule_host"),
        F.col("path").alias("_rule_path"),
        F.col("verdict").alias("_rule_verdict"),
    )
    longest = rules.agg(F.max(F.length("host")), F.max(F.length("path"))).first()
    host_length, path_length = (F.lit(n or 0) for n in longest)
    # Endings and starts longer than every rule's fit none: of a longer host, what follows the first dot of its tail.
    tail = F.split(F.substring(F.col("host"), -(host_length + 1), host_length + 1), r"\.")
    labels = F.when(F.length("host") > host_length, F.slice(tail, F.lit(2), F.size(tail))).otherwise(F.split("host", r"\."))
    places = F.when(F.size(labels) > 0, F.sequence(F.lit(1), F.size(labels))).otherwise(F.array().cast("array<int>"))
    endings = F.transform(places, lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    lengths = F.sequence(F.lit(0), F.least(F.length("path"), path_length))
    starts = F.transform(lengths, lambda n: F.substring(F.col("path"), F.lit(1), n))
    distinct = packed.select("host", "path").where("host != ''").distinct()
    probes = distinct.select("host", "path", F.explode(endings).alias("_ending")).select(
        "host", "path", "_ending", F.explode(starts).alias("_start")
    )
    met = probes.withColumn("_digest", F.xxhash64("_ending", "_start")).join(keyed, "_digest")
    met = met.where((F.col("_ending") == F.col("_rule_host")) & (F.col("_start") == F.col("_rule_path")))
    text = F.concat("_ending", "_start")
    rank = F.struct(
        F.length(text).alias("length"),
        F.octet_length("_ending").alias("host_bytes"),
        F.col("_rule_verdict").alias("verdict"),
        text.alias("rule"),
    )
    best = met.groupBy("host", "path").agg(F.max(rank).alias("_found"))
    return _with_verdict(packed.join(best, ["host", "path"], "left"))


def _with_verdict(df: DataFrame) -> DataFrame:
    verdict = F.coalesce(F.col("_found.verdict"), F.lit(VERDICT_WITHOUT_RULE))
    return df.select("page", "host", "path", F.col("_found.rule").alias("rule"), verdict.alias("verdict"))
