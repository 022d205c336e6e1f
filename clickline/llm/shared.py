"""What several operators share: stored intermediate tables, running totals, connected components."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: What the contracts call a word, and the characters between words.
WORD_GAP = " \t\n\x0b\f\r"
WORD_GAPS_PATTERN = r"[\x20\x09-\x0D]+"
WORD_PATTERN = r"[^\x20\x09-\x0D]+"
#: Rows that one step of a running total puts in order at once.
ROWS_PER_SLICE = 65_536


def scratch_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share; one of our own only where none is set, as in local tests."""
    context = spark.sparkContext
    folder = context.getConf().get("spark.checkpoint.dir") or context.getCheckpointDir()
    if not folder:
        context.setCheckpointDir(tempfile.mkdtemp(prefix="clickline-"))
        folder = context.getCheckpointDir()
    return folder.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{scratch_dir(spark)}/clickline-{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read again: later steps neither recompute it nor
    depend on the executors that made it."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def words(text: Column) -> Column:
    """The words of a text as an array; null and blank texts have none."""
    trimmed = F.btrim(text, F.lit(WORD_GAP))
    none = F.array().cast("array<string>")
    return F.when(F.length(F.coalesce(trimmed, F.lit(""))) == 0, none).otherwise(
        F.split(trimmed, WORD_GAPS_PATTERN)
    )


def text_key(text: Column) -> Column:
    """64 bits that tell rows with one id apart by their text; null counts as a text of its own."""
    return F.xxhash64(F.coalesce(text, F.lit("\x00null")))


def running_total(
    df: DataFrame, value: str, out: str, *, slice_by: str, order_by: list[str | Column], within: str | None = None
) -> DataFrame:
    """Adds ``out``, the inclusive running sum of ``value`` in the order (``slice_by``, ``order_by``), in each
    ``within`` or over all rows.

    No task ever orders a whole group: slices are summed first, their totals run over one row per slice, and
    only the rows inside a slice are sorted. ``slice_by`` is an integer that rises with the order.
    """
    keys = [*([within] if within else []), slice_by]
    totals = df.groupBy(*keys).agg(F.sum(value).alias("_slice_total"))
    over_slices = (Window.partitionBy(within) if within else Window).orderBy(slice_by)
    before = F.sum("_slice_total").over(over_slices.rowsBetween(Window.unboundedPreceding, -1))
    offsets = totals.select(*keys, F.coalesce(before, F.lit(0)).alias("_before"))
    in_slice = Window.partitionBy(*keys).orderBy(*order_by).rowsBetween(Window.unboundedPreceding, 0)
    return (
        df.join(offsets, keys)
        .withColumn(out, F.col("_before") + F.sum(value).over(in_slice))
        .drop("_before")
    )


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node in ``edges`` (a, b: long): component is the smallest node reachable.

    Large-star and small-star steps: each round links every node to the smallest one it knows, until the edges
    are stars around the smallest nodes. A node with many edges is only ever grouped by a minimum, which
    combines before the shuffle, or joined to one row. Each round is stored; only two numbers reach the driver.
    """
    links = stored(
        edges.where(F.col("a") != F.col("b"))
        .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .distinct(),
        "links",
    )
    state = None
    while True:
        now = links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == state or not now[0]:
            break
        state = now
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        lowest = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("m", "u").alias("m"))
        large = both.where("v > u").join(lowest, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.distinct()
        lowest = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(lowest, "u")
        small = joined.where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        links = stored(small.unionByName(lowest.select("u", F.col("m").alias("v"))).distinct(), "links")
    roots = links.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return links.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
