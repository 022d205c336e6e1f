"""Mixing sources to target weights by weighted fair queueing.

Documents of a source queue in a shuffled order that their ids fix. A document's virtual finish time is the
source's words up to and with it, divided by the source's weight. All queues are merged by that time and cut
where the merged words reach the budget, so each source advances in step with its weight. A source that has
run through its documents starts again, up to ``MAX_PASSES`` times; then it has no more to give and the others
go on, which hands its unused share to them by weight. A document that would end beyond its source's target gives
way to later ones that fit.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickline.llm.shared import ROWS_PER_SLICE, WORD_PATTERN, running_total, stored, text_key

#: How often one document may be taken.
MAX_PASSES = 3
#: Changes the shuffled order.
SEED = "mix-1"


def _shuffle_key() -> Column:
    return F.md5(F.concat(F.lit(f"{SEED}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))


def source_targets(sizes: DataFrame, weight_cycle: int = 3) -> DataFrame:
    """One row per source: ``rank`` (0 up by code point, null last), ``weight`` (1, 2, .. ``weight_cycle``,
    repeating), ``source_size``, ``n_docs``, ``budget`` (all words) and ``target``.

    Targets share the budget by weight; what lies above ``MAX_PASSES`` times a source's size goes to the others
    by weight until none is above. Sources in the order of size per weight fill up first, so one pass over
    the sources (not over documents) finds the level.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n_docs"))
    every = Window.orderBy(F.col("source").asc_nulls_last())
    ranked = per.withColumn("rank", F.row_number().over(every) - 1).withColumn(
        "weight", (F.col("rank") % weight_cycle + 1).cast("long")
    )
    whole = Window.partitionBy()
    fill = Window.orderBy(F.col("source_size") / F.col("weight"), "rank")
    upto, after = (
        fill.rowsBetween(Window.unboundedPreceding, -1),
        fill.rowsBetween(Window.currentRow, Window.unboundedFollowing),
    )
    full = F.col("source_size") * MAX_PASSES
    levels = (
        ranked.withColumn("budget", F.sum("source_size").over(whole))
        .withColumn("_left", F.col("budget") - F.coalesce(F.sum(full).over(upto), F.lit(0)))
        .withColumn("_weights", F.sum("weight").over(after))
        .withColumn("_fits", full * F.col("_weights") <= F.col("_left") * F.col("weight"))
    )
    # Sources that fill up come first in this order; the first that does not sets the level for all after it.
    first = F.min(F.when(~F.col("_fits"), F.struct(F.col("source_size") / F.col("weight"), "rank", "_left", "_weights")))
    level = first.over(whole)
    share = (F.col("weight") * level["_left"]).cast("double") / level["_weights"].cast("double")
    target = F.when(F.col("_fits") | level.isNull(), full.cast("double")).otherwise(share)
    return levels.withColumn("target", target).select(
        "source", "rank", "weight", "source_size", "n_docs", "budget", "target"
    )


def document_sizes(docs: DataFrame) -> DataFrame:
    """doc_id, source, text_key, size (words of the whole text) and the shuffle key, stored: texts are read once."""
    return stored(
        docs.select(
            "doc_id",
            "source",
            text_key(F.col("text")).alias("text_key"),
            F.regexp_count(F.coalesce("text", F.lit("")), F.lit(WORD_PATTERN)).cast("long").alias("size"),
            _shuffle_key().alias("key"),
        ),
        "sizes",
    )


def _expected_places(sources: DataFrame) -> DataFrame:
    """One row: ``classes``, an array of (``until``, ``places``). A source's places are spread evenly from 0 to the time
    of its last one, so sources are gathered by that time on a scale of steps of a quarter of a power of two,
    which gives a few hundred classes at most, whatever the number of sources."""
    last = F.col("source_size") * MAX_PASSES / F.col("weight")
    step = F.ceil(F.log2(last) * 4)
    per = sources.where("source_size > 0").groupBy(step.alias("step")).agg(F.sum("n_docs").alias("n"))
    one = F.struct(F.pow(F.lit(2.0), F.col("step") / 4).alias("until"), (F.col("n") * MAX_PASSES).cast("double").alias("places"))
    return per.agg(F.sort_array(F.collect_list(one)).alias("classes"))


def _merged_slice(finish: Column, classes: Column) -> Column:
    """Slices of about ``ROWS_PER_SLICE`` places each: the number of places expected up to ``finish``, divided."""
    before = F.aggregate(
        classes, F.lit(0.0), lambda sum_, c: sum_ + c["places"] * F.least(finish / c["until"], F.lit(1.0))
    )
    return F.floor(before / ROWS_PER_SLICE).cast("long")


def mix(docs: DataFrame, weight_cycle: int = 3) -> DataFrame:
    """One row per row of ``docs``: doc_id, source, text_key, size, source_size, target, passes (0 to
    ``MAX_PASSES``), taken (size times passes).

    The same table gives the same mix. Null texts have size 0 and are taken as often as their place in the queue
    says, at no cost; without any word in the table nothing is taken. Null sources form one source, the last. Ties of the shuffle key (repeated ids) are ordered
    by text and size; among rows equal in all of these each takes its own place in the queue. Sources without a
    word have target 0. An empty table gives an empty result. Other columns are ignored.
    """
    sizes = document_sizes(docs)
    sources = stored(source_targets(sizes, weight_cycle), "sources")
    # Null sources get a rank like all others, so that later joins are on numbers.
    rows = sizes.join(sources.withColumnRenamed("source", "_source"), F.col("source").eqNullSafe(F.col("_source"))).drop("_source")

    # Slices of the shuffled order: equal ranges of the key's first 32 bits, which are uniform.
    first_bits = F.conv(F.substring("key", 1, 8), 16, 10).cast("long")
    slices = F.floor(F.col("n_docs") / ROWS_PER_SLICE) + 1
    rows = rows.withColumn("slice", F.floor(first_bits * slices / F.lit(2**32)).cast("long"))
    queue = running_total(rows, "size", "words", within="rank", slice_by="slice", order_by=["key", "doc_id", "text_key", "size"])
    queue = stored(queue.drop("slice"), "queue")

    # The merged queue: up to MAX_PASSES places for each document, each with its virtual finish time.
    numbers = F.array(*[F.lit(i).cast("long") for i in range(MAX_PASSES)])
    finish = (F.col("pass") * F.col("source_size") + F.col("words")) / F.col("weight")
    places = queue.select("rank", "weight", "source_size", "budget", "key", "words", "size", "n_docs", F.explode(numbers).alias("pass"))
    places = places.select(finish.alias("finish"), "rank", "pass", "words", "key", "size", "budget")
    # Places without words move no total, however many stand at one time.
    places = places.where(F.col("size") > 0)
    profile = stored(_expected_places(sources), "profile")
    places = places.withColumn("classes", profile.select("classes").scalar())
    places = places.withColumn("slice", _merged_slice(F.col("finish"), F.col("classes"))).drop("classes")
    order = ["finish", "rank", "pass", "words", "key"]
    merged = running_total(places, "size", "total", slice_by="slice", order_by=order)
    last = stored(
        merged.where(F.col("total") <= F.col("budget")).agg(F.max(F.struct("finish", "rank", "pass", "words", "key")).alias("cut")),
        "cut",
    )
    cut = last.select("cut").scalar()

    def within_budget(i: int) -> Column:
        at = F.lit(i).cast("long")
        end = at * F.col("source_size") + F.col("words")
        when = (at * F.col("source_size") + F.col("words")) / F.col("weight")
        place = F.struct(when.alias("finish"), F.col("rank"), at.alias("pass"), F.col("words"), F.col("key"))
        return F.when((place <= F.col("_cut")) & (end <= F.col("target")), F.lit(1)).otherwise(F.lit(0))

    passes = sum((within_budget(i) for i in range(1, MAX_PASSES)), within_budget(0))
    taken = queue.withColumn("_cut", cut).withColumn("passes", passes).drop("_cut")
    return _filled(stored(taken, "taken"), slices).select(
        "doc_id", "source", "text_key", "size", "source_size", "target", "passes", (F.col("size") * F.col("passes")).alias("taken")
    )


def _filled(taken: DataFrame, slices: Column) -> DataFrame:
    """Evens out the cut: a queue stops up to one document short of its share, which may be a very long one.

    Later documents of the same queue, each at most an eighth of what is missing, are taken once more in queue
    order as long as their sum fits, which leaves at most an eighth where the queue has enough of them.
    """
    got = taken.groupBy("rank").agg(F.sum(F.col("size") * F.col("passes")).alias("_got"))
    missing = taken.join(got, "rank").withColumn("_missing", F.col("target") - F.col("_got"))
    # The first pass that is not taken yet comes first; positions of one pass are in the queue's order.
    fits = (F.col("size") > 0) & (F.col("passes") < MAX_PASSES) & (F.col("size") * 8 <= F.col("_missing"))
    first_bits = F.conv(F.substring("key", 1, 8), 16, 10).cast("long")
    in_pass = F.floor(first_bits * slices / F.lit(2**32)).cast("long")
    missing = missing.withColumns(
        {"_size": F.when(fits, F.col("size")).otherwise(F.lit(0)), "slice": F.col("passes") * slices + in_pass}
    )
    summed = running_total(
        missing, "_size", "_sum", within="rank", slice_by="slice", order_by=["key", "doc_id", "text_key", "size", "words"]
    )
    more = (F.col("_size") > 0) & (F.col("_sum") <= F.col("_missing"))
    return summed.withColumn("passes", F.col("passes") + F.when(more, F.lit(1)).otherwise(F.lit(0)))


def mixed_documents(docs: DataFrame, weight_cycle: int = 3) -> DataFrame:
    """The rows of ``docs`` as the mix takes them: each as often as its passes say, none with no pass.

    Rows with the same id, source and text hold the same words, so which of them gets which place in the queue does
    not matter: what the mix takes of them is dealt evenly over them, in the order of their other columns. Texts are
    shuffled once, to the thin table of what is taken. Only rows that share id, source and text are looked at again;
    those equal in all columns are counted map-side first, however many they are.
    """
    same = ["doc_id", "source", "text_key"]
    # A struct compares null fields as equal, and the rows stay partitioned by it.
    taken = mix(docs, weight_cycle).groupBy(F.struct(*same).alias("_key"))
    taken = taken.agg(F.count("*").alias("_rows"), F.sum("passes").alias("_times")).where("_times > 0")
    taken = stored(taken, "taken-keys")
    packed = docs.select(F.struct("*").alias("doc"), "doc_id", "source", text_key(F.col("text")).alias("text_key"))
    # One plan at every size: the thin table grows with the documents, so it is never broadcast.
    found = packed.select("doc", F.struct(*same).alias("_key")).join(taken.hint("merge"), "_key")
    lone = found.where("_rows = 1").select("doc", "_times")
    repeated = found.where("_rows > 1").groupBy("_key", "doc", "_rows", "_times").agg(F.count("*").alias("_n"))
    upto = F.sum("_n").over(Window.partitionBy("_key").orderBy("doc").rowsBetween(Window.unboundedPreceding, 0))

    def dealt(places: Column) -> Column:
        """What the first ``places`` of a key's rows get together."""
        return F.call_function("div", F.col("_times") * places, F.col("_rows"))

    repeated = repeated.withColumn("_upto", upto)
    repeated = repeated.select("doc", (dealt(F.col("_upto")) - dealt(F.col("_upto") - F.col("_n"))).alias("_times"))
    rows = lone.unionByName(repeated).where("_times > 0")
    return rows.select("doc", F.explode(F.sequence(F.lit(1).cast("long"), "_times"))).select("doc.*")
