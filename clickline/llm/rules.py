"""Quality rules: base limits, then a hashed n-gram log-likelihood ratio.

Two multinomials over hashed n-grams are counted, one on trusted documents and one on the whole corpus. A
document's score is the mean log ratio of the two over its n-grams; a document below the threshold is rejected.
The outcome depends on the tables alone: no draws are made.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickline.llm.shared import WORD_GAP, stored, words

#: Characters that count as symbols.
SYMBOLS = "#*$%&|<>"
#: A piece is a run of letters and digits or a run of other characters: "the&&&" shows its "&&&".
PIECE_PATTERN = r"[\p{L}\p{N}]++|[^\s\p{L}\p{N}]++"
#: Buckets of either multinomial; the ratio table holds so many doubles and no more.
N_BUCKETS = 10_000
#: Longs of the filter that keeps other documents from the join with the trusted ids: 1 MiB.
FILTER_WORDS = 2**17
#: Added to every bucket's count.
SMOOTHING = 1.0
#: Documents whose mean log ratio per n-gram is below this are rejected.
THRESHOLD = -0.3


def _upto(n: Column) -> Column:
    """0 .. n - 1 as an array, empty when n is 0 or less."""
    return F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))


def with_repeated_words(df: DataFrame, array: str, out: str) -> DataFrame:
    """Adds ``out``: how many words of ``array`` stand in a three-word window found twice or more in it.

    Each window becomes one long, hash bits above position bits. Sorting brings equal windows together, where
    their words are compared; the positions found are sorted again and the words under them counted. Time
    grows as n log n in a text's words, however much repeats.
    """
    n, w, at, bits = F.size(array), F.col(array), F.col("_sorted"), F.col("_bits")

    def position(j: Column) -> Column:
        return F.get(at, j).bitwiseAND(F.col("_mask")).cast("int")

    def same(j: Column, k: Column) -> Column:
        def shared_prefix() -> Column:
            return F.call_function("shiftright", F.get(at, j), bits) == F.call_function("shiftright", F.get(at, k), bits)

        def word(i: Column, step: int) -> Column:
            return F.get(w, position(i) + step)

        equal = shared_prefix()
        for step in range(3):
            equal = equal & (word(j, step) == word(k, step))
        return F.coalesce(equal, F.lit(False))

    def window(i: Column) -> Column:
        hashed = F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2))
        return F.call_function("shiftleft", hashed, bits).bitwiseOR(i.cast("long"))

    places = F.col("_places")
    step = lambda total, k: total + F.least(F.lit(3), F.coalesce(F.get(places, k + 1) - F.get(places, k), F.lit(3)))
    return (
        df.withColumn("_bits", F.ceil(F.log2(n + F.lit(2.0))).cast("int"))
        .withColumn("_mask", F.call_function("shiftleft", F.lit(1).cast("long"), bits) - 1)
        .withColumn("_sorted", F.sort_array(F.transform(_upto(n - 2), window)))
        .withColumn("_hits", F.filter(_upto(F.size("_sorted")), lambda j: same(j, j - 1) | same(j, j + 1)))
        .withColumn("_places", F.sort_array(F.transform("_hits", position)))
        .withColumn(out, F.aggregate(_upto(F.size("_places")), F.lit(0), step).cast("long"))
        .drop("_bits", "_mask", "_sorted", "_hits", "_places")
    )


def _buckets(text: Column) -> Column:
    """The buckets of a text's pieces and of its pairs of neighbouring pieces."""
    pieces = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(PIECE_PATTERN), F.lit(0))

    def bucket(*parts: Column) -> Column:
        return F.pmod(F.xxhash64(*parts), F.lit(N_BUCKETS)).cast("int")

    def grams(p: Column) -> Column:
        singles = F.transform(p, lambda x: bucket(x))
        pairs = F.transform(_upto(F.size(p) - 1), lambda i: bucket(F.get(p, i), F.get(p, i + 1)))
        return F.concat(singles, pairs)

    # The one-element transform names the pieces, so that they are extracted once.
    return F.flatten(F.transform(F.array(pieces), grams))


def trusted_ids(labels: DataFrame) -> DataFrame:
    """The ids of all documents labelled good and never labelled bad."""
    known = labels.where("doc_id is not null").groupBy("doc_id").agg(F.min("quality").alias("q"))
    return known.where("q = 1").select("doc_id")


def _counted(docs: DataFrame, name: str) -> DataFrame:
    """(bucket, count): how often the n-grams of ``docs`` fall into each bucket."""
    return docs.select(F.explode(_buckets(F.col("text"))).alias("bucket")).groupBy("bucket").agg(F.count("*").alias(name))


def _mark(doc_id: Column) -> Column:
    return F.pmod(F.xxhash64(doc_id.cast("string")), F.lit(64 * FILTER_WORDS))


def id_filter(ids: DataFrame) -> DataFrame:
    """One row with ``marks``, a bit per hash of an id in longs of fixed number."""
    mark = _mark(F.col("doc_id"))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(mark, F.lit(64)).cast("int"))
    words = ids.select(F.floor(mark / 64).cast("int").alias("word"), bit.alias("bit"))
    words = words.groupBy("word").agg(F.bit_or("bit").alias("bits"))
    every = ids.sparkSession.range(FILTER_WORDS).select(F.col("id").cast("int").alias("word"))
    filled = every.join(words, "word", "left").select("word", F.coalesce("bits", F.lit(0)).alias("bits"))
    listed = F.sort_array(F.collect_list(F.struct("word", "bits")))
    return filled.agg(listed.alias("listed")).select(F.transform("listed", lambda x: x["bits"]).alias("marks"))


def _may_hold(marks: Column, doc_id: Column) -> Column:
    mark = _mark(doc_id)
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(mark, F.lit(64)).cast("int"))
    return F.get(marks, F.floor(mark / 64).cast("int")).bitwiseAND(bit) != 0


def ratio_table(docs: DataFrame, trusted: DataFrame) -> DataFrame:
    """One row with ``ratios``: log p(trusted) - log p(corpus) per bucket, for all buckets in order.

    The corpus counts cover every n-gram of every document, the others every one of the documents in ``trusted`` (ids).
    """
    # The corpus is counted where it is read. Only texts that a filter of fixed size lets through meet the trusted ids, which
    # settle who is trusted; so the plan is the same at every size.
    marks = stored(id_filter(trusted), "trusted")
    ids = trusted.select(F.col("doc_id").alias("_id"))
    marked = docs.select("doc_id", "text").where(_may_hold(marks.select("marks").scalar(), F.col("doc_id")))
    meets = F.col("doc_id").cast("string") == F.col("_id").cast("string")
    counts = (
        _counted(docs, "n")
        .join(_counted(marked.join(ids.hint("merge"), meets, "left_semi"), "t"), "bucket", "left")
        .select("bucket", "n", F.coalesce("t", F.lit(0)).alias("t"))
    )
    every = docs.sparkSession.range(N_BUCKETS).select(F.col("id").cast("int").alias("bucket"))
    table = every.join(counts, "bucket", "left").select(
        "bucket", F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("t", F.lit(0)).alias("t")
    )
    rows = F.sort_array(F.collect_list(F.struct("bucket", "n", "t")))
    total = table.agg(rows.alias("rows"), F.sum("n").alias("all_n"), F.sum("t").alias("all_t"))

    def ratio(x: Column) -> Column:
        def share(count: Column, whole: Column) -> Column:
            return (count + F.lit(SMOOTHING)) / (whole + F.lit(SMOOTHING * N_BUCKETS))

        return F.log(share(x["t"], F.col("all_t"))) - F.log(share(x["n"], F.col("all_n")))

    # Without a trusted document nothing tells the two apart.
    ratios = F.transform("rows", lambda x: F.when(F.col("all_t") > 0, ratio(x)).otherwise(F.lit(0.0)))
    return total.select(ratios.alias("ratios"))


def quality_rules(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row per row of ``docs``: ``doc`` (the input row as a struct), ``n_words``, ``word_chars``,
    ``n_symbols``, ``n_dup_lines``, ``n_repeat_words``, ``base_failed``, ``score``, ``kept``.

    ``labels`` (doc_id, quality) names the trusted documents. Null and empty texts have no words and fail the
    base limits; their score is 0. Repeated rows are judged one by one and alike. Null ids are judged like
    others and never trusted. Without labels every score is 0, so only the base limits decide. Columns of the
    input keep their names inside ``doc`` and so clash with nothing. An empty table gives an empty result.
    """
    model = stored(ratio_table(docs, trusted_ids(labels)), "ratios")
    text = F.coalesce(F.col("doc.text"), F.lit(""))
    ratios = F.col("_ratios")
    df = docs.select(F.struct("*").alias("doc")).withColumns({"_words": words(text), **base_measures(text)})
    df = df.withColumn("n_words", F.size("_words").cast("long"))
    df = with_repeated_words(df, "_words", "n_repeat_words").drop("_words")
    df = df.withColumn("_buckets", _buckets(text)).withColumn("_ratios", model.select("ratios").scalar())
    total = F.aggregate("_buckets", F.lit(0.0), lambda s, b: s + F.get(ratios, b))
    mean = F.when(F.size("_buckets") > 0, total / F.size("_buckets")).otherwise(F.lit(0.0))
    failed = (F.col("n_words") < 50) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 50)
    return (
        df.withColumn("score", mean)
        .withColumn("base_failed", failed)
        .withColumn("kept", ~F.col("base_failed") & (F.col("score") >= F.lit(threshold)))
        .drop("_buckets", "_ratios")
    )


def base_measures(text: Column) -> dict[str, Column]:
    """The base measures that need no order of words; ``text`` is not null."""
    lines = F.filter(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(WORD_GAP)) != "")
    return {
        "word_chars": F.length(F.translate(text, WORD_GAP, "")).cast("long"),
        "n_symbols": (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long"),
        "n_dup_lines": (F.size(lines) - F.size(F.array_distinct(lines))).cast("long"),
    }


def kept_documents(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that ``quality_rules`` keeps, with their own columns."""
    judged = quality_rules(docs, labels, threshold)
    # A row number keeps the optimizer from moving the filter below the measures, which would write each measure out
    # in full wherever the filter refers to it.
    once = F.col("kept") & (F.monotonically_increasing_id() >= 0)
    return judged.withColumn("_kept", once).where("_kept").select("doc.*")
