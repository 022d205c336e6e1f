"""From documents to token ids: filter, classify, deduplicate, mix, encode.

Each stage takes (spark, docs, sf_dir) and works on all rows of the stage before; all but the last return
the columns of documents.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from clickline.llm import bpe, classifier, jaccard, mixing, rules
from clickline.llm.queries import coded_digests, table
from clickline.llm.shared import stored

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return rules.kept_documents(docs, table(spark, sf_dir, "labels"))


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The model is trained on the whole table: the rules may have left no document of label 0 to learn from."""
    model = classifier.train(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    scored = classifier.score_documents(docs, model)
    return scored.where("predicted = 1").select("doc.*")


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard.one_of_each(docs)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A document that the mix takes more than once is there as often."""
    return mixing.mixed_documents(docs)


def byte_level_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return coded_digests(bpe.encode_and_decode(docs), "ids")


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_rules),
    ("quality_classifier", quality_classifier),
    ("ngram_jaccard_join", ngram_jaccard_join),
    ("source_mixing", source_mixing),
    ("byte_level_bpe", byte_level_bpe),
]

#: Hashed n-gram ratios, a trained model and MinHash have no counterpart in SQL; tests compare each stage by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is stored before the next stage reads it."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
