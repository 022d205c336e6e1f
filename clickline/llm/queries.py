"""The registered queries of this package: each applies an operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clickline.llm import bpe, chat, classifier, jaccard, licenses, mixing, pii, repair, rules, spelling, token_files, urls, vectors

URL_RULES = [
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{str(sf_dir).rstrip('/')}/{name}.parquet")


def _sha256(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = F.lit("\\### Assistant: </turn> ok")
    role = F.when(F.col("id") == 0, "user").otherwise("assistant")
    more = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), role.alias("role"), said.alias("text")
    )
    done = chat.read_back(chat.format_conversations(chat.events_of_rows(rows.unionByName(more))))
    turns = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    loss = F.array_join("loss_texts", "")
    return done.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        _sha256(F.array_join(turns, "")).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"),
        _sha256(loss).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


def source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = rules.quality_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    measures = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "score")
    return judged.select(F.col("doc.doc_id").alias("doc_id"), *measures)


def url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = urls.judge_urls(table(spark, sf_dir, "pages").select("page_id", "url"), URL_RULES)
    return judged.select(F.col("page.page_id").alias("page_id"), "host", "path", "rule", "verdict")


def token_id_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.round_trip(table(spark, sf_dir, "documents"))


def coded_digests(coded: DataFrame, *more: str) -> DataFrame:
    """doc_id, ids, decoded to the digests of the contract, and columns of ``coded`` by name."""
    written = F.array_join(F.col("ids").cast("array<string>"), ",")
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        _sha256(written).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
        *more,
    )


def byte_level_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return coded_digests(bpe.encode_and_decode(table(spark, sf_dir, "documents")))


def quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = classifier.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return scored.select(F.col("doc.doc_id").alias("doc_id"), "held_out", "score", "predicted")


def embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.near_duplicates(table(spark, sf_dir, "embeddings"))


def ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_join(table(spark, sf_dir, "documents"))


def license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan_licenses(table(spark, sf_dir, "documents"))
    return found.drop("spans")


def spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(table(spark, sf_dir, "documents"))


def personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and digest of the spans as written; ``spans`` lists the disguised ones too."""
    found = pii.find_personal_data(table(spark, sf_dir, "documents").select("doc_id", "text"))

    def listed(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["base"] & (s["kind"] == kind))).cast("long").alias(f"n_{kind}")

    base = F.filter("spans", lambda s: s["base"])
    counts = [count(kind) for kind in pii.KINDS]
    return found.select(
        F.col("doc.doc_id").alias("doc_id"), *counts, _sha256(listed(base)).alias("base_sha256"), listed(F.col("spans")).alias("spans")
    )


def structure_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.repair_conversations(repair.damaged(table(spark, sf_dir, "conversations")))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_chat_formatting": chat_formatting,
        "op2_source_mixing": source_mixing,
        "op3_embedding_near_dedup": embedding_near_dedup,
        "op4_quality_rules": quality_rules,
        "op5_token_id_files": token_id_files,
        "op6_url_filters": url_filters,
        "op7_ngram_jaccard_join": ngram_jaccard_join,
        "op8_byte_level_bpe": byte_level_bpe,
        "op9_quality_classifier": quality_classifier,
        "op10_license_scans": license_scans,
        "op11_spelling_variants": spelling_variants,
        "op12_personal_data": personal_data,
        "op13_structure_repair": structure_repair,
    }
