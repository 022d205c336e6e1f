"""The registered queries: SQL, determinism of the pipeline, and its stages against what they promise."""

from __future__ import annotations

import random
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry_module
import corpus_pipeline
from clickline.llm import queries, sql

SQL = sql.oracle_sql(queries.URL_RULES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, sf_dir, name):
    database = duckdb.connect()
    for path in Path(sf_dir).glob("*.parquet"):
        database.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    df = queries.queries()[name](spark, sf_dir)
    result = database.execute(SQL[name])
    columns = sorted(c[0] for c in result.description)
    order = [[c[0] for c in result.description].index(c) for c in columns]
    want = sorted((tuple(r[i] for i in order) for r in result.fetchall()), key=str)
    assert sorted(df.columns) == columns
    assert sorted((tuple(r) for r in df.select(columns).collect()), key=str) == want


def test_all_are_registered():
    assert set(queries.queries()) | {"pipeline"} <= set(entry_module.queries())
    assert set(SQL) <= set(entry_module.oracle_sql())


def test_pipeline(spark, sf_dir):
    first = docs = queries.table(spark, sf_dir, "documents")
    counts = []
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, sf_dir).cache()
        assert docs.columns == first.columns
        counts.append(docs.count())
    assert first.count() > counts[0] >= counts[1] >= counts[2] > 0
    assert docs.select("doc_id", "text").subtract(first.select("doc_id", "text")).count() == 0
    done = corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir)
    assert done.count() == docs.count()
    labels = queries.table(spark, sf_dir, "labels")
    assert docs.join(labels.where("quality = 0"), "doc_id", "left_semi").count() == 0


def test_pipeline_classifier_learns_from_documents_the_rules_reject(spark, tmp_path):
    """Bad documents have a word on each line. The rules see no lines: they reject the labelled ones as too short only."""
    draw = random.Random(12)
    vocabulary = ["".join(draw.choice("abcdefgh") for _ in range(draw.randrange(2, 8))) for _ in range(300)]
    text = lambda gap, n: gap.join(draw.choice(vocabulary) for _ in range(n))
    good, short, slipped = range(300), range(300, 400), range(1000, 1005)
    rows = [(i, text(" ", 200)) for i in good] + [(i, text("\n", 40)) for i in short] + [(i, text("\n", 200)) for i in slipped]
    docs = [(i, t, "en", "s", len(t)) for i, t in rows]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(docs, schema).write.parquet(str(tmp_path / "documents.parquet"))
    labels = [(i, 1, 0) for i in good] + [(i, 0, 0) for i in short]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    ids = lambda docs: {r["doc_id"] for r in docs.select("doc_id").collect()}
    kept = corpus_pipeline.quality_rules(spark, queries.table(spark, tmp_path, "documents"), str(tmp_path)).cache()
    assert ids(kept) == {*good, *slipped}
    assert ids(corpus_pipeline.quality_classifier(spark, kept, str(tmp_path))) == set(good)
