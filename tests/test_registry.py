"""Every registered query against its SQL on the smallest tables."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry_module

# The training-data queries have tests of their own beside their operators.
QUERIES = {k: v for k, v in entry_module.queries().items() if k.startswith("q_")}
SQL = {k: v for k, v in entry_module.oracle_sql().items() if k.startswith("q_")}
# Sizes measured independently on sf0.001.
EXPECTED_ROWS = {
    "q_funnel_rates": 708,
    "q_daily_category": 208,
    "q_anomaly_pct": 165,
    "q_anomaly_zscore": 0,
    "q_sessionize": 1000,
}


@pytest.fixture(scope="module")
def database(sf_dir):
    connection = duckdb.connect()
    for path in Path(sf_dir).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


def normal(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def value(v):
        return None if isinstance(v, float) and math.isnan(v) else v

    return sorted((tuple(value(row[i]) for i in order) for row in data), key=lambda t: [(v is None, str(v)) for v in t])


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_sql(spark, sf_dir, database, name):
    df = QUERIES[name](spark, sf_dir)
    result = database.execute(SQL[name])
    columns = [c[0] for c in result.description]
    assert sorted(df.columns) == sorted(columns)
    data = df.collect()
    assert normal(df.columns, data) == normal(columns, result.fetchall())
    if name in EXPECTED_ROWS:
        assert len(data) == EXPECTED_ROWS[name]


def test_session_counts(spark, sf_dir):
    assert QUERIES["q_sessionize"](spark, sf_dir).select("session_id").distinct().count() == 946
    assert QUERIES["q_sessionize_daygap"](spark, sf_dir).select("session_id").distinct().count() == 111


def test_entry(spark):
    assert entry_module.entry(spark).count() > 0


def test_building_a_query_runs_no_job(spark, sf_dir):
    spark.sparkContext.setJobGroup("build only", "")
    try:
        for query in QUERIES.values():
            query(spark, sf_dir)
        assert list(spark.sparkContext.statusTracker().getJobIdsForGroup("build only")) == []
    finally:
        spark.sparkContext.setJobGroup("tests", "")
