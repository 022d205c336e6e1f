"""Lookups of one user on stored tables: the scan skips what cannot hold the user."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from clickline.operators import report
from clickline.operators.sessionize import sessionize
from clickline.sources import files, schemas, testtables
from main import main
from tests.helpers import executed_plan, rows


def rows_scanned(df) -> int:
    """Rows that the scan of a plan without a shuffle handed on, after skipping row groups and pages."""
    df.collect()
    leaf = df._jdf.queryExecution().executedPlan().collectLeaves().head()
    return leaf.metrics().get("numOutputRows").get().value()


@pytest.fixture
def many(spark):
    """A third of the rows are of one user; some have none."""
    user = F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 101 == 0, None).otherwise(F.concat(F.lit("u"), F.col("id") % 997))
    return spark.range(60_000).select(user.alias("user_id"), F.timestamp_seconds(F.lit(1_700_000_000) + F.col("id")).alias("timestamp"), "id")


def test_a_lookup_reads_little_of_a_sorted_table(spark, many, tmp_path):
    path = str(tmp_path / "t")
    files.write_lookup_table(many, path, "user_id", "timestamp", files=12)
    stored = files.read_table(spark, path)
    assert rows(stored) == rows(many)
    for user in ("u5", "u996", "u", "zzz", ""):
        mine = stored.where(F.col("user_id") == user)
        assert f"EqualTo(user_id,{user})" in executed_plan(mine)
        assert rows_scanned(mine) <= 60_000 / 10
        assert rows(mine) == rows(many.where(F.col("user_id") == user))
    per_file = stored.groupBy(F.input_file_name()).count().toPandas()["count"]
    # The dominant user is spread over files like any other rows.
    assert len(per_file) == 12 and per_file.max() < 2 * per_file.mean()


def test_session_tables_skip_files_without_the_user(spark, many, tmp_path):
    typed = ["event_type", "device", "referrer"]
    events = many.select("user_id", "timestamp", F.col("id").alias("product_id"), *[F.lit("x").alias(c) for c in typed])
    sessions = sessionize(events)
    path = tmp_path / "output" / "events_with_sessions"
    files.write_grouped_for_lookup(sessions, str(path), "user_id")
    stored = files.read_table(spark, str(path))
    mine = stored.where(F.col("user_id") == "u5")
    assert rows_scanned(mine) <= stored.count() / 4
    assert rows(mine.drop("session_id")) == rows(events.where("user_id = 'u5'"), *mine.drop("session_id").columns)
    assert rows_scanned(stored.where(F.col("user_id") == "u-none")) == 0


def test_the_timeline_command_prints_one_user(spark, sf_dir, tmp_path, capfd):
    sessions = sessionize(testtables.events(spark, sf_dir))
    path = str(tmp_path / "output" / "events_with_sessions")
    files.write_grouped_for_lookup(sessions.select(*schemas.EVENTS_WITH_SESSIONS.names), path, "user_id")
    main(["timeline", str(tmp_path), "7", "--rows", "3"], spark)
    assert "7_1" in capfd.readouterr().out


def test_the_stored_number_is_what_the_scan_compares(spark, sf_dir):
    mine = testtables.events(spark, sf_dir, "7")
    assert "EqualTo(user_id,7)" in executed_plan(mine)
    assert rows(mine) == rows(report.user_timeline(testtables.events(spark, sf_dir), "7"))
    for nobody in ("07", "x", "", "7 ", "-0", "9" * 30):
        assert testtables.events(spark, sf_dir, nobody).count() == 0
