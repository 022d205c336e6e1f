"""Adaptive execution splits the rows of a dominant key at the joins that meet them."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from clickline.operators import attribute, funnel
from clickline.operators.sessionize import sessionize
from helpers import executed_plan, rows

SETTINGS = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
}


@pytest.fixture(autouse=True)
def small_thresholds(spark):
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    yield
    for key in SETTINGS:
        spark.conf.unset(key)


def ran(df):
    df.collect()
    return executed_plan(df)


def numbered(spark, count):
    """Two thirds of the rows belong to one user, the rest to many; eight input partitions."""
    user = F.when(F.col("id") % 3 > 0, "hot").otherwise((F.col("id") % 3000).cast("string"))
    return spark.range(0, count, 1, 8).select(user.alias("user_id"), "id")


def hot_events(spark):
    return numbered(spark, 60000).select(
        "user_id",
        F.timestamp_seconds(F.lit(1704067200) + F.col("id") % 60).alias("timestamp"),
        F.lit("view").alias("event_type"),
        (F.col("id") % 7).alias("product_id"),
        F.lit("mobile").alias("device"),
        F.sha2(F.col("id").cast("string"), 256).alias("referrer"),
    )


def test_busy_user_and_busy_second_are_split(spark):
    """The hot user has two thirds of the rows, all in one minute or all equal; no task gets twice its share."""
    one_row = hot_events(spark).withColumns(
        {"timestamp": F.timestamp_seconds(F.lit(1704067200)), "referrer": F.lit("email"), "product_id": F.lit(1).cast("long")}
    )
    for frame in (hot_events(spark), one_row):
        got = sessionize(frame)
        sizes = [r["count"] for r in got.groupBy(F.spark_partition_id()).count().collect()]
        assert sum(sizes) == 60000 and max(sizes) < 2 * 60000 / 8
        assert got.where("session_id != concat(user_id, '_1')").count() == 0


def test_busy_order_second_is_split(spark):
    placed = numbered(spark, 60000).select(
        F.col("id").alias("order_id"),
        "user_id",
        F.timestamp_seconds(F.lit(1704067200)).alias("timestamp"),
        F.rand(1).alias("total_amount"),
    )
    seen = spark.createDataFrame(
        [("hot", "email", "hot_1"), ("3", "social", "3_1")], "user_id string, marketing_channel string, session_id string"
    ).select("user_id", F.timestamp_seconds(F.lit(1704067100)).alias("event_time"), "marketing_channel", "session_id")
    got = attribute.last_touch(placed, seen)
    assert "SortMergeJoin(skew=true)" in ran(got)
    assert rows(got.groupBy("marketing_channel").count()) == [("direct", 19980), ("email", 40000), ("social", 20)]
    counted = attribute.lookback_counts(placed, seen)
    assert "SortMergeJoin(skew=true)" in ran(counted)
    assert rows(counted.groupBy("eligible_touches").count()) == [(0, 19980), (1, 40020)]


def test_busy_product_is_split(spark):
    catalog = spark.range(0, 3000).select(
        F.col("id").alias("product_id"), F.lit("toys").alias("category"), F.lit("b").alias("brand"), F.lit(1.0).alias("price")
    )
    events = hot_events(spark).withColumn(
        "product_id", F.when(F.col("user_id") == "hot", 1).otherwise(F.col("product_id") + 5000)
    )
    got = funnel.enrich(events, catalog)
    assert "SortMergeJoin(skew=true)" in ran(got)
    assert rows(got.groupBy("category").count()) == [(None, 20000), ("toys", 40000)]
