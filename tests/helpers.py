"""Short ways to write small frames and read results back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def events(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    """Rows (user, time text or None[, event_type, product_id, device, referrer])."""
    defaults = (None, None, "view", 1, "mobile", "email")
    full = [tuple(row) + defaults[len(row):] for row in rows]
    return spark.createDataFrame(
        full, "user_id string, timestamp string, event_type string, product_id bigint, device string, referrer string"
    ).withColumn("timestamp", F.col("timestamp").cast("timestamp"))


def orders(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    """Rows (order_id, user, time text, amount)."""
    return spark.createDataFrame(
        rows, "order_id bigint, user_id string, timestamp string, total_amount double"
    ).withColumn("timestamp", F.col("timestamp").cast("timestamp"))


def touches(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    """Rows (user, time text, channel, session)."""
    return spark.createDataFrame(
        rows, "user_id string, event_time string, marketing_channel string, session_id string"
    ).withColumn("event_time", F.col("event_time").cast("timestamp"))


def daily(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    """Rows (date text, category, rate)."""
    return spark.createDataFrame(
        rows, "date string, category string, daily_conversion_rate double"
    ).withColumn("date", F.col("date").cast("date"))


def rows(df: DataFrame, *columns: str) -> list[tuple]:
    """All rows as tuples, nulls first."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=lambda t: tuple((v is not None, str(v)) for v in t))


def executed_plan(df: DataFrame) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
