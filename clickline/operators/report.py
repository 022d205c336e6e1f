"""Small tables behind reports and dashboards."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickline.operators.funnel import TOTALS, with_rates


def summary(metrics: DataFrame) -> DataFrame:
    """One row of totals and rates; zeros for an empty funnel."""
    totals = metrics.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in TOTALS])
    return with_rates(totals)


def funnel_steps(metrics: DataFrame) -> DataFrame:
    """The totals as three rows (step, count)."""
    named = summary(metrics).select(
        F.col("total_views").alias("Views"),
        F.col("total_carts").alias("Carts"),
        F.col("total_purchases").alias("Purchases"),
    )
    return named.unpivot([], ["Views", "Carts", "Purchases"], "step", "count")


def top_anomalies(flagged: DataFrame, limit: int = 50, by: str = "z") -> DataFrame:
    """The ``limit`` rows with the largest z-score; ``by="abs"`` ranks drops alongside spikes."""
    z = F.col("z_score")
    order = [
        (F.abs(z) if by == "abs" else z).desc_nulls_last(),
        F.col("date").asc(),
        F.col("category").asc(),
        F.col("device").asc(),
        F.col("referrer").asc(),
    ]
    return flagged.orderBy(*order).limit(limit)


def anomaly_export(flagged: DataFrame, limit: int = 50, by: str = "z") -> DataFrame:
    """Top anomalies with every null replaced by the value the dashboard expects."""

    def text(column: str, default: str) -> Column:
        return F.coalesce(F.col(column).cast("string"), F.lit(default)).alias(column)

    def number(column: str) -> Column:
        return F.coalesce(F.col(column), F.lit(0.0))

    return top_anomalies(flagged, limit, by).select(
        text("date", ""),
        text("category", "Unknown"),
        text("device", "Unknown"),
        text("referrer", "Unknown"),
        number("overall_conversion_rate").alias("overall_conversion_rate"),
        number("rolling_avg_conversion").alias("rolling_avg_conversion"),
        F.round(number("z_score"), 4).alias("z_score"),
        text("anomaly_flag", "unknown"),
    )


def zscore_series(export: DataFrame) -> DataFrame:
    """(date, value) of the exported anomalies for the z-score chart, oldest first."""
    return (
        export.select("date", F.col("z_score").alias("value"))
        .where((F.col("date") != "") & F.col("value").isNotNull() & ~F.isnan("value"))
        .orderBy("date", "value")
    )


def user_timeline(events: DataFrame, user_id: str) -> DataFrame:
    """One user's events in time order; their number is its row count."""
    mine = events.where(F.col("user_id") == user_id)
    rest = [c for c in events.columns if c != "timestamp"]
    return mine.orderBy("timestamp", *rest)


def peek(df: DataFrame, order: list, rows: int) -> DataFrame:
    """The first ``rows`` rows in ``order``; the remaining columns settle ties."""
    return df.orderBy(*order, *[F.col(c).asc() for c in df.columns]).limit(rows)
