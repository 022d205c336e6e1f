"""View, cart and purchase funnels at session grain.

The counts are numbers of (session, category, device, referrer, date) groups that hold at
least one such event, not numbers of events; a session over two categories or two days
counts in each.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickline.functions.columns import share

DIMENSIONS = ["category", "device", "referrer", "date"]
TOTALS = ["total_views", "total_carts", "total_purchases"]


def enrich(events: DataFrame, catalog: DataFrame) -> DataFrame:
    """Events with category, brand and price; events of unknown products keep nulls.

    No broadcast hint: Spark broadcasts a catalog below its size threshold, from the file
    sizes or from the measured shuffle, and sort-merges a larger one.
    """
    return events.join(catalog, "product_id", "left")


def with_date(events: DataFrame) -> DataFrame:
    return events.withColumn("date", F.to_date("timestamp"))


def session_flags(enriched: DataFrame) -> DataFrame:
    """0/1 flags per session and dimension; groups without a funnel event stay as zeros.

    A session has one user. Grouping by the user as well changes no group, and lets events that
    sessionizing has already brought together by user be grouped without another shuffle.
    """

    def seen(event_type: str) -> Column:
        return F.max(F.when(F.col("event_type") == event_type, 1).otherwise(0))

    return (
        with_date(enriched)
        .groupBy("user_id", "session_id", *DIMENSIONS)
        .agg(
            seen("view").alias("has_view"),
            seen("add_to_cart").alias("has_cart"),
            seen("purchase").alias("has_purchase"),
        )
        .drop("user_id")
    )


def funnel_counts(flags: DataFrame) -> DataFrame:
    """Sessions that viewed, carted and purchased per dimension."""
    return flags.groupBy(*DIMENSIONS).agg(
        F.sum("has_view").alias("total_views"),
        F.sum("has_cart").alias("total_carts"),
        F.sum("has_purchase").alias("total_purchases"),
    )


def with_rates(counts: DataFrame) -> DataFrame:
    """Counts plus the three step rates, 4 decimals, 0.0 where the base is zero."""
    return counts.withColumns(
        {
            "view_to_cart_rate": share("total_carts", "total_views"),
            "cart_to_purchase_rate": share("total_purchases", "total_carts"),
            "overall_conversion_rate": share("total_purchases", "total_views"),
        }
    )


def funnel_metrics(sessions: DataFrame, catalog: DataFrame) -> DataFrame:
    """Sessionized events to the daily funnel table."""
    return with_rates(funnel_counts(session_flags(enrich(sessions, catalog))))


def missing_category(sessions: DataFrame, catalog: DataFrame) -> DataFrame:
    """Events whose product has no category, or the literal category ``none``."""
    unknown = F.col("category").isNull() | (F.col("category") == "none")
    return enrich(sessions, catalog).where(unknown).select(
        "user_id", "session_id", "event_type", "product_id", "category"
    )


def category_totals(metrics: DataFrame) -> DataFrame:
    """Funnel totals per category, most viewed first."""
    return (
        metrics.groupBy("category")
        .agg(*[F.sum(c).alias(c) for c in TOTALS])
        .orderBy(F.col("total_views").desc(), F.col("category").asc())
    )


def category_timeline(metrics: DataFrame, category: str | None = None) -> DataFrame:
    """Daily views, purchases and unrounded conversion rate of one category, or of each."""
    chosen = metrics if category is None else metrics.where(F.col("category") == category)
    daily = chosen.groupBy("category", "date").agg(
        F.sum("total_views").alias("views"),
        F.sum("total_purchases").alias("purchases"),
    )
    return daily.withColumn("conversion_rate", share("purchases", "views", digits=None))
