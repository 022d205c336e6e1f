"""Cleaning of the raw event, order and product tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickline.functions.columns import parse_time_or_iso, tidy

# Time formats of the raw files.
EVENT_TIME_FORMAT = "dd-MM-yyyy HH:mm"
ORDER_TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"


def clean_events(raw: DataFrame, drop_unparsed: bool = False) -> DataFrame:
    """Rows with a user, a time text and a product, renamed and normalised.

    A time text that does not parse stays as a null time unless ``drop_unparsed`` is set.
    """
    events = raw.dropna(subset=["customer_id", "timestamp", "product_id"]).select(
        F.col("customer_id").alias("user_id"),
        parse_time_or_iso("timestamp", EVENT_TIME_FORMAT).alias("timestamp"),
        tidy("event_type").alias("event_type"),
        F.col("product_id"),
        tidy("device_type").alias("device"),
        tidy("traffic_source").alias("referrer"),
    )
    return events.dropna(subset=["timestamp"]) if drop_unparsed else events


def clean_orders(raw: DataFrame) -> DataFrame:
    """Orders with id, user and a valid time; repeated rows and odd amounts are kept."""
    orders = raw.select(
        F.col("transaction_id").alias("order_id"),
        F.col("customer_id").alias("user_id"),
        parse_time_or_iso("timestamp", ORDER_TIME_FORMAT).alias("timestamp"),
        F.col("gross_revenue").alias("total_amount"),
    )
    return orders.dropna(subset=["order_id", "user_id", "timestamp"])


def rejects(
    events: DataFrame, orders: DataFrame, products: DataFrame, lost_amounts: tuple[int, int, int] | list[int] = (0, 0, 0)
) -> DataFrame:
    """One row per raw table: its rows, those that cleaning drops, those with a time text that does not parse, and those with an
    amount that is no number, as counted where the text was read."""
    lost_amount = dict(zip(("events", "orders", "products"), lost_amounts, strict=True))

    def counts(raw: DataFrame, name: str, keys: list[str], time_format: str | None, times_are_needed: bool) -> DataFrame:
        no_key, lost = F.lit(False), F.lit(False)
        for key in keys:
            no_key = no_key | F.col(key).isNull()
        if time_format:
            lost = F.col("timestamp").isNotNull() & parse_time_or_iso("timestamp", time_format).isNull()
            no_key = no_key | F.col("timestamp").isNull()
        return raw.agg(
            F.lit(name).alias("source"),
            F.count(F.lit(1)).alias("row_count"),
            F.count_if((no_key | lost) if times_are_needed else no_key).alias("dropped"),
            F.count_if(lost).alias("unparsed_times"),
            F.lit(lost_amount[name]).cast("long").alias("unparsed_amounts"),
        )

    return (
        counts(events, "events", ["customer_id", "product_id"], EVENT_TIME_FORMAT, False)
        .unionByName(counts(orders, "orders", ["transaction_id", "customer_id"], ORDER_TIME_FORMAT, True))
        .unionByName(counts(products, "products", ["product_id"], None, False))
    )


def clean_catalog(raw: DataFrame) -> DataFrame:
    """One row per product: the smallest (category, brand, price), nulls first.

    The survivor is picked by an aggregate, so copies of a product collapse map-side.
    """
    products = raw.dropna(subset=["product_id"]).select(
        "product_id",
        F.struct(
            tidy("category").alias("category"),
            F.col("brand"),
            F.col("base_price").alias("price"),
        ).alias("kept"),
    )
    return products.groupBy("product_id").agg(F.min("kept").alias("kept")).select("product_id", "kept.*")
