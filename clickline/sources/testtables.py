"""Views that give the shared test tables the shape of the logical inputs.

Every view maps whole tables row by row. Times are read in UTC; callers pin
``spark.sql.session.timeZone`` to it.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clickline.operators.clean import EVENT_TIME_FORMAT, ORDER_TIME_FORMAT


# Stored types of the tables used here.
_SCHEMAS = {
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
}


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(_SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def _pick(number: str, *values: str | None) -> Column:
    """The n-th of ``values``, by ``number`` modulo their count."""
    return F.element_at(F.array(*[F.lit(v) for v in values]), (F.pmod(F.col(number), F.lit(len(values))) + 1).cast("int"))


def _blank_every(column: Column, number: str, step: int, value: str | None = None) -> Column:
    """``column``, with ``value`` (null by default) in every ``step``-th row."""
    return F.when(F.pmod(F.col(number), F.lit(step)) == 0, F.lit(value)).otherwise(column)


def _event_type() -> Column:
    return F.when(F.col("event_type") == "click", "add_to_cart").otherwise(F.col("event_type"))


def _product_id() -> Column:
    return F.get_json_object("props", "$.k").cast("bigint")


def _order_time() -> Column:
    return F.timestamp_seconds(
        F.lit(1704067200) + F.pmod(F.col("o_orderkey") * F.lit(7919), F.lit(2592000))
    )


def _catalog_id() -> Column:
    # Ids 90 to 99 stay free, so that events of these products find no catalog row.
    return F.when(F.col("p_partkey") >= 90, F.col("p_partkey") + 10).otherwise(F.col("p_partkey"))


def events(spark: SparkSession, sf_dir: str, user_id: str | None = None) -> DataFrame:
    """Clean events: sub-second times, no nulls but in the referrer. With ``user_id`` only that user's, picked by the
    number that is stored, which the scan can compare; a text that is no such number is nobody's."""
    stored = _table(spark, sf_dir, "events")
    if user_id is not None:
        number = int(user_id) if re.fullmatch(r"0|-?[1-9][0-9]{0,17}", user_id) else None
        stored = stored.where(F.lit(False) if number is None else F.col("user_id") == F.lit(number).cast("bigint"))
    return stored.select(
        F.col("user_id").cast("string").alias("user_id"),
        F.col("ts").cast("timestamp").alias("timestamp"),
        _event_type().alias("event_type"),
        _product_id().alias("product_id"),
        _pick("event_id", "mobile", "desktop", "tablet").alias("device"),
        _pick("event_id", "direct", "email", "organic", "paid search", "social", None).alias("referrer"),
    )


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean orders, their times moved into the month of the events."""
    return _table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").cast("string").alias("user_id"),
        _order_time().alias("timestamp"),
        F.col("o_totalprice").alias("total_amount"),
    )


def catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean catalog over all parts."""
    return _table(spark, sf_dir, "part").select(
        _catalog_id().alias("product_id"),
        F.lower(F.trim("p_type")).alias("category"),
        F.col("p_brand").alias("brand"),
        F.col("p_retailprice").alias("price"),
    )


def raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw events: minute-resolution time text, untidy words, some missing or broken cells."""
    time_text = F.date_format(F.col("ts").cast("timestamp"), EVENT_TIME_FORMAT)
    return _table(spark, sf_dir, "events").select(
        _blank_every(F.col("user_id").cast("string"), "event_id", 101).alias("customer_id"),
        _blank_every(_blank_every(time_text, "event_id", 107, "n/a"), "event_id", 103).alias("timestamp"),
        F.concat(F.lit(" "), F.upper(_event_type())).alias("event_type"),
        _blank_every(_product_id(), "event_id", 109).alias("product_id"),
        _pick("event_id", "Mobile", "desktop ", " TABLET").alias("device_type"),
        _pick("event_id", "Direct", "email ", "Organic", " Paid Search", "social", None).alias("traffic_source"),
    )


def raw_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw orders with some missing or broken cells."""
    time_text = F.date_format(_order_time(), ORDER_TIME_FORMAT)
    return _table(spark, sf_dir, "orders").select(
        _blank_every(F.col("o_orderkey"), "o_orderkey", 101).alias("transaction_id"),
        _blank_every(F.col("o_custkey").cast("string"), "o_orderkey", 103).alias("customer_id"),
        _blank_every(time_text, "o_orderkey", 107, "soon").alias("timestamp"),
        _blank_every(F.col("o_totalprice"), "o_orderkey", 109).alias("gross_revenue"),
    )


def raw_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw products: every fifth one is listed a second time as category `None`, some lack an id."""
    copies = F.when(F.pmod(F.col("p_partkey"), F.lit(5)) == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    second = F.col("copy") == 1
    return (
        _table(spark, sf_dir, "part")
        .withColumn("copy", F.explode(copies))
        .select(
            _blank_every(_catalog_id(), "p_partkey", 97).alias("product_id"),
            F.when(second, F.lit("None")).otherwise(F.concat(F.initcap("p_type"), F.lit(" "))).alias("category"),
            F.col("p_brand").alias("brand"),
            F.when(second, F.col("p_retailprice") + 1).otherwise(F.col("p_retailprice")).alias("base_price"),
        )
    )
