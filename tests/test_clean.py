from __future__ import annotations

from clickline.operators import clean
from clickline.sources import schemas
from helpers import rows

EVENT_COLUMNS = "customer_id string, timestamp string, event_type string, product_id bigint, device_type string, traffic_source string"


def test_events_drop_missing_keys_and_keep_unparsed_times(spark):
    raw = spark.createDataFrame(
        [
            (None, "01-02-2024 10:00", "view", 1, "Mobile", "Email"),
            ("1", None, "view", 1, "Mobile", "Email"),
            ("2", "01-02-2024 10:00", "view", None, "Mobile", "Email"),
            ("3", "2024/02/01", "view", 1, "Mobile", "Email"),
            ("4", "01-02-2024 10:05", " View ", 1, " MOBILE", None),
        ],
        EVENT_COLUMNS,
    )
    cleaned = clean.clean_events(raw)
    assert cleaned.columns == schemas.EVENTS_CLEAN.names
    assert rows(cleaned, "user_id", "event_type", "device", "referrer") == [
        ("3", "view", "mobile", "email"),
        ("4", "view", "mobile", None),
    ]
    times = {r.user_id: r.timestamp for r in cleaned.collect()}
    assert times["3"] is None
    assert str(times["4"]) == "2024-02-01 10:05:00"
    assert rows(clean.clean_events(raw, drop_unparsed=True), "user_id") == [("4",)]


def test_orders_drop_after_parsing_and_keep_copies_and_odd_amounts(spark):
    raw = spark.createDataFrame(
        [
            (1, "a", "2024-02-01 10:00:00", 5.0),
            (1, "a", "2024-02-01 10:00:00", 5.0),
            (2, "a", "not a time", 5.0),
            (None, "a", "2024-02-01 10:00:00", 5.0),
            (3, None, "2024-02-01 10:00:00", 5.0),
            (4, "b", "2024-02-01 10:00:00", None),
            (5, "b", "2024-02-01 10:00:00", -1.0),
        ],
        schemas.RAW_TRANSACTIONS,
    )
    cleaned = clean.clean_orders(raw)
    assert [f.dataType for f in cleaned.schema] == [f.dataType for f in schemas.ORDERS_CLEAN]
    assert rows(cleaned, "order_id", "total_amount") == [(1, 5.0), (1, 5.0), (4, None), (5, -1.0)]


def test_catalog_keeps_the_smallest_row_per_product(spark):
    raw = spark.createDataFrame(
        [
            (1, " Toys ", "Z", 3.0),
            (1, "BOOKS", "Y", 9.0),
            (1, "books", "Y", 2.0),
            (2, None, "x", 1.0),
            (2, "art", "x", 1.0),
            (None, "art", "x", 1.0),
        ],
        schemas.RAW_PRODUCTS,
    )
    assert rows(clean.clean_catalog(raw)) == [(1, "books", "Y", 2.0), (2, None, "x", 1.0)]
