"""Declared schemas of the raw inputs and of every stage table."""

from __future__ import annotations

from pyspark.sql import types as T


def _schema(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields.items()])


_text, _long, _real = T.StringType(), T.LongType(), T.DoubleType()
_time, _day = T.TimestampType(), T.DateType()

# Raw inputs. User ids are text: scaled-up data carries ids such as 7_1.
RAW_EVENTS = _schema(
    customer_id=_text, timestamp=_text, event_type=_text, product_id=_long,
    device_type=_text, traffic_source=_text,
)
RAW_TRANSACTIONS = _schema(
    transaction_id=_long, customer_id=_text, timestamp=_text, gross_revenue=_real,
)
RAW_PRODUCTS = _schema(product_id=_long, category=_text, brand=_text, base_price=_real)



def with_text(schema: T.StructType, *names: str) -> T.StructType:
    """``schema`` with the columns ``names`` as text."""
    return T.StructType([T.StructField(f.name, _text if f.name in names else f.dataType, True) for f in schema.fields])


EVENTS_CLEAN = _schema(
    user_id=_text, timestamp=_time, event_type=_text, product_id=_long,
    device=_text, referrer=_text,
)
ORDERS_CLEAN = _schema(order_id=_long, user_id=_text, timestamp=_time, total_amount=_real)
CATALOG_CLEAN = _schema(product_id=_long, category=_text, brand=_text, price=_real)

EVENTS_WITH_SESSIONS = T.StructType(EVENTS_CLEAN.fields + _schema(session_id=_text).fields)

FUNNEL_METRICS = _schema(
    category=_text, device=_text, referrer=_text, date=_day,
    total_views=_long, total_carts=_long, total_purchases=_long,
    view_to_cart_rate=_real, cart_to_purchase_rate=_real, overall_conversion_rate=_real,
)
ATTRIBUTED_ORDERS = _schema(
    order_id=_long, user_id=_text, order_time=_time, total_amount=_real,
    session_id=_text, marketing_channel=_text,
)
ANOMALIES = _schema(
    date=_day, category=_text, daily_views=_long, daily_purchases=_long,
    daily_conversion_rate=_real, trailing_7d_avg=_real, pct_change=_real,
    anomaly_type=_text, explanation=_text,
)
ANOMALY_METRICS = T.StructType(
    FUNNEL_METRICS.fields
    + _schema(rolling_avg_conversion=_real, rolling_std=_real, z_score=_real, anomaly_flag=_text).fields
)
