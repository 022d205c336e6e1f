"""Last-touch attribution of orders to marketing channels.

An order at second ``t`` may be credited to any touch of the same user at second ``s`` with
``0 <= t - s <= lookback``. Rows are cut into blocks of ``lookback + 1`` seconds, so that a
touch can only matter to orders of its own block and of the next one. Touches are reduced
map-side per (user, second) before any window, and every window group is one (user, block):
its size is bounded by the number of seconds in a block, however busy the user is. Touches
and orders are never paired up.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clickline.functions.columns import slot_start, whole_seconds
from clickline.functions.sums import sum_exactly

DEFAULT_LOOKBACK_SECONDS = 604800
DIRECT = "direct"


def touchpoints(sessions: DataFrame) -> DataFrame:
    """Events of any type that came through a known channel other than ``direct``.

    Where touches are only counted, plain events will do; they have no ``session_id``.
    """
    columns = {"user_id": "user_id", "timestamp": "event_time", "referrer": "marketing_channel", "session_id": "session_id"}
    known = F.col("referrer").isNotNull() & (F.col("referrer") != DIRECT)
    return sessions.where(known).select(*[F.col(c).alias(to) for c, to in columns.items() if c in sessions.columns])


def last_touch(
    orders: DataFrame, touches: DataFrame, lookback_seconds: int = DEFAULT_LOOKBACK_SECONDS
) -> DataFrame:
    """Every order once, with the session and channel of its latest eligible touch.

    Equal touch times are settled by the larger session id, then the larger channel. Orders
    without an eligible touch get channel ``direct`` and no session.
    """
    width = lookback_seconds + 1
    orders = orders.withColumnRenamed("timestamp", "order_time")
    seen = (
        touches.where(F.col("user_id").isNotNull() & F.col("event_time").isNotNull())
        .groupBy("user_id", whole_seconds("event_time").alias("_at"))
        .agg(F.max(F.struct("event_time", "session_id", "marketing_channel")).alias("_touch"))
        .withColumn("_wanted", F.lit(False))
    )
    wanted = (
        orders.select("user_id", whole_seconds("order_time").alias("_at"))
        .dropna()
        .distinct()
        .withColumn("_wanted", F.lit(True))
    )
    block = Window.partitionBy("user_id", "_block").orderBy(F.col("_at").asc_nulls_first(), "_wanted")
    up_to_here = block.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    latest = F.last("_touch", ignorenulls=True).over(up_to_here)

    # Inside its block, every order second meets the latest touch so far.
    inside = (
        seen.unionByName(wanted, allowMissingColumns=True)
        .withColumn("_block", slot_start(F.col("_at"), width))
        .withColumns({"_latest": latest, "_next": F.lead("_at").over(block)})
        .where(F.col("_wanted") | F.col("_next").isNull())
    )
    # The last touch of a block moves on as the opening row of the next one.
    order_row = F.struct("_block", "_at", "_latest", "_wanted")
    opening_row = F.struct(
        (F.col("_block") + width).alias("_block"),
        F.lit(None).cast("long").alias("_at"),
        "_latest",
        F.lit(False).alias("_wanted"),
    )
    closes = F.col("_next").isNull() & F.col("_latest").isNotNull()
    rows = F.array_compact(F.array(F.when(F.col("_wanted"), order_row), F.when(closes, opening_row)))
    found = (
        inside.select("user_id", F.explode(rows).alias("_row"))
        .select("user_id", "_row._block", "_row._at", "_row._wanted", F.col("_row._latest").alias("_touch"))
        .withColumn("_touch", latest)
        .where(F.col("_wanted") & (F.col("_at") - whole_seconds("_touch.event_time") <= lookback_seconds))
        .select("user_id", "_at", "_touch.session_id", "_touch.marketing_channel")
    )
    return (
        orders.withColumn("_at", whole_seconds("order_time"))
        .join(found, ["user_id", "_at"], "left")
        .select(
            *orders.columns,
            "session_id",
            F.coalesce("marketing_channel", F.lit(DIRECT)).alias("marketing_channel"),
        )
    )


def lookback_counts(
    orders: DataFrame, touches: DataFrame, lookback_seconds: int = DEFAULT_LOOKBACK_SECONDS
) -> DataFrame:
    """Every order once, with the number of touches inside its lookback window.

    The number is a difference of running totals taken at both ends of the window, so the
    (order, touch) pairs themselves are counted but never produced.
    """
    width = lookback_seconds + 1
    orders = orders.withColumnRenamed("timestamp", "order_time")
    at = whole_seconds("order_time")
    # Within a second the window start sorts before the touches and the window end after them.
    start, touch, end = 0, 1, 2
    seen = (
        touches.where(F.col("event_time").isNotNull())
        .groupBy("user_id", whole_seconds("event_time").alias("_at"))
        .agg(F.count(F.lit(1)).alias("_touches"))
        .select("user_id", "_at", F.lit(touch).alias("_kind"), "_touches", F.lit(None).cast("long").alias("_order_at"))
    )
    wanted = orders.select("user_id", at.alias("_order_at")).dropna().distinct()
    ends = wanted.select(
        "user_id",
        F.explode(
            F.array(
                F.struct((F.col("_order_at") - lookback_seconds).alias("_at"), F.lit(start).alias("_kind")),
                F.struct(F.col("_order_at").alias("_at"), F.lit(end).alias("_kind")),
            )
        ).alias("_end"),
        "_order_at",
    ).select("user_id", "_end.*", F.lit(0).cast("long").alias("_touches"), "_order_at")

    block = Window.partitionBy("user_id", "_block")
    running = block.orderBy("_at", "_kind").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    marks = seen.unionByName(ends).where(F.col("user_id").isNotNull()).withColumn(
        "_block", slot_start(F.col("_at"), width)
    ).withColumn("_upto", F.sum("_touches").over(running)).withColumn("_total", F.sum("_touches").over(block))
    crosses = F.col("_block") != slot_start(F.col("_order_at"), width)
    part = F.when(F.col("_kind") == end, F.col("_upto")).otherwise(
        F.when(crosses, F.col("_total")).otherwise(F.lit(0)) - F.col("_upto")
    )
    counted = (
        marks.where(F.col("_kind") != touch)
        .groupBy("user_id", F.col("_order_at").alias("_at"))
        .agg(F.sum(part).alias("_touches"))
    )
    return (
        orders.withColumn("_at", at)
        .join(counted, ["user_id", "_at"], "left")
        .select(*orders.columns, F.coalesce("_touches", F.lit(0)).alias("eligible_touches"))
    )


def channel_revenue(attributed: DataFrame) -> DataFrame:
    """Revenue per channel, largest first; the sums do not depend on the order of the rows."""
    revenue = sum_exactly(attributed, ["marketing_channel"], "total_amount", "total_revenue")
    return revenue.orderBy(F.col("total_revenue").desc(), F.col("marketing_channel").asc())


def top_n_per_group(df: DataFrame, keys: list[str], order: list, n: int) -> DataFrame:
    """The first ``n`` rows per group; Spark keeps only ``n`` per group and task before the shuffle."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("rank", rank).where(F.col("rank") <= n)
