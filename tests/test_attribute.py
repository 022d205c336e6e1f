from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from clickline.operators import attribute
from clickline.operators.sessionize import sessionize
from clickline.sources import testtables
from helpers import events, executed_plan, orders, rows, touches

ORDER_AT = dt.datetime(2024, 1, 20, 12, 0, 0)


def before(seconds: float) -> str:
    return str(ORDER_AT - dt.timedelta(seconds=seconds))


def credited(spark, touch_rows, order_rows=((1, "u", str(ORDER_AT), 10.0),), **options):
    got = attribute.last_touch(orders(spark, list(order_rows)), touches(spark, touch_rows), **options)
    return rows(got, "order_id", "user_id", "session_id", "marketing_channel")


def test_touchpoints_need_a_known_channel(spark):
    frame = events(
        spark,
        [("u", "2024-01-01 10:00:00", t, 1, "mobile", r) for t, r in
         [("view", "email"), ("error", "social"), ("view", "direct"), ("view", None), ("view", "")]],
    )
    got = attribute.touchpoints(sessionize(frame))
    assert got.columns == ["user_id", "event_time", "marketing_channel", "session_id"]
    assert rows(got, "marketing_channel") == [("",), ("email",), ("social",)]


@pytest.mark.parametrize(
    "age, channel",
    [(0, "email"), (1, "email"), (604800, "email"), (604801, "direct"), (-1, "direct"), (-0.5, "email"), (604800.5, "direct")],
)
def test_window_is_closed_at_both_ends_in_whole_seconds(spark, age, channel):
    session = "u_1" if channel == "email" else None
    assert credited(spark, [("u", before(age), "email", "u_1")]) == [(1, "u", session, channel)]
    counted = attribute.lookback_counts(
        orders(spark, [(1, "u", str(ORDER_AT), 10.0)]), touches(spark, [("u", before(age), "email", "u_1")])
    )
    assert rows(counted, "eligible_touches") == [(int(channel == "email"),)]


def test_latest_touch_wins_and_ties_are_settled(spark):
    near = [("u", before(604800), "a", "u_1"), ("u", before(1), "b", "u_2"), ("u", before(-1), "z", "u_9")]
    assert credited(spark, near) == [(1, "u", "u_2", "b")]
    tied = [("u", before(5), "b", "u_2"), ("u", before(5), "c", "u_2"), ("u", before(5), "z", "u_1")]
    for order in (tied, tied[::-1]):
        assert credited(spark, order) == [(1, "u", "u_2", "c")]


def test_unmatched_orders_stay_as_direct(spark):
    got = credited(
        spark,
        [("v", before(10), "email", "v_1"), (None, before(10), "email", "1"), ("u", None, "email", "u_1")],
        [(1, "u", str(ORDER_AT), 1.0), (2, None, str(ORDER_AT), 1.0), (3, "u", None, 1.0)],
    )
    assert got == [(1, "u", None, "direct"), (2, None, None, "direct"), (3, "u", None, "direct")]


def test_repeated_order_ids_do_not_fan_out(spark):
    order_rows = [(1, "u", str(ORDER_AT), 10.0), (1, "v", str(ORDER_AT), 20.0), (1, "u", str(ORDER_AT), 10.0)]
    got = attribute.last_touch(
        orders(spark, order_rows), touches(spark, [("u", before(1), "email", "u_1"), ("v", before(2), "social", "v_1")])
    )
    assert rows(got, "user_id", "total_amount", "marketing_channel") == [
        ("u", 10.0, "email"), ("u", 10.0, "email"), ("v", 20.0, "social"),
    ]
    assert rows(attribute.channel_revenue(got)) == [("email", 20.0), ("social", 20.0)]


@pytest.mark.parametrize("lookback", [0, 1, 60, 3600])
def test_equals_pairing_everything(spark, lookback):
    draw = random.Random(lookback)
    span = 20 * lookback + 20

    def moment(fraction):
        return str(dt.datetime(2024, 1, 1) + dt.timedelta(seconds=draw.randint(0, span), milliseconds=fraction))

    touch_rows = [(draw.choice("abc"), moment(draw.choice([0, 250, 999])), draw.choice(["x", "y"]), f"s{i % 4}") for i in range(150)]
    order_rows = [(i, draw.choice("abcd"), moment(draw.choice([0, 500])), 1.0) for i in range(120)]

    def second(text):
        return int(dt.datetime.fromisoformat(text).replace(tzinfo=dt.timezone.utc).timestamp() // 1)

    best, counts = [], []
    for order_id, user, at, _ in order_rows:
        near = [
            (dt.datetime.fromisoformat(t), session, channel)
            for u, t, channel, session in touch_rows
            if u == user and 0 <= second(at) - second(t) <= lookback
        ]
        counts.append((order_id, len(near)))
        chosen = max(near) if near else (None, None, "direct")
        best.append((order_id, user, chosen[1], chosen[2]))

    order_by_text = lambda t: tuple((v is not None, str(v)) for v in t)
    assert credited(spark, touch_rows, order_rows, lookback_seconds=lookback) == sorted(best, key=order_by_text)
    counted = attribute.lookback_counts(orders(spark, order_rows), touches(spark, touch_rows), lookback)
    assert rows(counted, "order_id", "eligible_touches") == sorted(counts, key=order_by_text)


def test_no_order_is_lost_or_doubled(spark, sf_dir):
    placed = testtables.orders(spark, sf_dir)
    got = attribute.last_touch(placed, attribute.touchpoints(sessionize(testtables.events(spark, sf_dir))))
    assert got.count() == placed.count()
    assert got.where("marketing_channel != 'direct'").count() == 130
    difference = placed.select("order_id", "user_id", "total_amount").exceptAll(
        got.select("order_id", "user_id", "total_amount")
    )
    assert difference.count() == 0


def test_plan_never_pairs_touches_with_orders(spark, sf_dir):
    seen = attribute.touchpoints(sessionize(testtables.events(spark, sf_dir)))
    for build in (attribute.last_touch, attribute.lookback_counts):
        plan = executed_plan(build(testtables.orders(spark, sf_dir), seen))
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_top_n_per_group_limits_before_the_shuffle(spark, sf_dir):
    frame = testtables.events(spark, sf_dir)
    top = attribute.top_n_per_group(frame, ["user_id"], [F.col("timestamp").desc(), F.col("product_id")], 2)
    assert top.count() == 2 * frame.select("user_id").distinct().count()
    plan = executed_plan(top)
    assert plan.count("WindowGroupLimit") == 2
    assert plan.rindex("WindowGroupLimit") > plan.index("Exchange hashpartitioning")
