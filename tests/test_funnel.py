from __future__ import annotations

from pyspark.sql import functions as F

from clickline.operators import funnel, report
from clickline.operators.sessionize import sessionize
from clickline.sources import schemas, testtables
from helpers import events, executed_plan, rows


def catalog(spark, *data):
    return spark.createDataFrame(list(data), schemas.CATALOG_CLEAN)


def test_counts_are_sessions_not_events(spark):
    frame = events(
        spark,
        [
            ("u", "2024-01-01 10:00:00", "view", 1),
            ("u", "2024-01-01 10:01:00", "view", 1),
            ("u", "2024-01-01 10:02:00", "purchase", 1),
            ("v", "2024-01-01 10:00:00", "view", 1),
            ("v", "2024-01-01 10:01:00", None, 1),
        ],
    )
    got = funnel.funnel_metrics(sessionize(frame), catalog(spark, (1, "toys", "b", 1.0)))
    assert got.columns == schemas.FUNNEL_METRICS.names
    row = got.collect()[0]
    assert (row.total_views, row.total_carts, row.total_purchases) == (2, 0, 1)
    assert (row.view_to_cart_rate, row.cart_to_purchase_rate, row.overall_conversion_rate) == (0.0, 0.0, 0.5)


def test_groups_without_funnel_events_and_null_keys_stay(spark):
    frame = events(
        spark,
        [
            ("u", "2024-01-01 10:00:00", "signup", 1, "mobile", None),
            ("u", "2024-01-01 10:00:00", None, 9, None, "email"),
            ("u", None, "view", 9, None, "email"),
        ],
    )
    flags = funnel.session_flags(funnel.enrich(sessionize(frame), catalog(spark, (1, "toys", "b", 1.0))))
    assert flags.count() == 3
    counted = funnel.funnel_counts(flags)
    assert rows(counted, "category", "device", "referrer", "total_views") == [
        (None, None, "email", 0),
        (None, None, "email", 1),
        ("toys", "mobile", None, 0),
    ]
    assert counted.where("date is null").count() == 1


def test_session_over_midnight_counts_on_both_days(spark):
    frame = events(spark, [("u", "2024-01-01 23:50:00"), ("u", "2024-01-02 00:10:00")])
    got = funnel.funnel_metrics(sessionize(frame), catalog(spark, (1, "toys", "b", 1.0)))
    assert [(str(d), n) for d, n in rows(got, "date", "total_views")] == [("2024-01-01", 1), ("2024-01-02", 1)]


def test_two_level_counts_equal_distinct_sessions(spark, sf_dir):
    enriched = funnel.enrich(sessionize(testtables.events(spark, sf_dir)), testtables.catalog(spark, sf_dir))
    ours = funnel.funnel_counts(funnel.session_flags(enriched))

    def sessions_with(event_type):
        return F.countDistinct(F.when(F.col("event_type") == event_type, F.col("session_id")))

    direct = funnel.with_date(enriched).groupBy(*funnel.DIMENSIONS).agg(
        sessions_with("view").alias("total_views"),
        sessions_with("add_to_cart").alias("total_carts"),
        sessions_with("purchase").alias("total_purchases"),
    )
    assert ours.exceptAll(direct).count() == 0 and direct.exceptAll(ours).count() == 0


def test_small_catalog_is_broadcast_and_a_large_one_is_not(spark, sf_dir):
    args = testtables.events(spark, sf_dir), testtables.catalog(spark, sf_dir)
    assert "BroadcastHashJoin" in executed_plan(funnel.enrich(*args))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1k")
    try:
        plan = executed_plan(funnel.enrich(*args))
        assert "BroadcastHashJoin" not in plan and "SortMergeJoin" in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_missing_category_finds_null_and_none(spark):
    frame = events(
        spark,
        [("u", "2024-01-01 10:00:00", "view", p) for p in (1, 2, 3, 4)],
    )
    cat = catalog(spark, (1, "toys", "b", 1.0), (2, "none", "b", 1.0), (3, None, "b", 1.0))
    got = funnel.missing_category(sessionize(frame), cat)
    assert got.columns == ["user_id", "session_id", "event_type", "product_id", "category"]
    assert rows(got, "product_id", "category") == [(2, "none"), (3, None), (4, None)]


def test_summary_of_an_empty_funnel_is_zero(spark):
    empty = spark.createDataFrame([], schemas.FUNNEL_METRICS)
    assert rows(report.summary(empty)) == [(0, 0, 0, 0.0, 0.0, 0.0)]
    assert rows(report.funnel_steps(empty)) == [("Carts", 0), ("Purchases", 0), ("Views", 0)]
