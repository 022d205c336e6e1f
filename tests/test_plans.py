"""The physical plans that run are the ones the operators are designed for."""

from __future__ import annotations

from clickline.operators import attribute, funnel, report
from clickline.operators.sessionize import sessionize
from clickline.sources import files, schemas, testtables
from helpers import executed_plan


def final_plan(df):
    df.collect()
    plan = executed_plan(df)
    return plan[: plan.index("== Initial Plan ==")]


def exchanges(plan, kind):
    """How often rows move by ``kind`` of partitioning; a reused exchange names the one it reuses."""
    return plan.count(f"Exchange {kind}") - plan.count(f"], Exchange {kind}")


def test_sessionizing_scans_shuffles_and_sorts_events_once(spark, sf_dir):
    plan = final_plan(sessionize(testtables.events(spark, sf_dir)))
    events, carry = plan.split("BroadcastQueryStage", 1)
    assert plan.count("FileScan") == 1 and exchanges(plan, "rangepartitioning") == 1
    assert events.count("Join") == 1 and events.count("Sort [") == 1 and events.count("ArrowEvalPython") == 1
    # The carry between ranges: one row per range.
    assert carry.count("MapInArrow") == 1 and "ReusedExchange" in carry and "Join" not in carry


def test_funnel_shuffles_events_once_and_partial_counts_twice(spark, sf_dir):
    plan = final_plan(
        funnel.funnel_metrics(sessionize(testtables.events(spark, sf_dir)), testtables.catalog(spark, sf_dir))
    )
    assert exchanges(plan, "rangepartitioning") == 1
    assert "Exchange hashpartitioning(user_id" in plan and "Exchange hashpartitioning(category" in plan
    # The third moves the carry between ranges.
    assert plan.count("Exchange hashpartitioning") == 3 and "Exchange hashpartitioning(_user" in plan


def test_stage_tables_are_read_with_pushed_filters_and_few_columns(spark, sf_dir, tmp_path):
    files.write_table(sessionize(testtables.events(spark, sf_dir)), str(tmp_path / "sessions"))
    sessions = files.read_table(spark, str(tmp_path / "sessions"), schemas.EVENTS_WITH_SESSIONS)
    plan = executed_plan(attribute.touchpoints(sessions))
    assert "PushedFilters: [IsNotNull(referrer), Not(EqualTo(referrer,direct))]" in plan
    assert "ReadSchema: struct<user_id:string,timestamp:timestamp,referrer:string,session_id:string>" in plan

    files.write_small_table(
        funnel.funnel_metrics(sessions, testtables.catalog(spark, sf_dir)), str(tmp_path / "funnel")
    )
    metrics = files.read_table(spark, str(tmp_path / "funnel"), schemas.FUNNEL_METRICS)
    plan = executed_plan(report.summary(metrics))
    assert "ReadSchema: struct<total_views:bigint,total_carts:bigint,total_purchases:bigint>" in plan


def test_counting_touches_needs_no_sessions(spark, sf_dir):
    plain = testtables.events(spark, sf_dir)
    counted = attribute.lookback_counts(testtables.orders(spark, sf_dir), attribute.touchpoints(plain))
    assert "lag(" not in final_plan(counted)
    with_sessions = attribute.touchpoints(sessionize(plain))
    again = attribute.lookback_counts(testtables.orders(spark, sf_dir), with_sessions)
    assert counted.exceptAll(again).count() == 0 and again.exceptAll(counted).count() == 0
    assert "ArrowEvalPython" not in executed_plan(again)


def test_top_k_is_a_heap_and_not_a_full_sort(spark, sf_dir, tmp_path):
    scored = spark.createDataFrame([], schemas.ANOMALY_METRICS)
    files.write_table(scored, str(tmp_path / "scored"))
    plan = executed_plan(report.top_anomalies(files.read_table(spark, str(tmp_path / "scored"), schemas.ANOMALY_METRICS)))
    assert "TakeOrderedAndProject(limit=50" in plan
