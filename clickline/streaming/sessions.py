"""Sessions over a stream of events.

A running session number needs a user's whole history, which is unbounded state, so a
streamed session is named by its user and start instead.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickline.operators.sessionize import DEFAULT_GAP_SECONDS


def session_rollup(
    events: DataFrame, gap_seconds: int = DEFAULT_GAP_SECONDS, lateness: str = "1 hour"
) -> DataFrame:
    """One row per session: user, first and last second, number of events.

    Works on a batch and on a stream. On a stream in append mode a session appears once the
    watermark, ``lateness`` behind the newest event, has passed its end; later events for it
    are dropped. Events without a time belong to no session here.

    Events are first counted per user and second, on the map side too, so what is brought together by user, and on a
    stream what its sessions are kept from, is a row per second, however many events a busy user has.
    """
    timed = events.withColumn("timestamp", F.date_trunc("second", "timestamp"))
    if events.isStreaming:
        timed = timed.withWatermark("timestamp", lateness)
    seconds = timed.where(F.col("timestamp").isNotNull()).groupBy("user_id", "timestamp").agg(F.count(F.lit(1)).alias("_events"))
    window = F.session_window("timestamp", f"{gap_seconds} seconds")
    return (
        seconds.groupBy("user_id", window)
        .agg(F.sum("_events").alias("events"), F.max("timestamp").alias("session_end"))
        .select("user_id", F.col("session_window.start").alias("session_start"), "session_end", "events")
    )
