from __future__ import annotations

from pyspark.sql import functions as F

from clickline.sources import schemas, testtables
from clickline.streaming.sessions import session_rollup


def test_stream_and_batch_agree(spark, sf_dir, tmp_path):
    frame = testtables.events(spark, sf_dir)
    # A far later event moves the watermark past every real session.
    closing = frame.limit(1).withColumn("timestamp", F.lit("2030-01-01").cast("timestamp"))
    source = tmp_path / "in"
    frame.coalesce(1).write.parquet(str(source / "a"))
    closing.coalesce(1).write.parquet(str(source / "b"))
    stream = (
        spark.readStream.schema(schemas.EVENTS_CLEAN)
        .option("recursiveFileLookup", "true")
        .option("maxFilesPerTrigger", 1)
        .parquet(str(source))
    )
    query = (
        session_rollup(stream)
        .writeStream.outputMode("append")
        .option("checkpointLocation", str(tmp_path / "state"))
        .format("parquet")
        .trigger(availableNow=True)
        .start(str(tmp_path / "out"))
    )
    query.awaitTermination(120)
    assert query.exception() is None
    streamed = spark.read.parquet(str(tmp_path / "out"))
    batch = session_rollup(frame)
    assert batch.count() > 900
    assert batch.exceptAll(streamed).count() == 0
    assert streamed.exceptAll(batch).count() == 0


def test_a_busy_user_is_a_row_per_second_before_the_shuffle(spark):
    busy = spark.range(0, 40000, 1, 4).select(
        F.when(F.col("id") % 3 > 0, "hot").otherwise(F.col("id").cast("string")).alias("user_id"),
        F.timestamp_seconds(F.lit(1704067200) + F.pmod(F.col("id"), F.lit(90)) * 40).alias("timestamp"),
    )
    got = session_rollup(busy, gap_seconds=100)
    hot = got.where("user_id = 'hot'").collect()
    assert [(r["events"], (r["session_end"] - r["session_start"]).seconds) for r in hot] == [(26666, 3520)]
    assert got.count() == 1 + 13334
    assert got.selectExpr("sum(events) e").first()["e"] == 40000
