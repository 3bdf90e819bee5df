"""Windowed event counts as a stream, sealed by a watermark."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from holdfast.operators.engagement import SECONDS

WINDOW, DELAY = "1 day", "1 hour"


def read_stream(spark: SparkSession, folder: str, schema, pattern: str = "*.parquet", files_per_batch: int = 100) -> DataFrame:
    """Parquet files as they arrive in ``folder``."""
    return (
        spark.readStream.schema(schema)
        .option("pathGlobFilter", pattern)
        .option("maxFilesPerTrigger", files_per_batch)
        .parquet(folder)
    )


def windowed_counts(events: DataFrame, window: str = WINDOW, delay: str = DELAY) -> DataFrame:
    """Events and time per window and type, for a stream or a table.

    The watermark needs a zoned timestamp; the session zone must be UTC, as
    the windows are cut in it. Time is summed in decimals, so a stream and a
    table give equal sums.
    """
    zoned = events.withColumn("event_time", F.col("event_timestamp").cast("timestamp"))
    if zoned.isStreaming:
        zoned = zoned.withWatermark("event_time", delay)
    return (
        zoned.groupBy(F.window("event_time", window).alias("w"), "event_type")
        .agg(F.count("*").alias("events"), F.sum(F.col("time_spent_seconds").cast(SECONDS)).alias("_time"))
        .select(
            F.col("w.start").cast("timestamp_ntz").alias("window_start"),
            F.col("w.end").cast("timestamp_ntz").alias("window_end"),
            "event_type",
            "events",
            F.col("_time").cast("double").alias("time_spent_seconds"),
        )
    )


def start(counts: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append sealed windows to ``path``; files and checkpoint together make each window land once."""
    return (
        counts.writeStream.outputMode("append")
        .format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def with_open_windows(
    sealed: DataFrame, events: DataFrame, window: str = WINDOW, delay: str = DELAY
) -> DataFrame:
    """Sealed windows from the sink plus the still open ones, counted from the rows themselves.

    A window is open while it ends after the watermark, the newest event less
    the delay; open windows lie in the last ``window + delay``, so only that
    tail is read.
    """
    sealed_to = events.agg(F.max("event_timestamp") - F.expr(f"INTERVAL {delay}")).scalar()
    watermark = F.date_trunc("MILLISECOND", sealed_to.cast("timestamp")).cast("timestamp_ntz")
    tail_start = sealed_to - F.expr(f"INTERVAL {window}")
    tail = events.where(F.col("event_timestamp") >= tail_start)
    still_open = windowed_counts(tail, window, delay).where(F.col("window_end") > watermark)
    return sealed.where(F.col("window_end") <= watermark).unionByName(still_open)
