"""Sessions of a stream of events by the gap rule of the batch operator, sealed by a watermark.

A session goes on up to a gap of exactly the limit: Spark joins windows that touch. A
session is appended once when the watermark has passed its window; the open ones are
read from the stream's own state, so they hold what the stream has counted, and not rows
that came too late for it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from holdfast.operators.engagement import SESSION_GAP_MINUTES

DELAY = "1 hour"


def sessions(events: DataFrame, gap_minutes: int = SESSION_GAP_MINUTES, delay: str = DELAY) -> DataFrame:
    """``customer_id, session_start, session_end, event_count``, for a stream or a table; events without a time are left out.

    The session zone must be UTC, as windows need zoned times.
    """
    zoned = events.where("event_timestamp IS NOT NULL").withColumn("event_time", F.col("event_timestamp").cast("timestamp"))
    if zoned.isStreaming:
        zoned = zoned.withWatermark("event_time", delay)
    window = F.session_window("event_time", f"{int(gap_minutes)} minutes")
    found = zoned.groupBy("customer_id", window.alias("window")).agg(
        F.max("event_time").alias("last"), F.count("*").alias("event_count")
    )
    return found.select("customer_id", _local("window.start", "session_start"), _local("last", "session_end"), "event_count")


def _local(time: str, name: str) -> Column:
    return F.col(time).cast("timestamp_ntz").alias(name)


def open_sessions(spark: SparkSession, checkpoint: str) -> DataFrame:
    """Sessions that the stream with this checkpoint has not sealed yet, from its state."""
    kept = spark.read.format("statestore").load(checkpoint)
    return kept.select(
        F.col("key.customer_id").alias("customer_id"),
        _local("value.session_window.start", "session_start"),
        _local("value.max", "session_end"),
        F.col("value.count").alias("event_count"),
    )
