"""Event rollup, sessions and engagement rates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from holdfast.functions.columns import expressions, ratio_text
from holdfast.functions.ordering import HOT_ROWS, hot_instants, previous_instants, running_max, split_hot

SESSION_GAP_MINUTES = 30
# sums of times are exact to a billionth of a second
SECONDS = "decimal(28,9)"

# event type -> output column (fixed values)
EVENT_COUNTS = {
    "page_view": "page_views",
    "click": "clicks",
    "search": "searches",
    "add_to_cart": "add_to_cart",
}


def _opens(ts: str, gap_minutes: int) -> Column:
    """The gap to the event before exceeds the limit, to the microsecond."""
    gap = F.expr(f"INTERVAL '{int(gap_minutes)}' MINUTE")
    return F.col("previous").isNull() | (F.col(ts) - F.col("previous") > gap)


def sessionize_events(
    events: DataFrame, gap_minutes: int = SESSION_GAP_MINUTES, hot_rows: int | None = HOT_ROWS
) -> DataFrame:
    """One row per session: a new one opens when the gap to the event before exceeds the limit."""
    key, ts = "customer_id", "event_timestamp"
    opened = F.when(_opens(ts, gap_minutes), F.col(ts))
    rows = events.where(F.col(ts).isNotNull()).select(key, ts)
    plain, hot = (rows, None) if hot_rows is None else split_hot(rows, key, hot_rows)
    in_order = W.partitionBy(key).orderBy(ts)
    marked = (
        plain.withColumn("previous", F.lag(ts).over(in_order))
        .withColumn("_opened", opened)
        .select(
            key,
            ts,
            F.lit(1).cast("bigint").alias("n"),
            F.max("_opened").over(in_order.rowsBetween(W.unboundedPreceding, 0)).alias("session_start"),
        )
    )
    if hot is not None:
        points = running_max(hot_instants(hot, key, ts), key, ts, opened, "session_start", include_current=True)
        marked = marked.unionByName(points.select(key, ts, "n", "session_start"))
    return marked.groupBy(key, "session_start").agg(F.max(ts).alias("session_end"), F.sum("n").alias("event_count"))


def session_counts(
    events: DataFrame, gap_minutes: int = SESSION_GAP_MINUTES, hot_rows: int | None = HOT_ROWS
) -> DataFrame:
    """Sessions per customer: distinct given ids, else the gap rule."""
    if "session_id" in events.columns:
        pairs = events.groupBy("customer_id", "session_id").agg(F.lit(1).alias("_seen"))
        return pairs.groupBy("customer_id").agg(F.count("session_id").alias("session_count"))
    points = previous_instants(events, "customer_id", "event_timestamp", hot_rows)
    opens = F.count_if(_opens("event_timestamp", gap_minutes))
    return points.groupBy("customer_id").agg(opens.alias("session_count"))


def engagement_rollup(
    events: DataFrame, gap_minutes: int = SESSION_GAP_MINUTES, hot_rows: int | None = HOT_ROWS
) -> DataFrame:
    """Counts, distinct types, time and last event per customer.

    Rolled up by (customer, type) first: distinct types need no row expansion.
    """
    by_type = events.groupBy("customer_id", "event_type").agg(
        F.count("*").alias("_n"),
        F.sum(F.col("time_spent_seconds").cast(SECONDS)).alias("_time"),
        F.max("event_timestamp").alias("_last"),
    )
    rollup = by_type.groupBy("customer_id").agg(
        F.expr("sum(_n) AS total_events"),
        F.expr("count(event_type) AS unique_event_type_count"),
        *[
            F.expr(f"coalesce(sum(_n) FILTER (WHERE event_type = '{kind}'), 0) AS {name}")
            for kind, name in EVENT_COUNTS.items()
        ],
        F.expr("CAST(coalesce(sum(_time), 0) AS DOUBLE) AS total_time_spent"),
        F.expr("max(_last) AS last_event_date"),
    )
    return rollup.join(session_counts(events, gap_minutes, hot_rows), "customer_id", "left")


RATES = {
    "page_view_rate": ratio_text("page_views", "total_events + 1"),
    "click_rate": ratio_text("clicks", "page_views + 1"),
    "search_rate": ratio_text("searches", "total_events + 1"),
    "cart_conversion_rate": ratio_text("add_to_cart", "page_views + 1"),
    "avg_time_per_session": ratio_text("total_time_spent", "session_count + 1"),
    "engagement_score": "total_events * 0.3D + page_views * 0.2D + clicks * 0.2D + searches * 0.15D + add_to_cart * 0.15D",
}


def engagement_rates(rollup: DataFrame) -> DataFrame:
    return rollup.withColumns(expressions(RATES))
