"""Recency, frequency and money over several lookbacks in one aggregate."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from holdfast.functions.columns import elapsed_days_text, expressions, ratio_text, timestamp_text, within_text

LOOKBACKS = (7, 14, 30, 60, 90, 180, 365)


def rfm_windows(
    transactions: DataFrame, as_of: datetime | str, lookbacks: tuple[int, ...] = LOOKBACKS
) -> DataFrame:
    """Per customer and window: count, sum, mean, sample std, min, max and whole days since the last.

    One scan and one shuffle for all windows; partial aggregates keep a heavy
    customer to one row per map task. A window without rows is NULL, not 0.
    """
    ts, now = "transaction_date", timestamp_text(as_of)
    rows = transactions.where(within_text(ts, as_of, max(lookbacks))).selectExpr(
        "customer_id",
        ts,
        "CAST(transaction_amount AS DOUBLE) AS _amount",
        "CAST(rint(CAST(transaction_amount AS DOUBLE) * 100) AS BIGINT) AS _cents",
    )
    aggregates, outputs = [], []
    for p in lookbacks:
        inside = f"FILTER (WHERE {ts} >= {now} - INTERVAL '{int(p)}' DAY)"
        aggregates += [
            f"count(*) {inside} AS _n_{p}",
            f"sum(_cents) {inside} / 100D AS _sum_{p}",
            f"stddev_samp(_amount) {inside} AS _std_{p}",
            f"min(_amount) {inside} AS _min_{p}",
            f"max(_amount) {inside} AS _max_{p}",
            f"max({ts}) {inside} AS _last_{p}",
        ]
        outputs += [
            f"nullif(_n_{p}, 0) AS transaction_count_{p}d",
            f"_sum_{p} AS total_spent_{p}d",
            f"try_divide(_sum_{p}, CAST(_n_{p} AS DOUBLE)) AS avg_transaction_{p}d",
            f"_std_{p} AS std_transaction_{p}d",
            f"_min_{p} AS min_transaction_{p}d",
            f"_max_{p} AS max_transaction_{p}d",
            f"{elapsed_days_text(f'_last_{p}', now)} AS recency_days_{p}d",
        ]
    return rows.groupBy("customer_id").agg(*map(F.expr, aggregates)).selectExpr("customer_id", *outputs)


# 30-day against 90-day trends, from NULL-able window columns (before any filling)
TRENDS = {
    "spending_trend_30_90": ratio_text("total_spent_30d", "total_spent_90d + 1"),
    "frequency_trend_30_90": ratio_text("transaction_count_30d", "transaction_count_90d + 1"),
    "recency_change_30_90": "recency_days_30d - recency_days_90d",
}


def rfm_trends(windows: DataFrame) -> DataFrame:
    return windows.withColumns(expressions(TRENDS))
