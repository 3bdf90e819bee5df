"""Churn labels: no transaction within the horizon after the as-of time."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from holdfast.functions.columns import instant


def churn_labels(
    customers: DataFrame, transactions: DataFrame, as_of: datetime | str, horizon_days: int = 365
) -> DataFrame:
    """1 when nothing happens in ``[as_of, as_of + horizon)``; buyers are deduplicated before the join."""
    end = instant(as_of) + F.expr(f"INTERVAL '{int(horizon_days)}' DAY")
    ts = F.col("transaction_date")
    buyers = (
        transactions.where((ts >= instant(as_of)) & (ts < end))
        .groupBy("customer_id")
        .agg(F.count("*").alias("_purchases"))
    )
    return customers.select("customer_id").join(buyers, "customer_id", "left").select(
        "customer_id", F.col("_purchases").isNull().cast("int").alias("churned")
    )


def class_distribution(df: DataFrame, label: str = "churned") -> DataFrame:
    return df.groupBy(label).agg(F.count("*").alias("rows"))
