"""Latest subscription per customer and its stability score."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from holdfast.functions.columns import expressions, instant, ratio_text

LATEST_COLUMNS = ("monthly_fee", "auto_renewal_enabled", "upgrade_count", "downgrade_count", "reactivation_count")


def latest_subscription(subscriptions: DataFrame, as_of: datetime | str) -> DataFrame:
    """The latest non-null value of every column (not one row), newest start first, then id.

    Whole-number ids are packed with the date into one decimal, which a hash
    aggregate can hold; a struct of date and text id needs a sort aggregate.
    """
    if isinstance(subscriptions.schema["subscription_id"].dataType, T.IntegralType):
        day = "CAST(unix_date(subscription_start_date) AS DECIMAL(6,0))"
        order = f"{day} * {10**19}BD + CAST(subscription_id AS DECIMAL(19,0))"
    else:
        order = "struct(subscription_start_date, subscription_id)"
    newest = subscriptions.groupBy("customer_id").agg(
        F.max("subscription_start_date").alias("_start"),
        *[F.expr(f"max_by({c}, {order}) FILTER (WHERE {c} IS NOT NULL) AS {c}") for c in LATEST_COLUMNS],
    )
    today = instant(as_of).cast("date")
    return newest.select(
        "customer_id", F.datediff(today, "_start").alias("subscription_tenure_days"), *LATEST_COLUMNS
    )


_UP_DOWN = ratio_text("upgrade_count", "downgrade_count + 1")
STABILITY = {
    "upgrade_downgrade_ratio": _UP_DOWN,
    "subscription_stability_score": "subscription_tenure_days * 0.4D + CAST(auto_renewal_enabled AS INT) * 30D "
    f"+ {_UP_DOWN} * 15D",
}


def subscription_stability(latest: DataFrame) -> DataFrame:
    return latest.withColumns(expressions(STABILITY))
