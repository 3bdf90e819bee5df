"""The wide feature table: one row per customer."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from holdfast.functions.columns import expressions
from holdfast.functions.ordering import HOT_ROWS, hot_limit
from holdfast.operators import customer, engagement, rfm, subscription, support
from holdfast.operators import transactions as behaviour
from holdfast.operators.rfm import LOOKBACKS
from holdfast.session import pinned
from holdfast.sources.scans import scan_events, scan_subscription_history, scan_tickets, scan_transactions

# groups and the columns or prefixes in them (fixed values)
FEATURE_GROUPS = {
    "rfm": ["recency_days_", "transaction_count_", "total_spent_", "avg_transaction_"],
    "engagement": ["page_views", "clicks", "searches", "engagement_score", "page_view_rate", "click_rate"],
    "support": ["support_ticket_count", "support_resolution_rate", "days_since_last_ticket"],
    "subscription": ["subscription_tenure_days", "auto_renewal_enabled", "upgrade_downgrade_ratio"],
    "behavioral": ["activity_decline_30_90", "preliminary_risk_score", "estimated_clv"],
    "demographic": ["age", "gender_frequency", "country_frequency", "customer_tier_frequency"],
}
_RFM_WINDOWS = ("30d", "90d", "365d")


def joined_groups(
    profiles: DataFrame,
    tables: dict[str, DataFrame],
    as_of: datetime | str,
    activity_as_of: datetime | str | None = None,
    lookback_days: int = 365,
    lookbacks: tuple[int, ...] = LOOKBACKS,
    transactions_hot: int | None = HOT_ROWS,
    events_hot: int | None = HOT_ROWS,
) -> DataFrame:
    """Profiles with every per-customer group and the columns that need only their own row.

    Each source is reduced to one row per customer before it is joined, so a
    heavy customer is never joined row by row and all joins share one key. A
    customer's rows are split beyond ``transactions_hot`` and ``events_hot`` rows;
    None says that none has as many.
    """
    activity = activity_as_of or as_of
    transactions = scan_transactions(tables["transactions"], as_of, lookback_days)
    lines = scan_transactions(tables.get("transaction_lines", tables["transactions"]), as_of, lookback_days)
    groups = [
        # the windows read their own range: they may be longer than the lookback
        rfm.rfm_windows(tables["transactions"], as_of, lookbacks),
        behaviour.distinct_per_customer(transactions, "payment_method", "payment_method_count"),
        behaviour.line_features(lines),
        behaviour.transaction_regularity(transactions, transactions_hot),
        engagement.engagement_rollup(scan_events(tables["user_events"], activity, lookback_days), hot_rows=events_hot),
        support.support_rollup(scan_tickets(tables["support_tickets"], activity, lookback_days)),
        subscription.latest_subscription(scan_subscription_history(tables["subscription_history"], as_of), as_of),
    ]
    wide = profiles
    for group in groups:
        wide = wide.join(group, "customer_id", "left")
    ratios = rfm.TRENDS | engagement.RATES | support.rates(activity) | subscription.STABILITY | customer.TEMPORAL
    own = customer.VALUE | customer.RISK_FLAGS | customer.AGE_GROUP
    return wide.withColumns(expressions(ratios)).withColumns(expressions(own))


def build_features(
    profiles: DataFrame,
    tables: dict[str, DataFrame],
    as_of: datetime | str,
    activity_as_of: datetime | str | None = None,
    lookback_days: int = 365,
    lookbacks: tuple[int, ...] = LOOKBACKS,
) -> DataFrame:
    """The feature table before missing values are filled.

    The joined groups are written once; what compares a customer with all
    customers (quantile, maximum, frequencies) then reads that table instead
    of the sources. Whether a customer's rows need to be split is counted once a source. Events and tickets may have their own as-of time.
    ``tables`` may hold ``transaction_lines`` where categories, refunds and
    quantities are finer than transactions.
    """
    transactions = scan_transactions(tables["transactions"], as_of, lookback_days)
    events = scan_events(tables["user_events"], activity_as_of or as_of, lookback_days)
    hot = [hot_limit(source, "customer_id") for source in (transactions, events)]
    wide = pinned(joined_groups(profiles, tables, as_of, activity_as_of, lookback_days, lookbacks, *hot), "features")
    top_score = wide.agg(F.max("login_frequency_score")).scalar()
    compared = wide.withColumns(
        {
            "is_high_value": customer.high_value_flag(wide, wide.count()),
            "preliminary_risk_score": customer.preliminary_risk_score(top_score),
        }
    )
    return customer.frequency_encoding(compared, customer.value_frequencies(wide))


def feature_group_summary(features: DataFrame) -> DataFrame:
    """The feature-group catalogue against the columns of a table, with non-null counts."""
    return group_members(features.sparkSession, features.columns).join(
        _non_null_counts(features), "column_name", "left"
    ).select("feature_group", "column_name", "non_null_count")


def members_of(columns: list[str]) -> list[tuple[str, str]]:
    found = []
    for group, names in FEATURE_GROUPS.items():
        for c in columns:
            if group == "rfm":
                inside = any(c.startswith(n) and c[len(n):] in _RFM_WINDOWS for n in names)
            else:
                inside = c in names
            if inside:
                found.append((group, c))
    return found


def group_members(spark: SparkSession, columns: list[str]) -> DataFrame:
    return spark.createDataFrame(members_of(columns), "feature_group string, column_name string")


def _non_null_counts(df: DataFrame) -> DataFrame:
    names = sorted({c for _, c in members_of(df.columns)})
    counts = df.selectExpr(*[f"count({c}) AS {c}" for c in names])
    entries = ", ".join(f"struct('{c}' AS column_name, {c} AS non_null_count)" for c in names)
    return counts.selectExpr(f"inline(array({entries}))")
