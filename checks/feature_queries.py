"""Queries over sources, feature groups and the feature table, each with its SQL."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import views as v
from checks.registry import query
from checks.views import ALL_VIEWS, exprs, rounded, sql
from holdfast.functions.columns import expressions
from holdfast.operators import customer, engagement, impute, rfm, subscription, support
from holdfast.operators import transactions as behaviour
from holdfast.plans import features as plan
from holdfast.session import scratch_path
from holdfast.sources import fixtures as fx
from holdfast.sources import scans, snapshots

AS_OF, ACTIVITY = fx.ORDERS_AS_OF, fx.EVENTS_AS_OF


# columns whose last bits depend on the order of summation or of the terms
ORDER_DEPENDENT = {
    *[f"std_transaction_{d}d" for d in v.WINDOWS],
    "avg_days_between_transactions",
    "std_days_between_transactions",
    "transaction_regularity_cv",
    "engagement_score",
    "subscription_stability_score",
    "preliminary_risk_score",
}


def tidy(df: DataFrame, columns: set[str] = ORDER_DEPENDENT, digits: int = 4) -> DataFrame:
    """Round the given double columns; all others compare bit by bit."""
    return df.selectExpr(*[rounded(c, digits) if c in columns else f"`{c}`" for c in df.columns])


def tidy_sql(columns, rounded_columns: set[str] = ORDER_DEPENDENT, digits: int = 4) -> str:
    return ", ".join(rounded(c, digits) if c in rounded_columns else c for c in columns)


def profiles(spark: SparkSession, folder: str, as_of: str = AS_OF) -> DataFrame:
    """All customers: neither the registration lookback nor the status filter."""
    return scans.scan_customer_profiles(fx.customers(spark, folder), as_of, None, None)


def features(spark: SparkSession, folder: str) -> DataFrame:
    return plan.build_features(profiles(spark, folder), fx.all_tables(spark, folder), AS_OF, ACTIVITY)


def customer_rows(spark: SparkSession, folder: str) -> int:
    return fx.table(spark, folder, "customer").count()


# ---------------------------------------------------------------- sources

PROFILE_COLUMNS = (
    "customer_id, registration_date, account_status, customer_tier, country, age, gender, referral_source, "
    "last_login_date, is_premium, subscription_type, account_balance, customer_age_days, days_since_last_login"
)


@query(sql(
    f"""SELECT {PROFILE_COLUMNS} FROM customers
    WHERE registration_date >= CAST({v.ORDERS} AS DATE) - 365 AND account_status IN ('active', 'at_risk')""",
    ("customers",),
))
def scan_customer_profiles(spark, folder):
    return scans.scan_customer_profiles(fx.customers(spark, folder), AS_OF)


@query(sql(
    f"""SELECT * FROM transactions
    WHERE transaction_date >= {v.ORDERS} - INTERVAL 365 DAY AND transaction_date < {v.ORDERS}""",
    ("transactions",),
))
def scan_transactions(spark, folder):
    return scans.scan_transactions(fx.transactions(spark, folder), AS_OF)


@query(sql(
    "SELECT * FROM subscription_history WHERE subscription_start_date IS NOT NULL",
    ("subscription_history",),
))
def scan_subscription_history(spark, folder):
    return scans.scan_subscription_history(fx.subscription_history(spark, folder))


@query(sql(
    f"""
SELECT 'customers' AS source, count(*) AS row_count FROM customers
WHERE registration_date >= CAST({v.ORDERS} AS DATE) - 365 AND account_status IN ('active', 'at_risk')
UNION ALL SELECT 'transactions', count(*) FROM transactions
WHERE transaction_date >= {v.ORDERS} - INTERVAL 365 DAY AND transaction_date < {v.ORDERS}
UNION ALL SELECT 'user_events', count(*) FROM user_events
WHERE event_timestamp >= {v.EVENTS} - INTERVAL 365 DAY AND event_timestamp < {v.EVENTS}
UNION ALL SELECT 'support_tickets', count(*) FROM support_tickets
WHERE created_date >= {v.EVENTS} - INTERVAL 365 DAY AND created_date < {v.EVENTS}
UNION ALL SELECT 'subscription_history', count(*) FROM subscription_history
WHERE subscription_start_date < CAST({v.ORDERS} AS DATE)""",
    ALL_VIEWS,
))
def source_row_counts(spark, folder):
    return scans.source_row_counts(scans.collect_sources(fx.all_tables(spark, folder), AS_OF, ACTIVITY))


@query(sql(
    "SELECT *, '20010802_000000' AS snapshot_ts FROM transactions", ("transactions",)
))
def snapshot_roundtrip(spark, folder):
    path = scratch_path(spark, "snapshots")
    snapshots.write_snapshot(fx.transactions(spark, folder), path, datetime(2001, 8, 2))
    return snapshots.read_snapshots(spark, path)


@query(sql(
    "SELECT *, '20010802_000000' AS snapshot_ts FROM customers", ("customers",)
))
def latest_snapshot(spark, folder):
    path = scratch_path(spark, "snapshots")
    for moment in (datetime(2000, 8, 2), datetime(2001, 8, 2)):
        snapshots.write_snapshot(profiles(spark, folder, moment.isoformat(sep=" ")), path, moment)
    return snapshots.latest_snapshot(spark, path)


# ---------------------------------------------------------------- RFM and transactions

_RFM_OUT = tidy_sql(
    ["customer_id"]
    + [
        f"{c}_{d}d"
        for d in v.WINDOWS
        for c in ("transaction_count", "total_spent", "avg_transaction", "std_transaction",
                  "min_transaction", "max_transaction", "recency_days")
    ]
)


@query(sql(f"SELECT {_RFM_OUT} FROM rfm", ("transactions",), v.rfm(v.ORDERS)))
def rfm_multiwindow(spark, folder):
    return tidy(rfm.rfm_windows(fx.transactions(spark, folder), AS_OF))


@query(sql(
    f"SELECT customer_id, {exprs(v.RFM_TRENDS)} FROM rfm",
    ("transactions",), v.rfm(v.ORDERS),
))
def rfm_trends(spark, folder):
    windows = rfm.rfm_windows(fx.transactions(spark, folder), AS_OF)
    return tidy(rfm.rfm_trends(windows).select("customer_id", *rfm.TRENDS))


@query(sql("SELECT * FROM diversity", ("transactions", "transaction_lines"), v.transaction_groups(None)))
def payment_category_diversity(spark, folder):
    return behaviour.diversity(fx.transactions(spark, folder), fx.transaction_lines(spark, folder))


@query(sql(
    "SELECT * FROM refunds",
    ("transactions", "transaction_lines"), v.transaction_groups(None),
))
def refund_discount_stats(spark, folder):
    return tidy(behaviour.refund_discount_stats(fx.transaction_lines(spark, folder)))


@query(sql("SELECT * FROM gaps", ("transactions", "transaction_lines"), v.transaction_groups(None)))
def days_between_transactions(spark, folder):
    return behaviour.days_between_transactions(fx.transactions(spark, folder))


@query(sql(
    "SELECT customer_id, "
    + tidy_sql(["avg_days_between_transactions", "std_days_between_transactions", "transaction_regularity_cv"])
    + " FROM regularity",
    ("transactions", "transaction_lines"), v.transaction_groups(None),
))
def transaction_regularity(spark, folder):
    return tidy(behaviour.transaction_regularity(fx.transactions(spark, folder)))


# ---------------------------------------------------------------- engagement, support, subscriptions

_ACTIVITY_VIEWS = ("user_events", "support_tickets")


@query(sql("SELECT * FROM engagement", _ACTIVITY_VIEWS, v.activity_groups()))
def engagement_rollup(spark, folder):
    return tidy(engagement.engagement_rollup(scans.scan_events(fx.user_events(spark, folder), ACTIVITY)))


@query(sql(
    f"SELECT customer_id, {tidy_sql(v.ENGAGEMENT_RATES)} "
    f"FROM (SELECT customer_id, {exprs(v.ENGAGEMENT_RATES)} FROM engagement)",
    _ACTIVITY_VIEWS, v.activity_groups(),
))
def engagement_rates(spark, folder):
    rollup = engagement.engagement_rollup(scans.scan_events(fx.user_events(spark, folder), ACTIVITY))
    return tidy(engagement.engagement_rates(rollup).select("customer_id", *engagement.RATES))


@query(sql(
    """
SELECT customer_id, session_start, max(event_timestamp) AS session_end, count(*) AS event_count
FROM (SELECT *, max(CASE WHEN opens = 1 THEN event_timestamp END)
        OVER (PARTITION BY customer_id ORDER BY event_timestamp) AS session_start FROM marked)
GROUP BY ALL""",
    _ACTIVITY_VIEWS, v.activity_groups(),
))
def sessionize_events(spark, folder):
    return engagement.sessionize_events(fx.user_events(spark, folder))


@query(sql(
    "SELECT * FROM support",
    _ACTIVITY_VIEWS, v.activity_groups(),
))
def support_rollup(spark, folder):
    return tidy(support.support_rollup(scans.scan_tickets(fx.support_tickets(spark, folder), ACTIVITY)))


@query(sql(
    f"SELECT customer_id, {exprs(v.SUPPORT_RATES)} FROM support",
    _ACTIVITY_VIEWS, v.activity_groups(),
))
def support_features(spark, folder):
    rollup = support.support_rollup(scans.scan_tickets(fx.support_tickets(spark, folder), ACTIVITY))
    return tidy(
        support.support_features(rollup, ACTIVITY).select("customer_id", *support.rates(ACTIVITY))
    )


@query(sql(
    "SELECT * FROM latest",
    ("subscription_history",), {"latest": v.latest(v.ORDERS)},
))
def latest_subscription(spark, folder):
    history = scans.scan_subscription_history(fx.subscription_history(spark, folder), AS_OF)
    return tidy(subscription.latest_subscription(history, AS_OF))


@query(sql(
    f"SELECT customer_id, {tidy_sql(v.STABILITY)} "
    f"FROM (SELECT customer_id, {exprs(v.STABILITY)} FROM latest)",
    ("subscription_history",), {"latest": v.latest(v.ORDERS)},
))
def subscription_stability(spark, folder):
    history = scans.scan_subscription_history(fx.subscription_history(spark, folder), AS_OF)
    latest = subscription.latest_subscription(history, AS_OF)
    return tidy(
        subscription.subscription_stability(latest).select("customer_id", *subscription.STABILITY)
    )


# ---------------------------------------------------------------- customer columns

@query(sql(
    f"SELECT customer_id, {exprs(v.TEMPORAL)} FROM customers",
    ("customers",),
))
def temporal_features(spark, folder):
    out = customer.temporal_features(profiles(spark, folder))
    return tidy(out.select("customer_id", *customer.TEMPORAL))


@query(sql(
    "SELECT customer_lifecycle_stage, count(*) AS customers "
    f"FROM (SELECT {exprs(v.TEMPORAL)} FROM customers) GROUP BY 1",
    ("customers",),
))
def lifecycle_stage_counts(spark, folder):
    staged = customer.temporal_features(profiles(spark, folder))
    return staged.groupBy("customer_lifecycle_stage").agg(F.count("*").alias("customers"))


@query(sql(
    f"SELECT {v.AGE_GROUP} AS age_group, count(*) AS customers FROM customers GROUP BY 1", ("customers",)
))
def age_group_counts(spark, folder):
    grouped = customer.demographic_features(profiles(spark, folder))
    return grouped.groupBy("age_group").agg(F.count("*").alias("customers"))


@query(sql(
    "SELECT customer_id, " + ", ".join(f"{c}_frequency" for c in v.ENCODED) + " FROM staged "
    + " ".join(f"LEFT JOIN f_{c} USING ({c})" for c in v.ENCODED),
    ("customers",),
    {"staged": f"SELECT *, {exprs(v.TEMPORAL)} FROM customers"}
    | {f"f_{c}": v.frequency(c, "staged") for c in v.ENCODED},
))
def frequency_encoding(spark, folder):
    staged = customer.temporal_features(profiles(spark, folder))
    out = customer.frequency_encoding(staged)
    return tidy(out.select("customer_id", *[f"{c}_frequency" for c in customer.ENCODED]))


def _wide_check(*columns: str) -> str:
    """SQL for some columns of the feature table."""
    return sql(f"SELECT customer_id, {tidy_sql(columns)} FROM features", ALL_VIEWS, v.feature_ctes())


def _with_windows(spark, folder):
    windows = rfm.rfm_windows(fx.transactions(spark, folder), AS_OF)
    return profiles(spark, folder).join(windows, "customer_id", "left")


@query(_wide_check("total_spent_365d", "estimated_clv"))
def customer_value(spark, folder):
    valued = _with_windows(spark, folder).withColumn("estimated_clv", F.expr(customer.VALUE["estimated_clv"]))
    return valued.select("customer_id", "total_spent_365d", "estimated_clv")


@query(_wide_check("activity_decline_30_90", "engagement_per_day"))
def activity_decline(spark, folder):
    events = engagement.engagement_rollup(scans.scan_events(fx.user_events(spark, folder), ACTIVITY))
    wide = _with_windows(spark, folder).join(events, "customer_id", "left")
    columns = ("activity_decline_30_90", "engagement_per_day")
    return wide.selectExpr("customer_id", *[f"{customer.VALUE[c]} AS {c}" for c in columns])


@query(_wide_check("is_high_value", "is_multi_channel"))
def high_value_flag(spark, folder):
    wide = _with_windows(spark, folder)
    recent = scans.scan_transactions(fx.transactions(spark, folder), AS_OF)
    methods = behaviour.distinct_per_customer(recent, "payment_method", "payment_method_count")
    high = customer.high_value_flag(wide.select("total_spent_365d"), customer_rows(spark, folder))
    return wide.join(methods, "customer_id", "left").select(
        "customer_id",
        high.alias("is_high_value"),
        F.expr(customer.VALUE["is_multi_channel"]).alias("is_multi_channel"),
    )


@query(_wide_check(*v.FLAGS, "preliminary_risk_score"))
def preliminary_risk_score(spark, folder):
    base = profiles(spark, folder)
    wide = customer.temporal_features(rfm.rfm_trends(_with_windows(spark, folder)))
    wide = wide.withColumns(expressions(customer.RISK_FLAGS))
    score = customer.preliminary_risk_score(customer.top_login_score(base))
    return tidy(
        wide.select("customer_id", *customer.RISK_FLAGS, score.alias("preliminary_risk_score"))
    )


# ---------------------------------------------------------------- feature table

_INTEGRAL = {
    "customer_id", "registration_date", "account_status", "customer_tier", "country", "age", "gender",
    "referral_source", "last_login_date", "is_premium", "subscription_type", "customer_age_days",
    "days_since_last_login", "payment_method_count", "product_category_count", "total_refunds", "total_quantity",
    "total_events", "unique_event_type_count", "page_views", "clicks", "searches", "add_to_cart", "session_count",
    "last_event_date", "support_ticket_count", "resolved_tickets", "open_tickets", "last_ticket_date",
    "unique_issue_categories", "days_since_last_ticket", "subscription_tenure_days", "auto_renewal_enabled",
    "upgrade_count", "downgrade_count", "reactivation_count", "recency_change_30_90", "registration_day_of_week",
    "registration_month", "registration_quarter", "customer_lifecycle_stage", "is_multi_channel", "is_high_value",
    "high_recency_flag", "declining_frequency_flag", "declining_spending_flag", "age_group",
} | {f"transaction_count_{d}d" for d in v.WINDOWS} | {f"recency_days_{d}d" for d in v.WINDOWS}
_DOUBLES = (
    [f"{s}_{d}d" for d in v.WINDOWS for s in ("total_spent", "avg_transaction", "std_transaction", "min_transaction", "max_transaction")]
    + ["account_balance", "spending_trend_30_90", "frequency_trend_30_90", "refund_rate", "avg_discount_rate",
       "avg_quantity", "avg_days_between_transactions", "std_days_between_transactions", "transaction_regularity_cv",
       "total_time_spent", *v.ENGAGEMENT_RATES, "avg_resolution_time", "support_resolution_rate", "support_open_rate",
       "monthly_fee", *v.STABILITY, "login_frequency_score", "estimated_clv", "activity_decline_30_90",
       "engagement_per_day", "preliminary_risk_score"]
    + [f"{c}_frequency" for c in v.ENCODED]
)
_TABLE_OUT = tidy_sql(sorted(_INTEGRAL) + _DOUBLES)


@query(sql(f"SELECT {_TABLE_OUT} FROM features", ALL_VIEWS, v.feature_ctes()))
def feature_table(spark, folder):
    return tidy(features(spark, folder))


_ZERO = ("count", "total", "sum", "rate", "score", "days_since")
_DATES = {"registration_date", "last_login_date", "last_event_date", "last_ticket_date"}
_TEXTS = {
    "account_status", "customer_tier", "country", "gender", "referral_source", "subscription_type",
    "customer_lifecycle_stage", "age_group",
}
_BOOLEANS = {"is_premium", "auto_renewal_enabled"}
_NUMBERS = sorted((_INTEGRAL | set(_DOUBLES)) - _DATES - _TEXTS - _BOOLEANS - {"customer_id"})
_MEDIANS = [c for c in _NUMBERS if not any(p in c for p in _ZERO)]


def _filled(column: str) -> str:
    if column in _TEXTS:
        return f"coalesce({column}, 'unknown') AS {column}"
    if column in _BOOLEANS:
        return f"coalesce({column}, false) AS {column}"
    if column in _MEDIANS:
        digits = 4 if column in ORDER_DEPENDENT else 6
        return f"round(coalesce(CAST({column} AS DOUBLE), (SELECT median({column}) FROM features)), {digits}) AS {column}"
    if column in _DOUBLES:
        value = f"coalesce({column}, 0)"
        return f"{f'round({value}, 4)' if column in ORDER_DEPENDENT else value} AS {column}"
    if column in _NUMBERS:
        return f"coalesce({column}, 0) AS {column}"
    return column


@query(sql(
    f"SELECT {', '.join(_filled(c) for c in sorted(_INTEGRAL) + _DOUBLES)} FROM features", ALL_VIEWS, v.feature_ctes()
))
def impute_features(spark, folder):
    wide = features(spark, folder)
    filled = impute.impute(wide, impute.fit_fill_values(wide, customer_rows(spark, folder)))
    return tidy(tidy(filled), set(_MEDIANS) - ORDER_DEPENDENT, 6)


@query(sql(
    " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, round(CAST(median({c}) AS DOUBLE), 4) AS median FROM features" for c in _MEDIANS
    ),
    ALL_VIEWS, v.feature_ctes() | {},
))
def feature_medians(spark, folder):
    medians = impute.feature_medians(features(spark, folder), customer_rows(spark, folder))
    return tidy(spark.createDataFrame(sorted(medians.items()), "column_name string, median double"), {"median"})


@query(sql(
    " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) - count({c}) AS null_count FROM features"
        for c in sorted(_INTEGRAL) + _DOUBLES
    ),
    ALL_VIEWS, v.feature_ctes(),
))
def null_profile(spark, folder):
    return impute.null_profile(features(spark, folder))


_MEMBERS = (
    [("rfm", f"{s}_{d}d") for s in ("recency_days", "transaction_count", "total_spent", "avg_transaction") for d in (30, 90, 365)]
    + [("engagement", c) for c in ("page_views", "clicks", "searches", "engagement_score", "page_view_rate", "click_rate")]
    + [("support", c) for c in ("support_ticket_count", "support_resolution_rate", "days_since_last_ticket")]
    + [("subscription", c) for c in ("subscription_tenure_days", "auto_renewal_enabled", "upgrade_downgrade_ratio")]
    + [("behavioral", c) for c in ("activity_decline_30_90", "preliminary_risk_score", "estimated_clv")]
    + [("demographic", c) for c in ("age", "gender_frequency", "country_frequency", "customer_tier_frequency")]
)


@query(sql(
    " UNION ALL ".join(
        f"SELECT '{g}' AS feature_group, '{c}' AS column_name, count({c}) AS non_null_count FROM features"
        for g, c in _MEMBERS
    ),
    ALL_VIEWS, v.feature_ctes(),
))
def feature_group_summary(spark, folder):
    return plan.feature_group_summary(features(spark, folder))
