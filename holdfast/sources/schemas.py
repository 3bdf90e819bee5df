"""Explicit schemas of the source tables. Ids may be strings or whole numbers."""

from __future__ import annotations

from pyspark.sql import types as T


_KINDS = {
    "string": T.StringType(),
    "date": T.DateType(),
    "int": T.IntegerType(),
    "boolean": T.BooleanType(),
    "double": T.DoubleType(),
    "timestamp_ntz": T.TimestampNTZType(),
    "decimal(5:2)": T.DecimalType(5, 2),
    "decimal(10:2)": T.DecimalType(10, 2),
}


def _schema(columns: str) -> T.StructType:
    """From ``name kind`` pairs; unlike DDL text this needs no running session."""
    pairs = [c.split() for c in columns.split(",")]
    return T.StructType([T.StructField(name, _KINDS[kind]) for name, kind in pairs])


CUSTOMERS = _schema(
    "customer_id string, registration_date date, account_status string, customer_tier string, "
    "country string, city string, age int, gender string, referral_source string, "
    "last_login_date date, is_premium boolean, subscription_type string, account_balance decimal(10:2)"
)
TRANSACTIONS = _schema(
    "transaction_id string, customer_id string, transaction_date timestamp_ntz, "
    "transaction_amount decimal(10:2), transaction_type string, payment_method string, "
    "product_category string, quantity int, discount_applied decimal(5:2), is_refunded boolean"
)
USER_EVENTS = _schema(
    "customer_id string, event_timestamp timestamp_ntz, event_type string, "
    "session_id string, time_spent_seconds double"
)
SUPPORT_TICKETS = _schema(
    "ticket_id string, customer_id string, created_date timestamp_ntz, status string, "
    "issue_category string, resolution_time_hours decimal(10:2)"
)
SUBSCRIPTION_HISTORY = _schema(
    "subscription_id string, customer_id string, subscription_start_date date, "
    "subscription_end_date date, subscription_type string, monthly_fee decimal(10:2), "
    "payment_frequency string, auto_renewal_enabled boolean, upgrade_count int, "
    "downgrade_count int, cancellation_date date, reactivation_count int"
)
CHURN_PREDICTIONS = _schema(
    "customer_id string, churn_probability double, risk_category string, "
    "prediction_date date, prediction_timestamp timestamp_ntz"
)

SOURCES: dict[str, T.StructType] = {
    "customers": CUSTOMERS,
    "transactions": TRANSACTIONS,
    "user_events": USER_EVENTS,
    "support_tickets": SUPPORT_TICKETS,
    "subscription_history": SUBSCRIPTION_HISTORY,
}
