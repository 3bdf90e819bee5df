"""The source tables as views over the test tables, which lack some columns.

Columns the test tables do not have are arithmetic on the key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

ORDERS_AS_OF = "2001-08-02 00:00:00"
EVENTS_AS_OF = "2024-01-31 00:00:00"
LABEL_AS_OF = "2000-08-02 00:00:00"
LABEL_HORIZON_DAYS = 365


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def customers(spark: SparkSession, folder: str) -> DataFrame:
    c = table(spark, folder, "customer")
    n = table(spark, folder, "nation")
    return c.join(n, c.c_nationkey == n.n_nationkey).selectExpr(
        "c_custkey AS customer_id",
        "DATE '2001-08-02' - CAST((c_custkey * 37) % 730 AS INT) AS registration_date",
        "CASE c_custkey % 10 WHEN 0 THEN 'churned' WHEN 1 THEN 'at_risk' ELSE 'active' END AS account_status",
        "c_mktsegment AS customer_tier",
        "n_name AS country",
        "CASE WHEN c_custkey % 17 <> 0 THEN CAST(16 + (c_custkey * 7) % 90 AS INT) END AS age",
        "CASE WHEN c_custkey % 11 = 0 THEN NULL WHEN c_custkey % 2 = 0 THEN 'F' ELSE 'M' END AS gender",
        "CASE c_custkey % 3 WHEN 0 THEN 'organic' WHEN 1 THEN 'ads' ELSE 'partner' END AS referral_source",
        "DATE '2001-08-02' - CAST((c_custkey * 13) % 120 AS INT) AS last_login_date",
        "c_acctbal > 5000 AS is_premium",
        "CASE c_custkey % 4 WHEN 0 THEN 'basic' WHEN 1 THEN 'plus' ELSE 'pro' END AS subscription_type",
        "c_acctbal AS account_balance",
    )


def transactions(spark: SparkSession, folder: str) -> DataFrame:
    """Order grain. Hours are added so that elapsed days differ from calendar days."""
    return table(spark, folder, "orders").selectExpr(
        "o_custkey AS customer_id",
        "o_orderkey AS transaction_id",
        "o_orderdate + make_dt_interval(0, CAST(o_orderkey % 24 AS INT), 0, 0) AS transaction_date",
        "o_totalprice AS transaction_amount",
        "o_orderpriority AS payment_method",
        "o_orderstatus AS transaction_type",
    )


def transaction_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Line grain: product categories, refunds, discounts, quantities."""
    li = table(spark, folder, "lineitem")
    o = table(spark, folder, "orders")
    p = table(spark, folder, "part")
    return (
        li.join(o, li.l_orderkey == o.o_orderkey)
        .join(p, li.l_partkey == p.p_partkey)
        .selectExpr(
            "o_custkey AS customer_id",
            "o_orderkey AS transaction_id",
            "o_orderdate + make_dt_interval(0, CAST(o_orderkey % 24 AS INT), 0, 0) AS transaction_date",
            "p_type AS product_category",
            "CAST(l_quantity AS INT) AS quantity",
            "l_discount AS discount_applied",
            "l_returnflag = 'R' AS is_refunded",
        )
    )


def user_events(spark: SparkSession, folder: str) -> DataFrame:
    return as_user_events(table(spark, folder, "events"))


def as_user_events(events: DataFrame) -> DataFrame:
    """No session ids: sessions come from the gap rule. Works on a stream as well."""
    return events.selectExpr(
        "user_id AS customer_id",
        "ts AS event_timestamp",
        "CASE event_type WHEN 'view' THEN 'page_view' WHEN 'signup' THEN 'search' "
        "WHEN 'purchase' THEN 'add_to_cart' ELSE event_type END AS event_type",
        "value AS time_spent_seconds",
    )


def support_tickets(spark: SparkSession, folder: str) -> DataFrame:
    return (
        table(spark, folder, "events")
        .where("event_type = 'error'")
        .selectExpr(
            "event_id AS ticket_id",
            "user_id AS customer_id",
            "ts AS created_date",
            "CASE event_id % 3 WHEN 0 THEN 'resolved' WHEN 1 THEN 'open' ELSE 'pending' END AS status",
            "concat('cat_', CAST(CAST(get_json_object(props, '$.k') AS INT) % 5 AS STRING)) AS issue_category",
            "value AS resolution_time_hours",
        )
    )


def subscription_history(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "orders").selectExpr(
        "o_orderkey AS subscription_id",
        "o_custkey AS customer_id",
        "CAST(o_orderdate AS DATE) AS subscription_start_date",
        "CASE WHEN o_orderstatus <> 'P' THEN o_totalprice / 12 END AS monthly_fee",
        "CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus = 'O' END AS auto_renewal_enabled",
        "CAST(o_orderkey % 4 AS INT) AS upgrade_count",
        "CAST(o_orderkey % 3 AS INT) AS downgrade_count",
        "CAST(o_orderkey % 2 AS INT) AS reactivation_count",
    )


def all_tables(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    return {
        "customers": customers(spark, folder),
        "transactions": transactions(spark, folder),
        "transaction_lines": transaction_lines(spark, folder),
        "user_events": user_events(spark, folder),
        "support_tickets": support_tickets(spark, folder),
        "subscription_history": subscription_history(spark, folder),
    }
