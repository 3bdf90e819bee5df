"""DuckDB text of the fixture views and of the feature groups, as named CTEs."""

from __future__ import annotations

ORDERS = "TIMESTAMP '2001-08-02 00:00:00'"
EVENTS = "TIMESTAMP '2024-01-31 00:00:00'"
LABEL = "TIMESTAMP '2000-08-02 00:00:00'"
WINDOWS = (7, 14, 30, 60, 90, 180, 365)

VIEWS = {
    "customers": """
SELECT c.c_custkey AS customer_id,
  DATE '2001-08-02' - CAST((c.c_custkey*37)%730 AS INT) AS registration_date,
  CASE WHEN c.c_custkey%10=0 THEN 'churned' WHEN c.c_custkey%10=1 THEN 'at_risk' ELSE 'active' END AS account_status,
  c.c_mktsegment AS customer_tier, n.n_name AS country,
  CASE WHEN c.c_custkey%17=0 THEN NULL ELSE CAST(16+(c.c_custkey*7)%90 AS INT) END AS age,
  CASE WHEN c.c_custkey%11=0 THEN NULL WHEN c.c_custkey%2=0 THEN 'F' ELSE 'M' END AS gender,
  CASE WHEN c.c_custkey%3=0 THEN 'organic' WHEN c.c_custkey%3=1 THEN 'ads' ELSE 'partner' END AS referral_source,
  DATE '2001-08-02' - CAST((c.c_custkey*13)%120 AS INT) AS last_login_date,
  c.c_acctbal > 5000 AS is_premium,
  CASE WHEN c.c_custkey%4=0 THEN 'basic' WHEN c.c_custkey%4=1 THEN 'plus' ELSE 'pro' END AS subscription_type,
  c.c_acctbal AS account_balance,
  CAST((c.c_custkey*37)%730 AS INT) AS customer_age_days,
  CAST((c.c_custkey*13)%120 AS INT) AS days_since_last_login
FROM customer c JOIN nation n ON c.c_nationkey=n.n_nationkey""",
    "transactions": """
SELECT o.o_custkey AS customer_id, o.o_orderkey AS transaction_id,
  o.o_orderdate + to_hours(CAST(o.o_orderkey%24 AS INT)) AS transaction_date,
  o.o_totalprice AS transaction_amount, o.o_orderpriority AS payment_method, o.o_orderstatus AS transaction_type
FROM orders o""",
    "transaction_lines": """
SELECT o.o_custkey AS customer_id, o.o_orderkey AS transaction_id,
  o.o_orderdate + to_hours(CAST(o.o_orderkey%24 AS INT)) AS transaction_date, p.p_type AS product_category,
  CAST(l.l_quantity AS INT) AS quantity, l.l_discount AS discount_applied, l.l_returnflag='R' AS is_refunded
FROM lineitem l JOIN orders o ON l.l_orderkey=o.o_orderkey JOIN part p ON l.l_partkey=p.p_partkey""",
    "user_events": """
SELECT user_id AS customer_id, ts AS event_timestamp, value AS time_spent_seconds,
  CASE event_type WHEN 'view' THEN 'page_view' WHEN 'signup' THEN 'search'
                  WHEN 'purchase' THEN 'add_to_cart' ELSE event_type END AS event_type
FROM events""",
    "support_tickets": """
SELECT event_id AS ticket_id, user_id AS customer_id, ts AS created_date,
  CASE WHEN event_id%3=0 THEN 'resolved' WHEN event_id%3=1 THEN 'open' ELSE 'pending' END AS status,
  concat('cat_', CAST(CAST(json_extract_string(props,'$.k') AS INT)%5 AS VARCHAR)) AS issue_category,
  value AS resolution_time_hours
FROM events WHERE event_type='error'""",
    "subscription_history": """
SELECT o_orderkey AS subscription_id, o_custkey AS customer_id, CAST(o_orderdate AS DATE) AS subscription_start_date,
  CASE WHEN o_orderstatus='P' THEN NULL ELSE o_totalprice/12 END AS monthly_fee,
  CASE WHEN o_orderstatus='P' THEN NULL ELSE o_orderstatus='O' END AS auto_renewal_enabled,
  CAST(o_orderkey%4 AS INT) AS upgrade_count, CAST(o_orderkey%3 AS INT) AS downgrade_count,
  CAST(o_orderkey%2 AS INT) AS reactivation_count
FROM orders""",
}


def money_sum(column: str) -> str:
    return f"CAST(sum(CAST({column} AS DECIMAL(18,2))) AS DOUBLE)"


def rfm_window(days: int, as_of: str) -> str:
    p = f"{days}d"
    return f"""
SELECT customer_id, count(*) AS transaction_count_{p}, {money_sum('transaction_amount')} AS total_spent_{p},
  {money_sum('transaction_amount')}/count(*) AS avg_transaction_{p},
  stddev_samp(transaction_amount) AS std_transaction_{p}, min(transaction_amount) AS min_transaction_{p},
  max(transaction_amount) AS max_transaction_{p},
  CAST(date_sub('day', max(transaction_date), {as_of}) AS INT) AS recency_days_{p}
FROM transactions
WHERE transaction_date >= {as_of} - INTERVAL {days} DAY AND transaction_date < {as_of}
GROUP BY customer_id"""


def rfm(as_of: str) -> dict[str, str]:
    ctes = {f"w{d}": rfm_window(d, as_of) for d in WINDOWS}
    joins = " ".join(f"LEFT JOIN w{d} USING (customer_id)" for d in WINDOWS if d != 365)
    ctes["rfm"] = f"SELECT * FROM w365 {joins}"
    return ctes


def transaction_groups(as_of: str | None) -> dict[str, str]:
    """Diversity, refunds and regularity over the last 365 days, or over everything."""
    kept = (
        "" if as_of is None
        else f"WHERE transaction_date >= {as_of} - INTERVAL 365 DAY AND transaction_date < {as_of}"
    )
    return {
        "tx": f"SELECT * FROM transactions {kept}",
        "tl": f"SELECT * FROM transaction_lines {kept}",
        "diversity": """
SELECT customer_id, payment_method_count, product_category_count
FROM (SELECT customer_id, count(DISTINCT payment_method) AS payment_method_count FROM tx GROUP BY 1)
FULL JOIN (SELECT customer_id, count(DISTINCT product_category) AS product_category_count FROM tl GROUP BY 1)
USING (customer_id)""",
        "refunds": """
SELECT customer_id, CAST(sum(CAST(is_refunded AS INT)) AS BIGINT) AS total_refunds,
  avg(CAST(is_refunded AS INT)) AS refund_rate,
  CAST(sum(CAST(discount_applied AS DECIMAL(18,2))) AS DOUBLE)/count(discount_applied) AS avg_discount_rate,
  CAST(sum(quantity) AS BIGINT) AS total_quantity, avg(quantity) AS avg_quantity
FROM tl GROUP BY 1""",
        "gaps": """
SELECT customer_id, transaction_id, transaction_date,
  CAST(date_sub('day', lag(transaction_date) OVER w, transaction_date) AS INT) AS days_between_transactions
FROM tx WINDOW w AS (PARTITION BY customer_id ORDER BY transaction_date, transaction_id)""",
        "regularity": """
SELECT customer_id, avg(days_between_transactions) AS avg_days_between_transactions,
  stddev_samp(days_between_transactions) AS std_days_between_transactions,
  stddev_samp(days_between_transactions)/(avg(days_between_transactions)+1) AS transaction_regularity_cv
FROM gaps GROUP BY 1""",
    }


def activity_groups() -> dict[str, str]:
    """Sessions, engagement and support; all fixture events lie within the lookback."""
    return {
        "marked": """
SELECT *, CASE WHEN lag(event_timestamp) OVER w IS NULL
    OR event_timestamp - lag(event_timestamp) OVER w > INTERVAL 30 MINUTE THEN 1 ELSE 0 END AS opens
FROM user_events WINDOW w AS (PARTITION BY customer_id ORDER BY event_timestamp)""",
        "engagement": """
SELECT customer_id, count(*) AS total_events, count(DISTINCT event_type) AS unique_event_type_count,
  count(*) FILTER (event_type='page_view') AS page_views, count(*) FILTER (event_type='click') AS clicks,
  count(*) FILTER (event_type='search') AS searches, count(*) FILTER (event_type='add_to_cart') AS add_to_cart,
  CAST(sum(opens) AS BIGINT) AS session_count,
  CAST(sum(CAST(time_spent_seconds AS DECIMAL(28,9))) AS DOUBLE) AS total_time_spent,
  max(event_timestamp) AS last_event_date
FROM marked GROUP BY 1""",
        "support": """
SELECT customer_id, count(*) AS support_ticket_count,
  count(*) FILTER (status='resolved') AS resolved_tickets, count(*) FILTER (status='open') AS open_tickets,
  CAST(sum(CAST(resolution_time_hours AS DECIMAL(18,2))) AS DOUBLE)/count(resolution_time_hours) AS avg_resolution_time,
  max(created_date) AS last_ticket_date, count(DISTINCT issue_category) AS unique_issue_categories
FROM support_tickets GROUP BY 1""",
    }


ENGAGEMENT_RATES = {
    "page_view_rate": "page_views/(total_events+1)",
    "click_rate": "clicks/(page_views+1)",
    "search_rate": "searches/(total_events+1)",
    "cart_conversion_rate": "add_to_cart/(page_views+1)",
    "avg_time_per_session": "total_time_spent/(session_count+1)",
    "engagement_score": "CAST(0.3*total_events+0.2*page_views+0.2*clicks+0.15*searches+0.15*add_to_cart AS DOUBLE)",
}
SUPPORT_RATES = {
    "support_resolution_rate": "resolved_tickets/(support_ticket_count+1)",
    "support_open_rate": "open_tickets/(support_ticket_count+1)",
    "days_since_last_ticket": f"CAST(date_sub('day', last_ticket_date, {EVENTS}) AS INT)",
}
RFM_TRENDS = {
    "spending_trend_30_90": "total_spent_30d/(total_spent_90d+1)",
    "frequency_trend_30_90": "transaction_count_30d/(transaction_count_90d+1)",
    "recency_change_30_90": "recency_days_30d-recency_days_90d",
}


def latest(as_of: str) -> str:
    def newest(column: str) -> str:
        return (
            f"max_by({column}, (subscription_start_date, subscription_id)) "
            f"FILTER (WHERE {column} IS NOT NULL) AS {column}"
        )

    columns = ",\n  ".join(
        newest(c)
        for c in ("monthly_fee", "auto_renewal_enabled", "upgrade_count", "downgrade_count", "reactivation_count")
    )
    return f"""
SELECT customer_id, CAST(CAST({as_of} AS DATE) - max(subscription_start_date) AS INT) AS subscription_tenure_days,
  {columns}
FROM subscription_history WHERE subscription_start_date < CAST({as_of} AS DATE) GROUP BY 1"""


STABILITY = {
    "upgrade_downgrade_ratio": "upgrade_count/(downgrade_count+1)",
    "subscription_stability_score": "CAST(0.4*subscription_tenure_days AS DOUBLE)"
    "+30*CAST(auto_renewal_enabled AS INT)+15*(upgrade_count/(downgrade_count+1))",
}
TEMPORAL = {
    "registration_day_of_week": "CAST(isodow(registration_date)-1 AS INT)",
    "registration_month": "CAST(month(registration_date) AS INT)",
    "registration_quarter": "CAST(quarter(registration_date) AS INT)",
    "login_frequency_score": "365/(days_since_last_login+1)",
    "customer_lifecycle_stage": """CASE WHEN customer_age_days > 0 AND customer_age_days <= 30 THEN 'new'
    WHEN customer_age_days > 30 AND customer_age_days <= 90 THEN 'growing'
    WHEN customer_age_days > 90 AND customer_age_days <= 180 THEN 'established'
    WHEN customer_age_days > 180 AND customer_age_days <= 365 THEN 'mature'
    WHEN customer_age_days > 365 THEN 'veteran' END""",
}
AGE_GROUP = """CASE WHEN age <= 0 THEN NULL WHEN age <= 18 THEN '<18' WHEN age <= 25 THEN '18-24'
    WHEN age <= 35 THEN '25-34' WHEN age <= 45 THEN '35-44' WHEN age <= 55 THEN '45-54'
    WHEN age <= 65 THEN '55-64' WHEN age <= 100 THEN '65+' END"""
VALUE = {
    "estimated_clv": "total_spent_365d/(customer_age_days+1)*365*2",
    "activity_decline_30_90": "(transaction_count_90d-3*transaction_count_30d)/(transaction_count_90d+1)",
    "engagement_per_day": "total_events/(customer_age_days+1)",
    "is_multi_channel": "CASE WHEN payment_method_count > 1 THEN 1 ELSE 0 END",
}
FLAGS = {
    "high_recency_flag": "CASE WHEN recency_days_30d > 30 THEN 1 ELSE 0 END",
    "declining_frequency_flag": "CASE WHEN frequency_trend_30_90 < 0.5 THEN 1 ELSE 0 END",
    "declining_spending_flag": "CASE WHEN spending_trend_30_90 < 0.5 THEN 1 ELSE 0 END",
}
ENCODED = ("gender", "country", "customer_tier", "subscription_type", "referral_source", "customer_lifecycle_stage")


def exprs(columns: dict[str, str]) -> str:
    return ",\n  ".join(f"{e} AS {name}" for name, e in columns.items())


def frequency(column: str, source: str) -> str:
    return f"""
SELECT {column}, count(*)/(SELECT count({column}) FROM {source}) AS {column}_frequency
FROM {source} WHERE {column} IS NOT NULL GROUP BY 1"""


def feature_ctes() -> dict[str, str]:
    """Everything up to ``features``, the wide table before filling."""
    ctes = rfm(ORDERS) | transaction_groups(ORDERS) | activity_groups()
    ctes["latest"] = latest(ORDERS)
    ctes["joined"] = f"""
SELECT *, {exprs(RFM_TRENDS)}, {exprs(ENGAGEMENT_RATES)}, {exprs(SUPPORT_RATES)}, {exprs(STABILITY)}, {exprs(TEMPORAL)}
FROM customers LEFT JOIN rfm USING (customer_id) LEFT JOIN diversity USING (customer_id)
LEFT JOIN refunds USING (customer_id) LEFT JOIN regularity USING (customer_id)
LEFT JOIN engagement USING (customer_id) LEFT JOIN support USING (customer_id) LEFT JOIN latest USING (customer_id)"""
    ctes["flagged"] = f"SELECT *, {exprs(VALUE)}, {exprs(FLAGS)}, {AGE_GROUP} AS age_group FROM joined"
    for c in ENCODED:
        ctes[f"f_{c}"] = frequency(c, "joined")
    joins = "\n".join(f"LEFT JOIN f_{c} USING ({c})" for c in ENCODED)
    ctes["features"] = f"""
SELECT *, CASE WHEN total_spent_365d > (SELECT quantile_cont(total_spent_365d, 0.75) FROM joined)
    THEN 1 ELSE 0 END AS is_high_value,
  0.3::DOUBLE*high_recency_flag + 0.3::DOUBLE*declining_frequency_flag + 0.2::DOUBLE*declining_spending_flag
    + 0.2::DOUBLE*(1 - login_frequency_score/(SELECT max(login_frequency_score) FROM joined)) AS preliminary_risk_score
FROM flagged {joins}"""
    return ctes


def sql(body: str, views: tuple[str, ...] = (), ctes: dict[str, str] | None = None) -> str:
    named = {v: VIEWS[v] for v in views} | (ctes or {})
    if not named:
        return body
    return "WITH " + ",\n".join(f"{name} AS ({text})" for name, text in named.items()) + "\n" + body


ALL_VIEWS = tuple(VIEWS)


def rounded(column: str, digits: int = 6) -> str:
    return f"round({column}, {digits}) AS {column}"
