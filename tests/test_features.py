"""Hand-made rows for the behaviours that are easy to get wrong."""

from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from holdfast.functions.columns import expressions
from holdfast.operators import customer, impute, rfm, subscription
from holdfast.operators import transactions as behaviour
from holdfast.operators.rfm import LOOKBACKS
from holdfast.sources import fixtures as fx
from holdfast.sources import scans

AS_OF = datetime(2001, 8, 2)


def tx(spark, rows):
    return spark.createDataFrame(rows, "customer_id long, transaction_date timestamp_ntz, transaction_amount double")


def test_window_edges(spark):
    rows = [
        (1, AS_OF - timedelta(days=30), 10.0),  # inside
        (2, AS_OF - timedelta(days=30, microseconds=1), 10.0),  # outside 30, inside 60
        (3, AS_OF, 10.0),  # not before as_of
    ]
    got = {r["customer_id"]: r for r in rfm.rfm_windows(tx(spark, rows), AS_OF).collect()}
    assert got[1]["transaction_count_30d"] == 1 and got[1]["recency_days_30d"] == 30
    assert got[2]["transaction_count_30d"] is None and got[2]["transaction_count_60d"] == 1
    assert 3 not in got


def test_single_transaction_has_no_std_and_quiet_customers_no_flags(spark):
    rows = [(1, AS_OF - timedelta(days=40), 100.0)]
    windows = rfm.rfm_trends(rfm.rfm_windows(tx(spark, rows), AS_OF)).withColumns(expressions(customer.RISK_FLAGS))
    r = windows.first()
    assert r["std_transaction_60d"] is None and r["total_spent_30d"] is None
    assert r["frequency_trend_30_90"] is None and r["spending_trend_30_90"] is None
    assert (r["declining_frequency_flag"], r["declining_spending_flag"], r["high_recency_flag"]) == (0, 0, 0)


def test_one_pass_equals_seven_filtered_passes(spark, sf):
    t = fx.transactions(spark, sf)
    whole = rfm.rfm_windows(t, AS_OF)
    for p in LOOKBACKS:
        names = [c for c in whole.columns if c.endswith(f"_{p}d")]
        got = {tuple(r) for r in whole.where(F.col(f"transaction_count_{p}d").isNotNull()).select("customer_id", *names).collect()}
        alone = rfm.rfm_windows(t, AS_OF, (p,)).select("customer_id", *names).collect()
        assert {r[0] for r in got} == {r[0] for r in alone}
        a = {r[0]: r for r in got}
        for r in alone:
            assert list(r) == pytest.approx(list(a[r[0]]), nan_ok=True) if None not in r else list(r) == list(a[r[0]])


def test_one_scan_and_one_exchange(spark, sf):
    plan = rfm.rfm_windows(fx.transactions(spark, sf), AS_OF)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1
    assert plan.count("Exchange hashpartitioning") == 1
    assert "SortAggregate" not in plan and "Window" not in plan


def test_hash_aggregate_for_latest_subscription(spark, sf):
    history = scans.scan_subscription_history(fx.subscription_history(spark, sf), AS_OF)
    plan = subscription.latest_subscription(history, AS_OF)._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and plan.count("Exchange hashpartitioning") == 1


def test_profile_filter_reaches_the_scan(spark, sf, tmp_path):
    path = str(tmp_path / "customers")
    fx.customers(spark, sf).write.parquet(path)
    plan = scans.scan_customer_profiles(spark.read.parquet(path), AS_OF)._jdf.queryExecution().executedPlan().toString()
    pushed = plan[plan.index("PushedFilters"):]
    assert "GreaterThanOrEqual(registration_date" in pushed and "In(account_statu" in pushed


def test_latest_value_is_per_column(spark):
    schema = (
        "subscription_id {id}, customer_id long, subscription_start_date date, monthly_fee double, "
        "auto_renewal_enabled boolean, upgrade_count int, downgrade_count int, reactivation_count int"
    )
    rows = [
        (1, 1, date(2001, 1, 1), 5.0, True, 1, 0, 0),
        (2, 1, date(2001, 6, 1), None, None, 2, 0, 0),
        (3, 1, date(2001, 6, 1), None, None, 3, 0, 0),  # tie on the start: larger id wins
        (4, 2, date(2001, 6, 1), None, None, 0, 0, 0),
    ]
    for kind, convert in (("long", int), ("string", str)):
        df = spark.createDataFrame([(convert(r[0]), *r[1:]) for r in rows], schema.format(id=kind))
        got = {r["customer_id"]: r for r in subscription.latest_subscription(df, AS_OF).collect()}
        assert (got[1]["monthly_fee"], got[1]["auto_renewal_enabled"], got[1]["upgrade_count"]) == (5.0, True, 3)
        assert got[1]["subscription_tenure_days"] == 62
        scored = subscription.subscription_stability(subscription.latest_subscription(df, AS_OF))
        assert scored.where("customer_id = 2").first()["subscription_stability_score"] is None


def test_bins_are_right_closed(spark):
    ages = spark.createDataFrame([(a,) for a in (0, 18, 25, 26, 100, 101, None)], "age int")
    groups = [r["age_group"] for r in customer.demographic_features(ages).collect()]
    assert groups == [None, "<18", "18-24", "25-34", "65+", None, None]
    days = spark.createDataFrame([(d,) for d in (0, 30, 31, 365, 366)], "customer_age_days int")
    stages = days.selectExpr(f"{customer.TEMPORAL['customer_lifecycle_stage']} AS s")
    assert [r["s"] for r in stages.collect()] == [None, "new", "growing", "mature", "veteran"]


def test_registration_after_as_of_does_not_divide_by_zero(spark):
    df = spark.createDataFrame([(-1, -1, 10.0)], "customer_age_days int, days_since_last_login int, total_spent_365d double")
    r = df.selectExpr(
        f"{customer.VALUE['estimated_clv']} AS clv", f"{customer.TEMPORAL['login_frequency_score']} AS login"
    ).first()
    assert r["clv"] is None and r["login"] is None


@pytest.mark.parametrize("limit", [200, 0])
def test_frequencies_by_map_and_join(spark, limit):
    df = spark.createDataFrame(
        [(1, "a'\"\\"), (2, "a'\"\\"), (3, "b"), (4, None)], "customer_id long, tier string"
    )
    got = customer.frequency_encoding(df, None, ("tier",), limit).collect()
    assert {r["customer_id"]: r["tier_frequency"] for r in got} == {1: 2 / 3, 2: 2 / 3, 3: 1 / 3, 4: None}


def test_all_null_column_has_no_frequency(spark):
    df = spark.createDataFrame([(1, None)], "customer_id long, gender string")
    assert customer.frequency_encoding(df, None, ("gender",)).first()["gender_frequency"] is None


def test_high_value_flag_same_beyond_the_one_pass_limit(spark):
    df = spark.createDataFrame([(float(i),) for i in range(9)] + [(None,)], "total_spent_365d double")
    for limit in (100, 0):
        flags = [r[0] for r in df.select(customer.high_value_flag(df, 10, limit)).collect()]
        assert flags == [0] * 7 + [1, 1, 0]


def test_fill_rules(spark):
    df = spark.createDataFrame(
        [(1, None, 4.0, None, None, None, None), (2, 2.0, None, 3, "x", True, date(2001, 1, 1)), (3, 5.0, 8.0, 4, "y", False, None)],
        "customer_id long, account_balance double, monthly_fee double, page_views long, gender string, "
        "is_premium boolean, last_login_date date",
    )
    for limit in (0, 100):
        fill = impute.fit_fill_values(df, one_pass_values=limit)
        r = impute.impute(df, fill).where("customer_id = 1").first()
        # "account_balance" contains "count"; page_views matches no pattern
        assert (r["account_balance"], r["page_views"], r["gender"], r["is_premium"]) == (0.0, 3.5, "unknown", False)
        assert r["last_login_date"] is None
        assert impute.impute(df, fill).where("customer_id = 2").first()["monthly_fee"] == 6.0


def test_skipped_columns_are_left_alone(spark):
    df = spark.createDataFrame([(1, 1, None), (2, 0, 4.0)], "customer_id long, churned int, monthly_fee double")
    fill = impute.fit_fill_values(df, skip=("customer_id", "churned"))
    assert list(fill.numbers) == ["monthly_fee"]
    assert impute.impute(df, fill).schema["churned"] == df.schema["churned"]


def test_empty_sources_give_null_columns(spark):
    empty = tx(spark, [(1, AS_OF, 1.0)]).where("customer_id = 9")
    assert rfm.rfm_windows(empty, AS_OF).collect() == []
    lines = spark.createDataFrame(
        [], "customer_id long, product_category string, is_refunded boolean, discount_applied double, quantity int"
    )
    assert behaviour.line_features(lines).collect() == []


def test_line_features_equal_the_single_operators(spark, sf):
    lines = fx.transaction_lines(spark, sf)
    one = {r["customer_id"]: r for r in behaviour.line_features(lines).collect()}
    two = behaviour.refund_discount_stats(lines).join(
        behaviour.distinct_per_customer(lines, "product_category", "product_category_count"), "customer_id"
    )
    for r in two.collect():
        assert one[r["customer_id"]].asDict() == r.asDict()


def test_distinct_ignores_nulls(spark):
    df = spark.createDataFrame([(1, "a"), (1, None), (1, "a"), (2, None)], "customer_id long, m string")
    got = {r[0]: r[1] for r in behaviour.distinct_per_customer(df, "m", "n").collect()}
    assert got == {1: 1, 2: 0}
