"""Temporal, behavioural and demographic columns of the per-customer table."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from holdfast.functions.columns import expressions, flag_text, ratio_text, right_closed_bins
from holdfast.functions.quantiles import ONE_PASS_VALUES, exact_quantiles

# bin edges and labels (fixed values); the last lifecycle bin is open
LIFECYCLE_EDGES = [0, 30, 90, 180, 365, None]
LIFECYCLE_LABELS = ["new", "growing", "established", "mature", "veteran"]
AGE_EDGES = [0, 18, 25, 35, 45, 55, 65, 100]
AGE_LABELS = ["<18", "18-24", "25-34", "35-44", "45-54", "55-64", "65+"]

# columns that are frequency-encoded (fixed values)
ENCODED = ("gender", "country", "customer_tier", "subscription_type", "referral_source", "customer_lifecycle_stage")


TEMPORAL = {
    "registration_day_of_week": "weekday(registration_date)",
    "registration_month": "month(registration_date)",
    "registration_quarter": "quarter(registration_date)",
    "login_frequency_score": ratio_text("365", "days_since_last_login + 1"),
    "customer_lifecycle_stage": right_closed_bins("customer_age_days", LIFECYCLE_EDGES, LIFECYCLE_LABELS),
}
AGE_GROUP = {"age_group": right_closed_bins("age", AGE_EDGES, AGE_LABELS)}
VALUE = {
    "estimated_clv": ratio_text("total_spent_365d", "customer_age_days + 1") + " * 365 * 2",
    "activity_decline_30_90": ratio_text(
        "transaction_count_90d - transaction_count_30d * 3", "transaction_count_90d + 1"
    ),
    "engagement_per_day": ratio_text("total_events", "customer_age_days + 1"),
    "is_multi_channel": flag_text("payment_method_count > 1"),
}
# unknown trends count as not declining, so NULL must not be filled before
RISK_FLAGS = {
    "high_recency_flag": flag_text("recency_days_30d > 30"),
    "declining_frequency_flag": flag_text("frequency_trend_30_90 < 0.5D"),
    "declining_spending_flag": flag_text("spending_trend_30_90 < 0.5D"),
}


def temporal_features(profiles: DataFrame) -> DataFrame:
    return profiles.withColumns(expressions(TEMPORAL))


def demographic_features(profiles: DataFrame) -> DataFrame:
    return profiles.withColumns(expressions(AGE_GROUP))


def high_value_flag(df: DataFrame, rows: int, one_pass_values: int = ONE_PASS_VALUES) -> Column:
    """``total_spent_365d`` above the 75th percentile of ``df``, a one-row subquery while ``rows`` allows it."""
    if rows <= one_pass_values:
        cut = df.agg(F.expr("percentile(total_spent_365d, 0.75)")).scalar()
    else:
        cut = F.lit(exact_quantiles(df, ["total_spent_365d"], [0.75], rows, one_pass_values)["total_spent_365d"][0])
    return F.coalesce((F.col("total_spent_365d") > cut.cast("double")).cast("int"), F.lit(0))


def preliminary_risk_score(top_login_score: Column) -> Column:
    flags = F.expr("high_recency_flag * 0.3D + declining_frequency_flag * 0.3D + declining_spending_flag * 0.2D")
    return flags + (F.lit(1.0) - F.try_divide("login_frequency_score", top_login_score)) * F.lit(0.2)


def top_login_score(profiles: DataFrame) -> Column:
    """Largest login score as a one-row subquery."""
    return profiles.agg(F.expr(f"max({TEMPORAL['login_frequency_score']})")).scalar()


def value_frequencies(df: DataFrame, columns: tuple[str, ...] = ENCODED) -> DataFrame:
    """Share of every non-null value of every column, in long form; one aggregate for all columns."""
    pairs = ", ".join(f"struct('{c}' AS column, CAST({c} AS STRING) AS value)" for c in columns)
    counts = (
        df.selectExpr(f"inline(array({pairs}))")
        .where("value IS NOT NULL")
        .groupBy("column", "value")
        .agg(F.count("*").alias("n"))
    )
    totals = counts.groupBy("column").agg(F.sum("n").alias("total"))
    # totals has one row per encoded column
    return counts.join(F.broadcast(totals), "column").selectExpr(
        "column", "value", "n", f"{ratio_text('n', 'total')} AS frequency"
    )


def frequency_encoding(
    df: DataFrame,
    frequencies: DataFrame | None = None,
    columns: tuple[str, ...] = ENCODED,
    literal_values: int = 200,
) -> DataFrame:
    """Add ``<column>_frequency``: the share of the row's value, NULL for NULL.

    A column of few values gets them as a constant map. One of more is joined,
    by its own size: the adaptive planner broadcasts a small lookup and splits
    a frequent value of a large one.
    """
    lookup = value_frequencies(df, columns) if frequencies is None else frequencies
    sizes = {r["column"]: r["n"] for r in lookup.groupBy("column").agg(F.count("*").alias("n")).collect()}  # one row per column
    few = [c for c in columns if sizes.get(c, 0) <= literal_values]
    shares: dict[str, dict[str, float]] = {c: {} for c in few}
    for r in lookup.where(F.col("column").isin(few)).collect():  # at most literal_values per column
        shares[r["column"]][r["value"]] = r["frequency"]
    for c in columns:
        name = f"{c}_frequency"
        if c in shares:
            constant = F.from_json(F.lit(json.dumps(shares[c])), "map<string,double>")
            df = df.withColumn(name, F.element_at(constant, F.col(c).cast("string")))
            continue
        one = lookup.where(F.col("column") == c).select(F.col("value").alias("_value"), F.col("frequency").alias(name))
        df = df.join(one, df[c].cast("string") == one["_value"], "left").drop("_value")
    return df
