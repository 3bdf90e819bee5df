"""Risk bands, risk factors and prediction reports over a ``churn_probability`` column."""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from holdfast.functions.columns import instant
from holdfast.functions.quantiles import ONE_PASS_VALUES, exact_quantiles

HIGH_RISK, MEDIUM_RISK = 0.7, 0.4
BANDS = ("high", "medium", "low")
# below this engagement score a customer counts as little engaged (fixed value)
LOW_ENGAGEMENT = 50


def recency_score(recency_days: Column) -> Column:
    """A stand-in probability without a model: days since the last purchase over a year, at most 1."""
    return F.least(F.coalesce(recency_days, F.lit(365)) / F.lit(365.0), F.lit(1.0))


def risk_band(probability: Column, high: float = HIGH_RISK, medium: float = MEDIUM_RISK) -> Column:
    return F.when(probability >= high, "high").when(probability >= medium, "medium").otherwise("low")


def predictions(scored: DataFrame, moment: datetime | str) -> DataFrame:
    """Output table of a scoring run; sort at the sink, not here."""
    stamp = instant(moment)
    return scored.select(
        "customer_id",
        "churn_probability",
        risk_band(F.col("churn_probability")).alias("risk_category"),
        stamp.cast("date").alias("prediction_date"),
        stamp.alias("prediction_timestamp"),
    )


def risk_filter(scored: DataFrame, bands: tuple[str, ...] | None) -> DataFrame:
    return scored if not bands else scored.where(F.col("risk_category").isin(*bands))


def _riskiest_first() -> list[Column]:
    return [F.col("churn_probability").desc(), F.col("customer_id").asc()]


def high_risk_customers(scored: DataFrame, top_n: int | None = None) -> DataFrame:
    """The high band, or its ``top_n`` riskiest over the whole table (0 and None mean all)."""
    high = scored.where(F.col("risk_category") == "high")
    return high.orderBy(*_riskiest_first()).limit(top_n) if top_n else high


def top_customers(scored: DataFrame, n: int = 10) -> DataFrame:
    return scored.orderBy(*_riskiest_first()).limit(n).select("customer_id", "churn_probability", "risk_category")


def risk_distribution(scored: DataFrame) -> DataFrame:
    band = F.col("risk_category")
    return scored.agg(
        F.count("*").alias("total_customers"),
        *[F.count_if(band == b).alias(f"{b}_risk_count") for b in BANDS],
    )


def risk_factors(scored: DataFrame, features: DataFrame) -> DataFrame:
    """Per customer an array of {factor, description, value}; features must be NULL or filled as scored."""

    def factor(when: Column, name: str, description: str, value: str) -> Column:
        return F.when(
            when,
            F.struct(
                F.lit(name).alias("factor"),
                F.lit(description).alias("description"),
                F.col(value).cast("double").alias("value"),
            ),
        )

    # names and texts of the factors (fixed values)
    found = F.array(
        factor(F.col("recency_days_30d") > 30, "high_recency", "No recent transactions", "recency_days_30d"),
        factor(
            F.col("activity_decline_30_90") > 0.5,
            "declining_activity",
            "Significant activity decline",
            "activity_decline_30_90",
        ),
        factor(F.col("open_tickets") > 0, "open_support_tickets", "Unresolved support issues", "open_tickets"),
        factor(
            F.col("engagement_score") < LOW_ENGAGEMENT, "low_engagement", "Below average engagement", "engagement_score"
        ),
    )
    needed = features.select(
        "customer_id", "recency_days_30d", "activity_decline_30_90", "open_tickets", "engagement_score"
    )
    return scored.join(needed, "customer_id").select(
        "customer_id",
        F.round("churn_probability", 4).alias("churn_probability"),
        "risk_category",
        F.array_compact(found).alias("key_risk_factors"),
    )


def union_predictions(*batches: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, batches)


def prediction_summary(scored: DataFrame, first_n: int = 100) -> DataFrame:
    """One row: date, totals, band counts, mean, and the ids of the ``first_n`` riskiest high-band customers."""
    stats = scored.agg(
        F.max("prediction_date").alias("prediction_date"),
        F.count("*").alias("total_customers"),
        *[F.count_if(F.col("risk_category") == b).alias(f"{b}_risk_count") for b in BANDS],
        F.avg("churn_probability").alias("avg_churn_probability"),
    )
    first = _in_order(high_risk_customers(scored, first_n), F.col("customer_id"))
    return stats.withColumn("high_risk_customers", first)


def _in_order(df: DataFrame, entry: Column) -> Column:
    """One value per row of a limited table as an array, riskiest first; a one-row subquery."""
    order = F.struct((-F.col("churn_probability")).alias("p"), F.col("customer_id").alias("id"))
    entries = F.array_sort(F.collect_list(F.struct(order.alias("order"), entry.alias("row"))))
    return df.agg(F.transform(entries, lambda e: e["row"])).scalar()


def daily_report(
    scored: DataFrame, moment: datetime | str, rows: int | None = None, one_pass_values: int = ONE_PASS_VALUES
) -> DataFrame:
    """One row of report figures, nested as in the JSON report; the ten riskiest customers are an array."""
    rows = scored.count() if rows is None else rows
    p = F.col("churn_probability")
    if rows <= one_pass_values:
        median = F.percentile(p, F.lit(0.5))
    else:
        median = F.lit(exact_quantiles(scored, ["churn_probability"], [0.5], rows, one_pass_values)["churn_probability"][0])
    stats = scored.agg(
        F.count("*").alias("total_customers_scored"),
        F.struct(*[F.count_if(F.col("risk_category") == b).alias(b) for b in BANDS]).alias("risk_distribution"),
        F.struct(
            F.avg(p).alias("avg_churn_probability"),
            median.alias("median_churn_probability"),
            F.max(p).alias("max_churn_probability"),
            F.stddev_samp(p).alias("std_churn_probability"),
        ).alias("statistics"),
    )
    top = _in_order(top_customers(scored, 10), F.struct("customer_id", "churn_probability", "risk_category"))
    return stats.select(instant(moment).alias("report_date"), "*", top.alias("top_10_high_risk"))
