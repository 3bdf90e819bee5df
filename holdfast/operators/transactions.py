"""Transaction behaviour: diversity, refunds, regularity."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from holdfast.functions.columns import cents, elapsed_days, from_cents, ratio, ratio_text
from holdfast.functions.ordering import HOT_ROWS, hot_instants, previous_instants, split_hot


def distinct_per_customer(df: DataFrame, column: str, name: str) -> DataFrame:
    """Distinct non-null values per customer; pairs are combined before either shuffle."""
    pairs = df.groupBy("customer_id", column).agg(F.lit(1).alias("_seen"))
    return pairs.groupBy("customer_id").agg(F.count(column).alias(name))


def diversity(transactions: DataFrame, lines: DataFrame | None = None) -> DataFrame:
    """Payment-method and product-category counts; categories come from ``lines`` if given."""
    methods = distinct_per_customer(transactions, "payment_method", "payment_method_count")
    categories = distinct_per_customer(
        transactions if lines is None else lines, "product_category", "product_category_count"
    )
    return methods.join(categories, "customer_id", "full")


def refund_discount_stats(lines: DataFrame) -> DataFrame:
    refunded = F.col("is_refunded").cast("int")
    summed = lines.groupBy("customer_id").agg(
        F.coalesce(F.sum(refunded), F.lit(0)).alias("total_refunds"),
        F.avg(refunded).alias("refund_rate"),
        F.sum(cents(F.col("discount_applied"))).alias("_discounts"),
        F.count("discount_applied").alias("_discounted"),
        F.coalesce(F.sum("quantity"), F.lit(0)).alias("total_quantity"),
        F.avg("quantity").alias("avg_quantity"),
    )
    return summed.select(
        "customer_id",
        "total_refunds",
        "refund_rate",
        ratio(from_cents(F.col("_discounts")), F.col("_discounted")).alias("avg_discount_rate"),
        "total_quantity",
        "avg_quantity",
    )


def line_features(lines: DataFrame) -> DataFrame:
    """Category count, refunds, discounts and quantities in one pass, rolled up by (customer, category) first."""
    by_category = lines.groupBy("customer_id", "product_category").agg(
        F.expr("sum(CAST(is_refunded AS INT)) AS _refunds"),
        F.expr("count(is_refunded) AS _known"),
        F.expr("sum(CAST(rint(CAST(discount_applied AS DOUBLE) * 100) AS BIGINT)) AS _discounts"),
        F.expr("count(discount_applied) AS _discounted"),
        F.expr("sum(quantity) AS _quantity"),
        F.expr("count(quantity) AS _counted"),
    )
    return by_category.groupBy("customer_id").agg(
        F.expr("count(product_category) AS product_category_count"),
        F.expr("coalesce(sum(_refunds), 0) AS total_refunds"),
        F.expr(f"{ratio_text('sum(_refunds)', 'sum(_known)')} AS refund_rate"),
        F.expr(f"{ratio_text('sum(_discounts) / 100D', 'sum(_discounted)')} AS avg_discount_rate"),
        F.expr("coalesce(sum(_quantity), 0) AS total_quantity"),
        F.expr(f"{ratio_text('sum(_quantity)', 'sum(_counted)')} AS avg_quantity"),
    )


def days_between_transactions(transactions: DataFrame, hot_rows: int | None = HOT_ROWS) -> DataFrame:
    """Each transaction with the whole days since the customer's one before.

    Transactions at one instant are ordered by id, a missing id first; all but the first are 0 days apart.
    """
    key, ts, id_ = "customer_id", "transaction_date", "transaction_id"
    rows = transactions.select(key, id_, ts).where(F.col(ts).isNotNull())
    plain, hot = (rows, None) if hot_rows is None else split_hot(rows, key, hot_rows)
    before = F.lag(ts).over(W.partitionBy(key).orderBy(ts, id_))
    gap = elapsed_days(before, F.col(ts)).alias("days_between_transactions")
    out = plain.select(key, id_, ts, gap)
    if hot is None:
        return out
    points = hot_instants(hot, key, ts).select(
        F.col(key).alias("_key"),
        F.col(ts).alias("_at"),
        elapsed_days(F.col("previous"), F.col(ts)).alias("_gap"),
    )
    place = F.row_number().over(W.partitionBy(key, ts).orderBy(id_))
    first = F.when(F.col("_place") == 1, F.col("_gap")).otherwise(0)
    hot = hot.withColumn("_place", place)
    split = hot.join(points, hot[key].eqNullSafe(points["_key"]) & (hot[ts] == points["_at"])).select(
        key, id_, ts, first.alias("days_between_transactions")
    )
    return out.unionByName(split)


def transaction_regularity(transactions: DataFrame, hot_rows: int | None = HOT_ROWS) -> DataFrame:
    """Mean, sample std and variation of the days between transactions.

    Of a hot customer, the transactions at one instant come as one row: their
    ``n - 1`` intervals of 0 days are added by formula.
    """
    key, ts = "customer_id", "transaction_date"
    points = previous_instants(transactions, key, ts, hot_rows)
    gaps = points.groupBy(key).agg(
        F.avg(gap := elapsed_days(F.col("previous"), F.col(ts))).alias("_mean"),
        F.var_pop(gap).alias("_var"),
        F.count("previous").alias("_gaps"),
        F.sum(F.col("n") - 1).alias("_zeros"),
    )
    mean = F.coalesce(F.col("_mean"), F.lit(0.0))
    n = F.col("_gaps") + F.col("_zeros")
    squares = (
        F.coalesce(F.col("_var"), F.lit(0.0)) * F.col("_gaps")
        + mean * mean * F.col("_gaps") * F.try_divide(F.col("_zeros"), n)
    )
    std = F.sqrt(F.when(n > 1, squares / (n - 1)))
    out = gaps.select(
        key,
        F.when(n > 0, mean * F.try_divide(F.col("_gaps"), n)).alias("avg_days_between_transactions"),
        std.alias("std_days_between_transactions"),
    )
    return out.withColumn(
        "transaction_regularity_cv",
        ratio(F.col("std_days_between_transactions"), F.col("avg_days_between_transactions") + 1),
    )
