"""Drift, outliers, correlation and data validation."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from holdfast.functions.columns import ratio
from holdfast.functions.quantiles import ONE_PASS_VALUES, exact_quantiles

FEATURE_DRIFT_LIMIT, PREDICTION_DRIFT_LIMIT = 0.1, 0.15
# an empty bin counts as this share, so the logarithm exists
_FLOOR = 1e-4


def _bin(value: Column, cuts: list[float]) -> Column:
    """Number of cut points below the value, 0 for the lowest bin; -1 for NULL."""
    below = reduce(lambda a, b: a + b, [(F.lit(c) < value).cast("int") for c in cuts], F.lit(0))
    return F.coalesce(F.when(value.isNull(), F.lit(-1)), below)


def _binned(df: DataFrame, bins: dict[str, Column], name: str) -> DataFrame:
    """Counts per (feature, bin) for all features in one aggregate."""
    entries = F.array(*[F.when(b.isNotNull(), F.struct(F.lit(c).alias("feature"), b.alias("bin"))) for c, b in bins.items()])
    return (
        df.select(F.explode(F.array_compact(entries)).alias("e"))
        .groupBy("e.feature", "e.bin")
        .agg(F.count("*").alias(name))
    )


def _psi(baseline: DataFrame, current: DataFrame, limit: float) -> DataFrame:
    """Both sides hold at most features x bins rows."""
    both = baseline.join(current, ["feature", "bin"], "full").na.fill(0, ["base", "now"])
    per_feature = W.partitionBy("feature")
    shares = both.select(
        "feature",
        F.greatest(ratio(F.col("base"), F.sum("base").over(per_feature)), F.lit(_FLOOR)).alias("b"),
        F.greatest(ratio(F.col("now"), F.sum("now").over(per_feature)), F.lit(_FLOOR)).alias("n"),
    )
    term = (F.col("n") - F.col("b")) * F.log(F.col("n") / F.col("b"))
    return (
        shares.groupBy("feature")
        .agg(F.sum(term).alias("psi"))
        .withColumn("drifted", F.coalesce(F.col("psi") > limit, F.lit(False)))
    )


def feature_drift_psi(
    baseline: DataFrame,
    current: DataFrame,
    columns: list[str],
    rows: int | None = None,
    one_pass_values: int = ONE_PASS_VALUES,
    limit: float = FEATURE_DRIFT_LIMIT,
) -> DataFrame:
    """Population stability index per column over the baseline's decile bins.

    NULLs are a bin of their own, so a column that empties or fills up drifts
    most; a column without baseline values has one bin for all values.
    """
    tenths = [i / 10 for i in range(1, 10)]
    cuts = exact_quantiles(baseline, columns, tenths, rows, one_pass_values)

    def bins() -> dict[str, Column]:
        return {c: _bin(F.col(c).cast("double"), [x for x in cuts[c] if x is not None]) for c in columns}

    return _psi(_binned(baseline, bins(), "base"), _binned(current, bins(), "now"), limit)


def prediction_drift_psi(
    baseline: DataFrame, current: DataFrame, probability: str = "churn_probability", limit: float = PREDICTION_DRIFT_LIMIT
) -> DataFrame:
    """The index over ten equal score bins."""
    bins = {probability: F.least(F.floor(F.col(probability) * 10), F.lit(9)).cast("int")}
    return _psi(_binned(baseline, bins, "base"), _binned(current, bins, "now"), limit)


def metric_drift(metrics: DataFrame) -> DataFrame:
    """Long (snapshot_ts, metric, value) with the change from the snapshot before; a few rows per run."""
    w = W.partitionBy("metric").orderBy("snapshot_ts")
    before = F.lag("value").over(w)
    return metrics.select(
        "snapshot_ts", "metric", "value", before.alias("previous"), (F.col("value") - before).alias("change")
    )


def outliers_iqr(
    df: DataFrame, columns: list[str], rows: int | None = None, one_pass_values: int = ONE_PASS_VALUES, k: float = 1.5
) -> DataFrame:
    """Fences ``k`` interquartile ranges outside the quartiles, and how many values lie beyond each.

    A column without values has NULL fences and nothing beyond them.
    """
    quartiles = exact_quantiles(df, columns, [0.25, 0.75], rows, one_pass_values)
    fences = {}
    for c, (q1, q3) in quartiles.items():
        known = q1 is not None
        fences[c] = (q1 - k * (q3 - q1) if known else None, q3 + k * (q3 - q1) if known else None)
    counts = df.agg(
        *[F.count_if(F.col(c) < F.lit(low).cast("double")).alias(f"lo_{c}") for c, (low, _) in fences.items()],
        *[F.count_if(F.col(c) > F.lit(high).cast("double")).alias(f"hi_{c}") for c, (_, high) in fences.items()],
    )
    entries = F.array(
        *[
            F.struct(
                F.lit(c).alias("column_name"),
                F.lit(low).cast("double").alias("lower_fence"),
                F.lit(high).cast("double").alias("upper_fence"),
                F.col(f"lo_{c}").alias("below"),
                F.col(f"hi_{c}").alias("above"),
            )
            for c, (low, high) in fences.items()
        ]
    )
    return counts.select(F.inline(entries))


def feature_correlation(df: DataFrame, columns: list[str]) -> DataFrame:
    """Pearson correlation of every pair of columns over rows where both are known; one pass."""
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i + 1:]]
    found = df.agg(*[F.corr(F.col(a).cast("double"), F.col(b).cast("double")).alias(f"{a}|{b}") for a, b in pairs])
    entries = F.array(
        *[
            F.struct(F.lit(a).alias("feature_a"), F.lit(b).alias("feature_b"), F.col(f"{a}|{b}").alias("correlation"))
            for a, b in pairs
        ]
    )
    return found.select(F.inline(entries))


def row_rule_violations(df: DataFrame, table: str, rules: dict[str, Column]) -> DataFrame:
    """Rows breaking each rule (a condition that must not hold); all rules in one pass."""
    counts = df.agg(*[F.count_if(c).alias(name) for name, c in rules.items()])
    entries = F.array(
        *[
            F.struct(F.lit(table).alias("table_name"), F.lit(r).alias("rule"), F.col(r).alias("violations"))
            for r in rules
        ]
    )
    return counts.select(F.inline(entries))


def key_rule_violations(df: DataFrame, table: str, key: str, rules: dict[str, Column]) -> DataFrame:
    """As :func:`row_rule_violations`, with the rows beyond the first of their key as ``duplicate_key``; one pass."""
    by_key = df.groupBy(key).agg((F.count("*") - 1).alias("duplicate_key"), *[F.count_if(c).alias(name) for name, c in rules.items()])
    names = ["duplicate_key", *rules]
    sums = by_key.agg(*[F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in names])
    entries = [F.struct(F.lit(table).alias("table_name"), F.lit(n).alias("rule"), F.col(n).alias("violations")) for n in names]
    return sums.select(F.inline(F.array(*entries)))


def orphan_rows(df: DataFrame, table: str, key: str, parent: DataFrame) -> DataFrame:
    """Rows whose key has no parent; keys are counted before the join, so a heavy key is one row."""
    keys = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("n"))
    return (
        keys.join(parent.select(key), key, "left_anti")
        .agg(F.coalesce(F.sum("n"), F.lit(0)).alias("violations"))
        .select(F.lit(table).alias("table_name"), F.lit("orphan_key").alias("rule"), "violations")
    )


def data_validation(tables: dict[str, DataFrame]) -> DataFrame:
    """Violations per table and rule over the source tables."""
    customers = tables["customers"]
    checks = [
        key_rule_violations(
            customers,
            "customers",
            "customer_id",
            {
                "null_key": F.col("customer_id").isNull(),
                "age_out_of_range": ~F.col("age").between(18, 100),
                "login_before_registration": F.col("last_login_date") < F.col("registration_date"),
                "negative_balance": F.col("account_balance") < 0,
            },
        ),
        key_rule_violations(
            tables["transactions"],
            "transactions",
            "transaction_id",
            {
                "null_key": F.col("transaction_id").isNull() | F.col("customer_id").isNull(),
                "amount_not_positive": F.col("transaction_amount") <= 0,
            },
        ),
        row_rule_violations(
            tables["user_events"],
            "user_events",
            {
                "null_key": F.col("customer_id").isNull(),
                "negative_time": F.col("time_spent_seconds") < 0,
                "unknown_type": ~F.col("event_type").isin("page_view", "click", "search", "add_to_cart"),
            },
        ),
        key_rule_violations(
            tables["support_tickets"], "support_tickets", "ticket_id", {"unknown_status": ~F.col("status").isin("resolved", "open")}
        ),
        row_rule_violations(
            tables["subscription_history"], "subscription_history", {"fee_missing": F.col("monthly_fee").isNull()}
        ),
        *[
            orphan_rows(tables[t], t, "customer_id", customers)
            for t in ("transactions", "user_events", "support_tickets", "subscription_history")
        ],
    ]
    return reduce(DataFrame.unionByName, checks)
