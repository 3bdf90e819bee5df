"""Features, labels and metrics at several as-of times, in one pass over each source."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from holdfast.functions.columns import elapsed_days, instant, ratio
from holdfast.operators.rfm import LOOKBACKS

_AT = "as_of"


def _times(as_ofs: list[datetime | str]):
    return F.array(*[instant(t) for t in as_ofs])


def _before(days: int):
    return F.expr(f"INTERVAL '{int(days)}' DAY")


def rfm_at_times(transactions: DataFrame, as_ofs: list[datetime | str], lookbacks: tuple[int, ...] = LOOKBACKS) -> DataFrame:
    """The rows of :func:`rfm.rfm_windows` for every as-of time, with the time as ``as_of``.

    A transaction is copied to the times whose longest window holds it, in the task that
    reads it, and one aggregate per (customer, time) does the rest. Sums in whole cents.
    """
    ts, amount = F.col("transaction_date"), F.col("transaction_amount").cast("double")
    longest = max(lookbacks)
    holds = F.filter(_times(as_ofs), lambda t: (ts < t) & (ts >= t - _before(longest)))
    rows = transactions.select(
        "customer_id", "transaction_date", amount.alias("_amount"), F.rint(amount * 100).cast("bigint").alias("_cents"), F.explode(holds).alias(_AT)
    )
    aggregates, outputs = [], []
    for p in lookbacks:
        inside = f"FILTER (WHERE transaction_date >= {_AT} - INTERVAL '{int(p)}' DAY)"
        aggregates += [
            f"count(*) {inside} AS _n_{p}",
            f"sum(_cents) {inside} / 100D AS _sum_{p}",
            f"stddev_samp(_amount) {inside} AS _std_{p}",
            f"min(_amount) {inside} AS _min_{p}",
            f"max(_amount) {inside} AS _max_{p}",
            f"max(transaction_date) {inside} AS _last_{p}",
        ]
        outputs += [
            F.nullif(F.col(f"_n_{p}"), F.lit(0)).alias(f"transaction_count_{p}d"),
            F.col(f"_sum_{p}").alias(f"total_spent_{p}d"),
            ratio(F.col(f"_sum_{p}"), F.col(f"_n_{p}")).alias(f"avg_transaction_{p}d"),
            F.col(f"_std_{p}").alias(f"std_transaction_{p}d"),
            F.col(f"_min_{p}").alias(f"min_transaction_{p}d"),
            F.col(f"_max_{p}").alias(f"max_transaction_{p}d"),
            elapsed_days(F.col(f"_last_{p}"), F.col(_AT)).alias(f"recency_days_{p}d"),
        ]
    return rows.groupBy("customer_id", _AT).agg(*map(F.expr, aggregates)).select("customer_id", _AT, *outputs)


def labels_at_times(customers: DataFrame, transactions: DataFrame, as_ofs: list[datetime | str], horizon_days: int = 365) -> DataFrame:
    """``customer_id, as_of, churned`` for customers registered before each time: 1 without a transaction in the horizon after it."""
    ts = F.col("transaction_date")
    after = F.filter(_times(as_ofs), lambda t: (ts >= t) & (ts < t + _before(horizon_days)))
    buyers = transactions.select("customer_id", F.explode(after).alias(_AT)).groupBy("customer_id", _AT).agg(F.lit(1).alias("_bought"))
    known = F.filter(_times(as_ofs), lambda t: F.col("registration_date") < t.cast("date"))
    people = customers.select("customer_id", F.explode(known).alias(_AT))
    return people.join(buyers, ["customer_id", _AT], "left").select("customer_id", _AT, F.col("_bought").isNull().cast("int").alias("churned"))


def metrics_at_times(scored: DataFrame, label: str = "churned", probability: str = "churn_probability", threshold: float = 0.5) -> DataFrame:
    """Long ``snapshot_ts, metric, value`` per as-of time: accuracy, precision, recall, F1 and rows, as :func:`monitoring.metric_drift` takes them."""
    flagged, positive = F.col(probability) >= threshold, F.col(label) == 1
    counts = scored.groupBy(F.col(_AT).alias("snapshot_ts")).agg(
        F.count("*").alias("n"),
        F.count_if(flagged & positive).alias("tp"),
        F.count_if(flagged & ~positive).alias("fp"),
        F.count_if(~flagged & positive).alias("fn"),
    )
    tp, fp, fn, n = (F.col(c) for c in ("tp", "fp", "fn", "n"))
    share = lambda a, b: F.coalesce(ratio(a, b), F.lit(0.0))
    values = {
        "accuracy": share(n - fp - fn, n),
        "precision": share(tp, tp + fp),
        "recall": share(tp, tp + fn),
        "f1_score": share(2 * tp, 2 * tp + fp + fn),
        "rows": n.cast("double"),
    }
    entries = F.array(*[F.struct(F.lit(m).alias("metric"), v.alias("value")) for m, v in values.items()])
    return counts.select("snapshot_ts", F.inline(entries))
