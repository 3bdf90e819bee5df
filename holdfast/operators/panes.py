"""RFM windows from daily partial aggregates, for as many as-of times as one likes.

A pane is a customer's partial aggregate of a day (:func:`incremental.partial_state`). A
window takes the panes of its whole days; of its first and last day it takes the rows
themselves unless it begins or ends at midnight. So a new as-of time reads panes and, at
most, the rows of one day per window and one more.
"""

from __future__ import annotations

from datetime import datetime, time, timedelta
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from holdfast.functions.columns import cents, elapsed_days_text, timestamp_text
from holdfast.operators.rfm import LOOKBACKS


def edge_days(as_of: datetime, lookbacks: tuple[int, ...]) -> list:
    """Days that some window takes in part; none if the time is midnight."""
    if as_of.time() == time():
        return []
    return sorted({as_of.date(), *((as_of - timedelta(days=p)).date() for p in lookbacks)})


def edge_rows(transactions: DataFrame, as_of: datetime, lookbacks: tuple[int, ...]) -> DataFrame:
    """The transactions of the edge days, by ranges of their time, so that files of other days are skipped."""
    ts = F.col("transaction_date")
    day = lambda d: F.lit(f"{d} 00:00:00").cast("timestamp_ntz")
    inside = [(ts >= day(d)) & (ts < day(d + timedelta(days=1))) for d in edge_days(as_of, lookbacks)]
    return transactions.where(reduce(lambda a, b: a | b, inside) if inside else F.lit(False))


def rfm_from_panes(panes: DataFrame, transactions: DataFrame, as_of: datetime | str, lookbacks: tuple[int, ...] = LOOKBACKS) -> DataFrame:
    """The rows and columns of :func:`rfm.rfm_windows`; amounts in whole cents, so sums are exact."""
    moment = as_of if isinstance(as_of, datetime) else datetime.fromisoformat(as_of)
    now, today = timestamp_text(moment), moment.date()
    c = cents(F.col("transaction_amount"))
    square = c.cast("decimal(18,0)") * c.cast("decimal(18,0)")
    rows = edge_rows(transactions, moment, lookbacks).select(
        "customer_id", F.col("transaction_date").cast("date").alias("day"), F.lit(1).cast("bigint").alias("n"), c.alias("sum_cents"),
        square.cast("decimal(38,0)").alias("sum_squares"), c.alias("min_cents"), c.alias("max_cents"),
        F.col("transaction_date").alias("last_transaction"), F.lit(False).alias("whole"),
    )
    oldest = (moment - timedelta(days=max(lookbacks))).date()
    days = panes.where((F.col("day") >= F.lit(oldest)) & (F.col("day") < F.lit(today))).withColumn("whole", F.lit(True))
    both = days.select(rows.columns).unionByName(rows)
    aggregates, outputs = [], []
    for p in lookbacks:
        start = moment - timedelta(days=p)
        first_whole = start.date() + timedelta(days=int(start.time() != time()))
        inside = (
            f"FILTER (WHERE (whole AND day >= DATE '{first_whole}') OR (NOT whole AND day IN (DATE '{start.date()}', DATE '{today}') "
            f"AND last_transaction >= {timestamp_text(start)} AND last_transaction < {now}))"
        )
        aggregates += [
            f"sum(n) {inside} AS _n_{p}",
            f"sum(sum_cents) {inside} AS _s_{p}",
            f"CAST(sum(sum_squares) {inside} AS DECIMAL(38,0)) AS _q_{p}",
            f"min(min_cents) {inside} AS _min_{p}",
            f"max(max_cents) {inside} AS _max_{p}",
            f"max(last_transaction) {inside} AS _last_{p}",
        ]
        n, s = f"CAST(_n_{p} AS DECIMAL(18,0))", f"CAST(_s_{p} AS DECIMAL(18,0))"
        spread = f"CAST({n} * _q_{p} - {s} * {s} AS DOUBLE) / (CAST(_n_{p} AS DOUBLE) * (_n_{p} - 1))"
        outputs += [
            f"_n_{p} AS transaction_count_{p}d",
            f"_s_{p} / 100D AS total_spent_{p}d",
            f"_s_{p} / 100D / _n_{p} AS avg_transaction_{p}d",
            f"CASE WHEN _n_{p} > 1 THEN sqrt({spread}) / 100 END AS std_transaction_{p}d",
            f"_min_{p} / 100D AS min_transaction_{p}d",
            f"_max_{p} / 100D AS max_transaction_{p}d",
            f"{elapsed_days_text(f'_last_{p}', now)} AS recency_days_{p}d",
        ]
    found = both.groupBy("customer_id").agg(*map(F.expr, aggregates))
    # customers whose rows of the edge days lie outside the longest window have no row there either
    return found.where(F.col(f"_n_{max(lookbacks)}").isNotNull()).selectExpr("customer_id", *outputs)
