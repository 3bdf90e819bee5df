"""Recomputing only the days that changed, and merging the others' partial aggregates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from holdfast.functions.columns import cents, from_cents
from holdfast.session import bounded_broadcast, pinned


def rows_hash(ts: str = "transaction_date") -> Column:
    """A sum over rows that does not depend on their order: of hashes of all that the state is made of."""
    parts = [F.col("customer_id"), F.col(ts), cents(F.col("transaction_amount"))]
    return F.sum(F.xxhash64(*parts, *[p.isNull() for p in parts]).cast("decimal(20,0)")).cast("decimal(38,0)")


def days_of(df: DataFrame, ts: str) -> DataFrame:
    """Rows per calendar day, and their hash."""
    return df.groupBy(F.col(ts).cast("date").alias("day")).agg(F.count("*").alias("rows"), rows_hash(ts).alias("hash"))


def touched_days(df: DataFrame, ts: str, state: DataFrame) -> DataFrame:
    """Days whose rows differ from the state's: new, late, removed, exchanged and corrected rows alike."""
    known = state.groupBy("day").agg(F.sum("n").alias("_n"), F.sum("rows_hash").cast("decimal(38,0)").alias("_hash")).withColumnRenamed("day", "_day")
    both = days_of(df, ts).join(known, F.col("day").eqNullSafe(F.col("_day")), "full")
    same = (F.coalesce("rows", F.lit(0)) == F.coalesce("_n", F.lit(0))) & F.col("hash").eqNullSafe(F.col("_hash"))
    return both.where(~same).select(F.coalesce("day", "_day").alias("day"))


def partial_state(transactions: DataFrame, *per: str) -> DataFrame:
    """Mergeable sums per customer and day (and ``per``): count, sum, sum of squares, min, max, last, hash of the rows.

    Whole cents, so exact.
    """
    c = cents(F.col("transaction_amount"))
    return transactions.groupBy(*per, "customer_id", F.col("transaction_date").cast("date").alias("day")).agg(
        F.count("*").alias("n"),
        F.sum(c).alias("sum_cents"),
        F.sum(c.cast("decimal(18,0)") * c.cast("decimal(18,0)")).cast("decimal(38,0)").alias("sum_squares"),
        F.min(c).alias("min_cents"),
        F.max(c).alias("max_cents"),
        F.max("transaction_date").alias("last_transaction"),
        rows_hash().alias("rows_hash"),
    )


def merged(state: DataFrame, *by: str) -> DataFrame:
    """One state per ``by`` from partial ones."""
    return state.groupBy(*by).agg(
        F.sum("n").alias("n"),
        F.sum("sum_cents").alias("sum_cents"),
        F.sum("sum_squares").cast("decimal(38,0)").alias("sum_squares"),
        F.min("min_cents").alias("min_cents"),
        F.max("max_cents").alias("max_cents"),
        F.max("last_transaction").alias("last_transaction"),
        F.sum("rows_hash").cast("decimal(38,0)").alias("rows_hash"),
    )


def merged_days(state: DataFrame) -> DataFrame:
    """One state per customer from those of the days."""
    return merged(state, "customer_id").drop("rows_hash")


def rollup_of(state: DataFrame) -> DataFrame:
    """Lifetime figures per customer from a state by days."""
    state = merged_days(state)
    n, total = F.col("n").cast("decimal(18,0)"), F.col("sum_cents").cast("decimal(18,0)")
    spread = (n * F.col("sum_squares") - total * total).cast("double")
    variance = F.when(F.col("n") > 1, spread / (F.col("n").cast("double") * (F.col("n") - 1)))
    return state.select(
        "customer_id",
        F.col("n").alias("transaction_count"),
        from_cents(F.col("sum_cents")).alias("total_spent"),
        (from_cents(F.col("sum_cents")) / F.col("n")).alias("avg_transaction"),
        (F.sqrt(variance) / 100).alias("std_transaction"),
        from_cents(F.col("min_cents")).alias("min_transaction"),
        from_cents(F.col("max_cents")).alias("max_transaction"),
        "last_transaction",
    )


def incremental_rollup(transactions: DataFrame, state: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(new state, figures) after the days that changed are computed anew.

    Rows that arrive late, share the newest instant, take another's place or have
    a value corrected change their day's count or hash, so their days are among
    them. Transactions of other days are not aggregated again. The whole table is read
    to find the days; where files tell what changed, :mod:`file_increments` does without.
    """
    days = bounded_broadcast(pinned(touched_days(transactions, "transaction_date", state), "days"))
    day = F.col("transaction_date").cast("date")
    fresh = partial_state(transactions.join(days, day.eqNullSafe(days["day"]), "left_semi"))
    kept = state.join(days, state["day"].eqNullSafe(days["day"]), "left_anti")
    both = kept.unionByName(fresh)
    return both, rollup_of(both)
