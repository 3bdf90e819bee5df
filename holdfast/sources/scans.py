"""Readers and the five source scans.

Each scan is projection + filter on bare columns, so both reach a Parquet or
JDBC source. Row order is left to the final output.
"""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from holdfast.functions.columns import days_before, instant, within
from holdfast.sources.schemas import SOURCES

SCORED_STATUSES = ("active", "at_risk")


def read_table(spark: SparkSession, name: str, path: str, fmt: str = "parquet", **options: str) -> DataFrame:
    """A source table from files; text formats get the declared schema instead of inference."""
    reader = spark.read.format(fmt).options(**options)
    if fmt in ("csv", "json"):
        reader = reader.schema(SOURCES[name])
    return conform(reader.load(path), SOURCES[name])


def read_jdbc(
    spark: SparkSession,
    name: str,
    url: str,
    partition_column: str,
    lower: str,
    upper: str,
    partitions: int,
    **options: str,
) -> DataFrame:
    """A source table over JDBC, read in parallel ranges of ``partition_column``.

    Needs the database's driver jar on the classpath.
    """
    reader = spark.read.format("jdbc").options(
        url=url,
        dbtable=name,
        partitionColumn=partition_column,
        lowerBound=lower,
        upperBound=upper,
        numPartitions=str(partitions),
        **options,
    )
    return conform(reader.load(), SOURCES[name])


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Give timestamps and dates their declared type; leave columns that already have it alone."""
    have = {f.name: f.dataType for f in df.schema}
    timelike = (T.TimestampType, T.TimestampNTZType, T.DateType)
    fixes = {
        f.name: F.col(f.name).cast(f.dataType)
        for f in schema
        if f.name in have and isinstance(f.dataType, timelike) and have[f.name] != f.dataType
    }
    return df.withColumns(fixes) if fixes else df


def _present(df: DataFrame, names: list[str]) -> list[str]:
    return [n for n in names if n in df.columns]


def scan_customer_profiles(
    customers: DataFrame,
    as_of: datetime | str,
    lookback_days: int | None = 365,
    statuses: tuple[str, ...] | None = SCORED_STATUSES,
) -> DataFrame:
    """Profile columns and the two derived day counts; None switches a filter off."""
    today = instant(as_of).cast("date")
    if lookback_days is not None:
        customers = customers.where(F.col("registration_date") >= F.date_sub(today, lookback_days))
    if statuses is not None:
        customers = customers.where(F.col("account_status").isin(*statuses))
    return customers.select(
        *_present(customers, SOURCES["customers"].names),
        F.datediff(today, "registration_date").alias("customer_age_days"),
        F.datediff(today, "last_login_date").alias("days_since_last_login"),
    )


def scan_transactions(transactions: DataFrame, as_of: datetime | str, lookback_days: int = 365) -> DataFrame:
    return transactions.where(within(F.col("transaction_date"), as_of, lookback_days)).select(
        *_present(transactions, SOURCES["transactions"].names)
    )


def scan_events(events: DataFrame, as_of: datetime | str, lookback_days: int = 365) -> DataFrame:
    return events.where(within(F.col("event_timestamp"), as_of, lookback_days))


def scan_tickets(tickets: DataFrame, as_of: datetime | str, lookback_days: int = 365) -> DataFrame:
    return tickets.where(within(F.col("created_date"), as_of, lookback_days))


def scan_subscription_history(subscriptions: DataFrame, as_of: datetime | str | None = None) -> DataFrame:
    """Subscriptions with a start date; with ``as_of``, only those already started."""
    kept = subscriptions.where(F.col("subscription_start_date").isNotNull())
    if as_of is not None:
        kept = kept.where(F.col("subscription_start_date") < instant(as_of).cast("date"))
    return kept.select(*_present(subscriptions, SOURCES["subscription_history"].names))


def collect_sources(
    tables: dict[str, DataFrame],
    as_of: datetime | str,
    activity_as_of: datetime | str | None = None,
    lookback_days: int = 365,
) -> dict[str, DataFrame]:
    """The five scans by name, all lazy. Events and tickets may have their own as-of time."""
    activity = activity_as_of or as_of
    return {
        "customers": scan_customer_profiles(tables["customers"], as_of, lookback_days),
        "transactions": scan_transactions(tables["transactions"], as_of, lookback_days),
        "user_events": scan_events(tables["user_events"], activity, lookback_days),
        "support_tickets": scan_tickets(tables["support_tickets"], activity, lookback_days),
        "subscription_history": scan_subscription_history(tables["subscription_history"], as_of),
    }


def source_row_counts(sources: dict[str, DataFrame]) -> DataFrame:
    counts = [
        df.agg(F.count("*").alias("row_count")).select(F.lit(name).alias("source"), "row_count")
        for name, df in sources.items()
    ]
    return reduce(DataFrame.unionByName, counts)
