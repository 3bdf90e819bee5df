"""Source snapshots laid out by customer, so that groups aggregate and join without an exchange."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from holdfast.functions.ordering import HOT_ROWS, hot_limit


def write_bucketed(df: DataFrame, name: str, path: str, buckets: int, key: str = "customer_id", hot_rows: int = HOT_ROWS) -> DataFrame:
    """Save ``df`` as table ``name`` at ``path`` in ``buckets`` buckets by ``key``, sorted, one file a bucket; the table as a DataFrame.

    The same number of buckets in all tables makes joins meet bucket by bucket. Where a
    key has more than ``hot_rows`` rows its bucket would be one long task, so that
    table is written in plain files and exchanges as usual.
    """
    write = df.write
    if hot_limit(df, key, hot_rows) is None:
        write = df.repartition(buckets, key).write.bucketBy(buckets, key).sortBy(key)
    write.mode("overwrite").option("path", path).saveAsTable(name)
    return df.sparkSession.table(name)


def bucketed_sources(tables: dict[str, DataFrame], path: str, prefix: str, buckets: int) -> dict[str, DataFrame]:
    """Every source as a bucketed table ``prefix_name`` below ``path``."""
    return {n: write_bucketed(t, f"{prefix}_{n}", f"{path}/{n}", buckets) for n, t in tables.items()}


def drop_tables(spark: SparkSession, tables: dict[str, DataFrame], prefix: str) -> None:
    """Forget the tables; their files stay."""
    for n in tables:
        spark.sql(f"DROP TABLE IF EXISTS {prefix}_{n}")
