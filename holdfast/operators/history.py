"""Queries over a history of predictions or metrics: best row, last N, side by side."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def best_row_per_group(df: DataFrame, group: str, metric: str, tie: str, ascending: bool = False) -> DataFrame:
    """The row with the best ``metric`` per group; NULL metrics lose, ties go to the smallest ``tie``.

    ``row_number() = 1`` is limited per map task before the shuffle, so a
    group of any size sends at most one row from each.
    """
    known = df.where(F.col(metric).isNotNull())
    order = F.col(metric).asc() if ascending else F.col(metric).desc()
    ranked = known.withColumn("_n", F.row_number().over(W.partitionBy(group).orderBy(order, F.col(tie).asc())))
    return ranked.where(F.col("_n") == 1).drop("_n")


def keep_last_n(df: DataFrame, key: str, ts: str, tie: str, n: int = 10) -> DataFrame:
    """The ``n`` newest rows per key, of equal times those with the smallest ``tie``; limited per map task before the shuffle as well."""
    order = W.partitionBy(key).orderBy(F.col(ts).desc(), F.col(tie).asc())
    ranked = df.withColumn("recency_rank", F.row_number().over(order))
    return ranked.where(F.col("recency_rank") <= n)


def compare_snapshots(metrics: DataFrame, snapshots: list[str]) -> DataFrame:
    """One row per metric, one column per chosen snapshot, from long (snapshot_ts, metric, value)."""
    return (
        metrics.where(F.col("snapshot_ts").isin(*snapshots))
        .groupBy("metric")
        .pivot("snapshot_ts", snapshots)
        .agg(F.first("value"))
    )
