"""Rows of one table inside intervals that begin at rows of another, counted without pairs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def counts_within(rows: DataFrame, at: str, starts: DataFrame, start: str, key: str, days: int) -> DataFrame:
    """``key, start, n``: rows of the key with ``start <= at < start + days``, one row per distinct key and start.

    The number within an interval is the number before its end less the number before
    its start. Times of both tables are put into buckets of the interval's width; a
    running count inside each (key, bucket) is completed by the totals of the key's
    earlier buckets. So work grows with the rows of both tables, however many of them a
    key has, and a key's rows are spread over its buckets. Rows and starts without a key
    or a time are left out.
    """
    width = F.expr(f"INTERVAL '{int(days)}' DAY")
    bucket = F.floor(F.unix_date(F.col("_at").cast("date")) / int(days)).cast("bigint")
    points = rows.select(F.col(key).alias("_key"), F.col(at).alias("_at")).dropna().groupBy("_key", "_at").agg(F.count("*").alias("_n"))
    points = points.select("_key", "_at", F.lit(1).alias("_kind"), "_n", F.lit(None).cast(starts.schema[start].dataType).alias("_start"), F.lit(0).alias("_sign"))
    begins = starts.select(F.col(key).alias("_key"), F.col(start).alias("_start")).dropna().distinct()
    ends = F.explode(F.array(F.struct(F.col("_start").alias("_at"), F.lit(-1).alias("_sign")), F.struct((F.col("_start") + width).alias("_at"), F.lit(1).alias("_sign"))))
    edges = begins.select("_key", "_start", ends.alias("_e")).select(
        "_key", "_e._at", F.lit(0).alias("_kind"), F.lit(0).cast("bigint").alias("_n"), "_start", "_e._sign"
    )
    both = points.unionByName(edges).withColumn("_bucket", bucket)
    # an edge counts what lies before it: at one time edges come first
    so_far = W.partitionBy("_key", "_bucket").orderBy("_at", "_kind").rowsBetween(W.unboundedPreceding, 0)
    before = W.partitionBy("_key").orderBy("_bucket").rowsBetween(W.unboundedPreceding, -1)
    totals = both.groupBy("_key", "_bucket").agg(F.sum("_n").alias("_all"))
    totals = totals.select("_key", "_bucket", F.coalesce(F.sum("_all").over(before), F.lit(0)).alias("_before"))
    counted = both.withColumn("_inside", F.sum("_n").over(so_far)).where("_kind = 0").join(totals, ["_key", "_bucket"])
    return (
        counted.groupBy(F.col("_key").alias(key), F.col("_start").alias(start))
        .agg(F.sum(F.col("_sign") * (F.col("_inside") + F.col("_before"))).alias("n"))
    )
