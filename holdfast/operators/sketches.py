"""Mergeable sketches beside the exact operators: distinct counts per day, and quantiles kept with a snapshot."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from holdfast.operators.monitoring import FEATURE_DRIFT_LIMIT, _psi

LG_K = 12  # 4096 cells: a standard error of 1.04 / sqrt(4096), about 1.6 %
KLL_K = 400  # a rank error of about 0.66 %


def daily_distinct(rows: DataFrame, column: str, ts: str, key: str = "customer_id", lg_k: int = LG_K) -> DataFrame:
    """``key, day, sketch``: a sketch of the day's distinct non-null values; texts or whole numbers."""
    found = rows.where(F.col(column).isNotNull()).groupBy(key, F.col(ts).cast("date").alias("day"))
    return found.agg(F.hll_sketch_agg(column, lg_k).alias("sketch"))


def merged_distinct(daily: DataFrame, name: str, *by: str) -> DataFrame:
    """``by, name``: distinct values of all days of a group, estimated from their sketches; no raw rows."""
    return daily.groupBy(*by).agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias(name))


def snapshot_sketches(df: DataFrame, columns: list[str], k: int = KLL_K) -> DataFrame:
    """``feature, known, missing, sketch`` of each column's values, to be kept with the snapshot; one aggregate."""
    value = lambda c: F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double"))
    found = df.agg(
        *[
            F.struct(
                F.count(value(c)).alias("known"),
                F.count_if(value(c).isNull()).alias("missing"),
                F.kll_sketch_agg_double(value(c), k).alias("sketch"),
            ).alias(f"_{i}")
            for i, c in enumerate(columns)
        ]
    )
    entries = [F.struct(F.lit(c).alias("feature"), F.col(f"_{i}").alias("s")) for i, c in enumerate(columns)]
    return found.select(F.inline(F.array(*entries))).select("feature", "s.known", "s.missing", "s.sketch")


def sketch_drift_psi(baseline: DataFrame, current: DataFrame, limit: float = FEATURE_DRIFT_LIMIT) -> DataFrame:
    """The index of :func:`monitoring.feature_drift_psi` from two snapshots' sketches; raw rows are not needed.

    Decile bins of the baseline's sketch, one more for missing values; counts per bin come from
    ranks, so each is right within the sketch's rank error times its rows. Columns are those of the baseline.
    """
    tenths = F.array(*[F.lit(i / 10) for i in range(1, 10)])
    cuts = F.when(F.col("known") > 0, F.array_distinct(F.kll_sketch_get_quantile_double("sketch", tenths)))
    # at most nine numbers a column; ranks are asked for by literals
    at = {r["feature"]: r["cuts"] or [] for r in baseline.select("feature", cuts.alias("cuts")).collect()}

    def counts(snapshot: DataFrame, name: str) -> DataFrame:
        """Rows per bin, the missing ones last."""
        known, missing = F.coalesce("known", F.lit(0)).cast("double"), F.coalesce("missing", F.lit(0)).cast("double")
        upto = F.lit(None).cast("array<double>")
        for feature, values in at.items():
            ranks = F.kll_sketch_get_rank_double("sketch", F.array(*map(F.lit, values))) if values else F.array().cast("array<double>")
            zeros = F.array(*[F.lit(0.0) for _ in values]).cast("array<double>")
            upto = F.when(F.col("feature") == feature, F.when(known > 0, F.transform(ranks, lambda r: r * known)).otherwise(zeros)).otherwise(upto)
        rows = snapshot.where(F.col("feature").isin(list(at))).withColumn("upto", F.concat(upto, F.array(known)))
        bins = F.transform("upto", lambda x, i: x - F.when(i > 0, F.get("upto", i - 1)).otherwise(0.0))
        return rows.select("feature", F.posexplode(F.concat(bins, F.array(missing))).alias("bin", name))

    return _psi(counts(baseline, "base"), counts(current, "now"), limit)
