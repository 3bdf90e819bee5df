"""Order-dependent values without one task ever holding a whole key or the whole table.

Two tools:

* per key: rows of an ordinary key share one window. A key with more than
  ``hot_rows`` rows is reduced to distinct instants and cut into one-minute
  cells, each its own window; what earlier cells pass on is computed from one
  row per cell. Distinct instants bound a cell by the clock's resolution;
* over a whole table: rows are range-partitioned once, written, and running
  values are completed from one total per range partition.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from holdfast.session import pinned

HOT_ROWS = 1_000_000


def split_hot(df: DataFrame, key: str, hot_rows: int = HOT_ROWS) -> tuple[DataFrame, DataFrame]:
    """(rows of ordinary keys, rows of keys with more than ``hot_rows`` rows).

    Both are plans; nothing runs here. Rows per key are counted, combined on the
    map side. Hot keys are broadcast: there are at most as many as the table has
    ``hot_rows`` rows, a million keys for 10^12 rows.
    """
    counts = df.groupBy(F.col(key).alias("_hot")).agg(F.count("*").alias("_rows"))
    hot = F.broadcast(counts.where(F.col("_rows") > hot_rows).select("_hot"))
    # a missing key is one group as well
    same = F.col(key).eqNullSafe(F.col("_hot"))
    return df.join(hot, same, "left_anti"), df.join(hot, same, "left_semi")


def hot_limit(df: DataFrame, key: str, hot_rows: int = HOT_ROWS) -> int | None:
    """``hot_rows`` if some key has more rows, else None: then no plan over ``df`` needs to split keys. One count."""
    heaviest = df.groupBy(key).agg(F.count("*").alias("n")).agg(F.max("n")).first()[0]
    return hot_rows if (heaviest or 0) > hot_rows else None


def instants(df: DataFrame, key: str, ts: str, *extra: Column) -> DataFrame:
    """One row per distinct ``(key, ts)`` with the number of rows there; combined on the map side."""
    return df.groupBy(key, ts).agg(F.count("*").alias("n"), *extra)


def running_max(points: DataFrame, key: str, ts: str, value: Column, name: str, include_current: bool) -> DataFrame:
    """Largest ``value`` of the key over the points before (or up to) each point, for points with a ``_cell``."""
    last = 0 if include_current else -1
    points = points.withColumn("_v", value)
    in_cell = W.partitionBy(key, "_cell").orderBy(ts).rowsBetween(W.unboundedPreceding, last)
    earlier = W.partitionBy(key).orderBy("_cell").rowsBetween(W.unboundedPreceding, -1)
    carry = (
        points.groupBy(key, "_cell")
        .agg(F.max("_v").alias("_top"))
        .select(F.col(key).alias("_key"), F.col("_cell").alias("_at"), F.max("_top").over(earlier).alias("_carry"))
    )
    local = points.withColumn("_local", F.max("_v").over(in_cell))
    return (
        local.join(carry, local[key].eqNullSafe(carry["_key"]) & (local["_cell"] == carry["_at"]))
        .withColumn(name, F.greatest("_local", "_carry"))
        .drop("_v", "_local", "_carry", "_key", "_at")
    )


def hot_instants(hot: DataFrame, key: str, ts: str, *extra: Column) -> DataFrame:
    """Distinct instants of hot keys with ``n``, ``previous`` and their ``_cell``."""
    cell = F.date_trunc("MINUTE", F.col(ts)).cast("timestamp_ntz")
    points = instants(hot, key, ts, *extra).withColumn("_cell", cell)
    return running_max(points, key, ts, F.col(ts), "previous", include_current=False)


def previous_instants(df: DataFrame, key: str, ts: str, hot_rows: int | None = HOT_ROWS) -> DataFrame:
    """``(key, ts, n, previous)``: ``n`` rows at an instant and the key's instant before.

    Ordinary keys give one row per row, so ``previous`` may equal ``ts`` there.
    No key is split where ``hot_rows`` is None.
    """
    rows = df.where(F.col(ts).isNotNull()).select(key, ts)
    plain, hot = (rows, None) if hot_rows is None else split_hot(rows, key, hot_rows)
    before = F.lag(ts).over(W.partitionBy(key).orderBy(ts))
    out = plain.select(key, ts, F.lit(1).cast("bigint").alias("n"), before.alias("previous"))
    if hot is None:
        return out
    return out.unionByName(hot_instants(hot, key, ts).select(key, ts, "n", "previous"))


ROWS_PER_FILE = 500_000


def range_segments(
    df: DataFrame, order: list[Column], partitions: int | None = None, rows: int | None = None
) -> DataFrame:
    """Sort ``df`` over all partitions and fix each row's place.

    ``_segment`` is the range partition and ``_place`` the 0-based place in it.
    Ties must be broken by ``order`` itself for the result to be repeatable.
    The table is written once: places of a recomputed partition could differ.
    With a bound of its ``rows``, it has no more files than that needs.
    """
    # without a number the adaptive planner may merge neighbouring small ranges
    ranged = df.repartitionByRange(*order) if partitions is None else df.repartitionByRange(partitions, *order)
    placed = (
        ranged.sortWithinPartitions(*order)
        .withColumn("_at", F.monotonically_increasing_id())
    )
    if rows is not None:  # ids keep the number of their range partition
        placed = placed.coalesce(1 + rows // ROWS_PER_FILE)
    return (
        pinned(placed, "segments")
        .withColumn("_segment", F.shiftright("_at", 33).cast("int"))
        .withColumn("_place", F.col("_at").bitwiseAND(F.lit((1 << 33) - 1)))
        .drop("_at")
    )


def segment_offsets(segments: DataFrame, totals: dict[str, Column]) -> DataFrame:
    """Per segment, the sum of each total over all earlier segments; one row per range partition."""
    sums = segments.groupBy("_segment").agg(*[e.alias(name) for name, e in totals.items()])
    earlier = W.orderBy("_segment").rowsBetween(W.unboundedPreceding, -1)
    return sums.select(
        "_segment",
        *[F.coalesce(F.sum(name).over(earlier), F.lit(0)).alias(name) for name in totals],
    )


def with_rank(df: DataFrame, order: list[Column], name: str = "position", partitions: int | None = None) -> DataFrame:
    """1-based rank over the whole table; no window spans more than a range partition's total."""
    segments = range_segments(df, order, partitions)
    offsets = segment_offsets(segments, {"_before": F.count("*")})
    return (
        segments.join(F.broadcast(offsets), "_segment")
        .withColumn(name, F.col("_before") + F.col("_place") + 1)
        .drop("_segment", "_place", "_before")
    )


def with_running_sums(
    df: DataFrame, order: list[Column], sums: dict[str, str], partitions: int | None = None, rows: int | None = None
) -> DataFrame:
    """Inclusive running sums of columns over the whole table, in ``order`` (a unique key)."""
    segments = range_segments(df, order, partitions, rows)
    offsets = segment_offsets(segments, {f"_o_{out}": F.sum(src) for out, src in sums.items()})
    so_far = W.partitionBy("_segment").orderBy("_place").rowsBetween(W.unboundedPreceding, 0)
    out = segments.join(F.broadcast(offsets), "_segment")
    for name, src in sums.items():
        out = out.withColumn(name, F.sum(src).over(so_far) + F.col(f"_o_{name}"))
    return out.drop("_segment", "_place", *[f"_o_{name}" for name in sums])
