"""Correlation of all pairs of many columns from one matrix product per batch."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FAN = 64  # matrices that one task adds up


def _sums(batch: pa.RecordBatch, centre: np.ndarray) -> np.ndarray:
    """Of rows where both columns of a pair are known: their number, sums, sums of squares, and sums of products."""
    x = np.column_stack([c.to_numpy(zero_copy_only=False) for c in batch.columns]).astype(float)
    known = ~np.isnan(x)
    x = np.where(known, x - centre, 0.0)
    k = known.astype(float)
    return np.stack([k.T @ k, x.T @ k, (x * x).T @ k, x.T @ x])


def pair_sums(df: DataFrame, columns: list[str], centre: list[float]) -> DataFrame:
    """One row with the four matrices (binary) over all rows: summed in tasks, then in groups, then once."""
    size, at = len(columns), np.array(centre)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((4, size, size))
        for batch in batches:
            for m in batch.column("sums").to_pylist():
                total += np.frombuffer(m).reshape(total.shape)
        yield pa.record_batch([pa.array([total.tobytes()], pa.binary())], names=["sums"])

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((4, size, size))
        for batch in batches:
            if batch.num_rows:
                total += _sums(batch, at)
        yield pa.record_batch([pa.array([total.tobytes()], pa.binary())], names=["sums"])

    rows = df.select(*[F.col(c).cast("double").alias(f"_{k}") for k, c in enumerate(columns)])
    parts = rows.mapInArrow(first, "sums binary")
    return parts.repartition(FAN).mapInArrow(add, "sums binary").repartition(1).mapInArrow(add, "sums binary")


def correlations(df: DataFrame, columns: list[str]) -> DataFrame:
    """``feature_a, feature_b, correlation`` of every pair in the order of ``columns``, over rows where both are known.

    Values are taken less the column's mean first, so large means cost no digits. NULL where
    a column does not vary over those rows. NaN counts as missing. A table is read twice.
    """
    if len(columns) < 2:
        return df.sparkSession.createDataFrame([], "feature_a string, feature_b string, correlation double")
    value = lambda c: F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double"))
    centre = [x or 0.0 for x in df.agg(*[F.avg(value(c)) for c in columns]).first()]

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for m in batch.column("sums").to_pylist():
                n, s, q, p = np.frombuffer(m).reshape(4, len(columns), len(columns))
                spread = n * q - s * s
                spread[spread <= 1e-12 * n * q] = 0.0  # rounding of a column that does not vary
                with np.errstate(invalid="ignore", divide="ignore"):
                    r = (n * p - s * s.T) / np.sqrt(spread * spread.T)
                a, b = np.triu_indices(len(columns), 1)
                values = np.where(np.isfinite(r[a, b]), np.clip(r[a, b], -1, 1), np.nan)
                names = pa.array(columns)
                yield pa.record_batch(
                    [names.take(pa.array(a)), names.take(pa.array(b)), pa.array(values, mask=np.isnan(values))],
                    names=["feature_a", "feature_b", "correlation"],
                )

    return pair_sums(df, columns, centre).mapInArrow(finish, "feature_a string, feature_b string, correlation double")
