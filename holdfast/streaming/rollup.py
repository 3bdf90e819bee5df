"""A stream of transactions merged into the partial aggregates of the customer rollup.

Each batch is one folder of partial aggregates (``parts/batch=N``), written over if the
batch comes again, so a replayed batch changes nothing. Every ``COMPACT`` batches the
folders so far are merged into ``base/upto=N``, partitioned by month, from which readers
start; it is written over as well, and older folders stay until :func:`vacuum`. A stream
that is killed at any point goes on from its checkpoint with the same batch numbers.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from holdfast.operators.incremental import merged, partial_state

COMPACT = 20
_DAY = ("customer_id", "day")


def _numbers(spark: SparkSession, folder: str) -> list[int]:
    """Numbers of the finished folders ``name=N`` in ``folder``."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    store = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not store.exists(path):
        return []
    done = [f.getPath() for f in store.listStatus(path) if f.isDirectory()]
    done = [p for p in done if store.exists(spark._jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS"))]
    return sorted(int(p.getName().partition("=")[2]) for p in done)


def state(spark: SparkSession, path: str, upto: int | None = None) -> DataFrame | None:
    """Partial aggregates per customer and day of all batches (up to number ``upto``); None before the first."""
    within = lambda n: upto is None or n <= upto
    base = max(filter(within, _numbers(spark, f"{path}/base")), default=-1)
    later = [n for n in _numbers(spark, f"{path}/parts") if n > base and within(n)]
    tables = [spark.read.parquet(f"{path}/base/upto={base}").drop("month")] if base >= 0 else []
    if later:
        tables.append(spark.read.parquet(*[f"{path}/parts/batch={n}" for n in later]))
    if not tables:
        return None
    rows = tables[0] if len(tables) == 1 else tables[0].unionByName(tables[1])
    return merged(rows, *_DAY)


def merge_batch(path: str, compact: int = COMPACT) -> Callable[[DataFrame, int], None]:
    """The function for ``foreachBatch`` that puts a batch's partial aggregates into the state at ``path``."""

    def put(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        partial_state(batch).write.mode("overwrite").parquet(f"{path}/parts/batch={number}")
        if (number + 1) % compact == 0:
            month = F.coalesce(F.date_format("day", "yyyy-MM"), F.lit("none"))
            whole = state(spark, path, number).withColumn("month", month)
            whole.write.mode("overwrite").partitionBy("month").parquet(f"{path}/base/upto={number}")

    return put


def start(transactions: DataFrame, path: str, checkpoint: str, compact: int = COMPACT) -> StreamingQuery:
    """Merge what has arrived since the checkpoint, batch by batch."""
    return (
        transactions.writeStream.foreachBatch(merge_batch(path, compact))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def vacuum(spark: SparkSession, path: str) -> None:
    """Remove what the newest base stands for. Not while a reader may still use it."""
    bases = _numbers(spark, f"{path}/base")
    if not bases:
        return
    stale = [f"base/upto={n}" for n in bases[:-1]]
    stale += [f"parts/batch={n}" for n in _numbers(spark, f"{path}/parts") if n <= bases[-1]]
    for name in stale:
        gone = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{name}")
        gone.getFileSystem(spark._jsc.hadoopConfiguration()).delete(gone, True)
