"""Snapshot tables: one directory per table, partitioned by ``snapshot_ts``."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def snapshot_key(moment: datetime) -> str:
    """Sorts by name in time order."""
    return moment.strftime("%Y%m%d_%H%M%S")


def write_snapshot(df: DataFrame, path: str, moment: datetime) -> None:
    """Add one snapshot. Writing the same moment again replaces that snapshot only.

    Written straight into the partition's folder, so an empty snapshot exists as well.
    """
    df.write.mode("overwrite").parquet(f"{path}/snapshot_ts={snapshot_key(moment)}")


def read_snapshots(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).withColumn("snapshot_ts", F.col("snapshot_ts").cast("string"))


def latest_snapshot(spark: SparkSession, path: str) -> DataFrame:
    """Rows of the newest snapshot; one level of folder names tells which that is, and only it is read."""
    newest = max(snapshot_keys(spark, path))
    return spark.read.parquet(f"{path}/snapshot_ts={newest}").withColumn("snapshot_ts", F.lit(newest))


def snapshot_keys(spark: SparkSession, path: str) -> list[str]:
    """The snapshots below ``path``, from the names of its folders."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(folder)
    names = [f.getPath().getName() for f in files if f.isDirectory()]
    return [n.partition("=")[2] for n in names if n.startswith("snapshot_ts=")]


def append_predictions(predictions: DataFrame, path: str, moment: datetime) -> None:
    """Add the predictions of one run; the same run again replaces its own rows only."""
    write_snapshot(predictions, path, moment)


def write_report(report: DataFrame, path: str) -> None:
    """A one-row report as JSON."""
    report.coalesce(1).write.mode("overwrite").json(path)
