"""Partial aggregates kept per source file, so that a run reads only the files that changed.

A state folder holds, per run, the partial aggregates of the files which that run read
(``parts/run=N``) and a list of all files the state stands for (``files/run=N``): path,
modification time, length and the run whose parts are valid for it. A run compares the
source's files with the newest list. New and changed files are read; what belongs to
files that are gone or were changed is no longer on the list and so no longer counts.
Late, exchanged, corrected and removed rows change their file, and a compaction
replaces files, so each of them is noticed without a look at other files' rows.

The list is written last. A run that is killed before leaves parts that no list names;
the next run writes them again. A file written again with the same length within the
resolution of the store's clock looks unchanged.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from holdfast.operators.incremental import partial_state
from holdfast.session import pinned

MAX_PATHS = 10_000  # changed files that are read by name
_FILES = "file string, modified timestamp, bytes bigint"


def listing(spark: SparkSession, folder: str, pattern: str = "*.parquet") -> DataFrame:
    """Files below ``folder``: ``path`` to read by, ``file`` as readers name it, time and length. Contents are not read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(folder)
    return files.select(
        "path",
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_modification_time").alias("modified"),
        F.col("_metadata.file_size").alias("bytes"),
    )


def _runs(spark: SparkSession, state: str) -> list[int]:
    """Numbers of the finished runs."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{state}/files")
    store = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not store.exists(folder):
        return []
    names = [f.getPath() for f in store.listStatus(folder) if f.isDirectory()]
    done = [p for p in names if store.exists(spark._jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS"))]
    return sorted(int(p.getName().partition("=")[2]) for p in done)


def known_files(spark: SparkSession, state: str) -> DataFrame:
    """``file, modified, bytes, run`` of the newest list."""
    runs = _runs(spark, state)
    if not runs:
        return spark.createDataFrame([], _FILES + ", run int")
    return spark.read.schema(_FILES + ", run int").parquet(f"{state}/files/run={runs[-1]}")


def changed_files(now: DataFrame, known: DataFrame) -> DataFrame:
    """Files of ``now`` that ``known`` does not list with this time and length."""
    return now.join(known.drop("run"), ["file", "modified", "bytes"], "left_anti")


def read_changed(spark: SparkSession, folder: str, schema, changed: DataFrame) -> DataFrame:
    """The rows of changed files with their ``_file``; few files are read by name, many as a part of the folder."""
    reader = spark.read.schema(schema).option("basePath", folder).option("pathGlobFilter", "*.parquet")
    paths = [r["path"] for r in changed.select("path").limit(MAX_PATHS + 1).collect()]
    if len(paths) <= MAX_PATHS:
        rows = reader.parquet(*paths) if paths else spark.createDataFrame([], schema)
        return rows.withColumn("_file", F.col("_metadata.file_path") if paths else F.lit(None).cast("string"))
    rows = reader.option("recursiveFileLookup", "false").parquet(folder).withColumn("_file", F.col("_metadata.file_path"))
    return rows.join(changed.select(F.col("file").alias("_file")), "_file", "left_semi")


def refresh(
    spark: SparkSession, folder: str, schema, state: str, prepare: Callable[[DataFrame], DataFrame] = lambda rows: rows
) -> int:
    """Bring the state up to the source's files; the number of files that were read.

    ``schema``: of the source files and their partition columns; ``prepare`` gives the columns of
    ``partial_state`` and keeps ``_file``.
    """
    runs = _runs(spark, state)
    run = runs[-1] + 1 if runs else 0
    now = pinned(listing(spark, folder), "listing")
    known = known_files(spark, state)
    changed = pinned(changed_files(now, known), "changed")
    parts = partial_state(prepare(read_changed(spark, folder, schema, changed)), "_file")
    parts.write.mode("overwrite").parquet(f"{state}/parts/run={run}")
    fresh = changed.select("file", "modified", "bytes", F.lit(run).alias("run"))
    kept = known.join(now.select("file", "modified", "bytes"), ["file", "modified", "bytes"], "left_semi")
    kept.unionByName(fresh).coalesce(1).write.mode("overwrite").parquet(f"{state}/files/run={run}")
    return changed.count()


def current(spark: SparkSession, state: str) -> DataFrame:
    """Partial aggregates per file, customer and day of the files on the newest list."""
    parts = spark.read.parquet(f"{state}/parts")
    valid = known_files(spark, state).select(F.col("file").alias("_file"), "run")
    return parts.join(valid, ["_file", "run"], "left_semi").drop("run")
