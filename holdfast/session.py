"""Spark session and the shared folder for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_CHECKPOINT_CONF = "spark.checkpoint.dir"


def local_session(cores: str | int = "*", app: str = "holdfast", memory: str = "8g") -> SparkSession:
    """A single-machine session for tests and the bench; clusters bring their own."""
    session = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", "8" if cores == "*" else str(cores))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # call sites for error messages cost more than the calls themselves
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    return session


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it.

    A machine-local folder is used only by a local session that names none.
    """
    folder = spark.conf.get(_CHECKPOINT_CONF, None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {_CHECKPOINT_CONF} to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="holdfast-")
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unused path under the shared folder."""
    return f"{shared_folder(spark)}/holdfast/{label}-{uuid.uuid4().hex}"


def pinned(df: DataFrame, label: str = "pinned") -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage and fixes the values of expressions such as
    ``monotonically_increasing_id``: a lost executor cannot change them later.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bounded_broadcast(df: DataFrame, max_rows: int = 20_000) -> DataFrame:
    """Broadcast ``df`` if it proves to have at most ``max_rows`` rows, else leave the join to a shuffle."""
    rows = df.limit(max_rows + 1).collect()
    if len(rows) > max_rows:
        return df
    return F.broadcast(df.sparkSession.createDataFrame(rows, df.schema))
