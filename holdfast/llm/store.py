"""Intermediate tables in the shared folder, and unclashing work columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from holdfast.session import scratch_path


FILE_BYTES = 16 << 20  # of text that one task of an expensive stage takes


def text_bytes(docs: DataFrame, text: str = "text") -> int:
    """Bytes of all texts."""
    return docs.agg(F.sum(F.octet_length(docs[f"`{text}`"].cast("string")))).first()[0] or 0


def written(df: DataFrame, label: str, rows: int | None = None, per_file: int = 500_000) -> DataFrame:
    """Write ``df`` as compressed Parquet below ``spark.checkpoint.dir`` and read it back.

    Cuts the lineage and fixes row numbers and flush points; a lost executor cannot change them.
    With a bound of its ``rows`` (or bytes), it has no more files (and tasks in the last stage) than
    that needs at ``per_file``: rows of a fixed width are counted, rows with texts or sets go by bytes.
    """
    path = scratch_path(df.sparkSession, label)
    if rows is not None:
        df = df.coalesce(1 + rows // per_file)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def whole_row(df: DataFrame) -> Column:
    """All columns as one struct, so that work columns cannot clash with them; ``select("row.*")`` brings them back."""
    return F.struct(*[df[f"`{c}`"] for c in df.columns]).alias("row")


def text_of(df: DataFrame, column: str = "text") -> Column:
    """A text column, null as empty."""
    return F.coalesce(df[column].cast("string"), F.lit(""))


def registry() -> tuple[dict, dict, object]:
    """Queries, their SQL, and the decorator that registers both."""
    queries: dict = {}
    oracle: dict[str, str] = {}

    def query(sql: str | None = None):
        def register(fn):
            queries[fn.__name__] = fn
            if sql is not None:
                oracle[fn.__name__] = sql
            return fn

        return register

    return queries, oracle, query
