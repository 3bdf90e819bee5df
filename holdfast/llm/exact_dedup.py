"""Exact duplicates by Grace hashing.

Records are dealt to buckets by a hash of their normalised content. How many
buckets the contents need, and which would not fit a task's table, comes from
the sizes of the distinct contents, summed over a fixed number of hash cells.
A bucket that does not fit is spilled to a written table and split by another
hash, level by level. Each bucket that fits is read by one task into an
open-addressing table which compares complete contents. Copies are combined in
the tasks that read the input, by the same table, so a content with any number
of copies reaches its bucket as one record per reading task and flush, and never
fills a table.

Cases: null text counts as empty; empty texts are copies of one another; among
equal texts the row with the most code points stays, then the smallest id, an
absent id last; of rows that repeat id and text one stays; an empty table gives
no rows; other columns pass through, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from holdfast.llm.store import registry, text_of, whole_row, written
from holdfast.llm.text import forget, release

TABLE_BYTES = 32 << 20
FANOUT = 16
CELLS = 1 << 16  # hash cells whose sizes are collected; buckets of the first level at most
_SPACE = r"[\x20\x09-\x0D]+"

QUERIES, ORACLE, query = registry()


class ContentTable:
    """Open addressing with linear probing; an entry is found by hash and then by its complete content."""

    def __init__(self) -> None:
        self.clear()

    def clear(self) -> None:
        self.slots, self.mask = [-1] * 1024, 1023
        self.hashes, self.contents, self.counts, self.best = [], [], [], []
        self.bytes = 0

    def add(self, h: int, content: bytes, n: int, chars: int, key) -> None:
        at = h & self.mask
        while (e := self.slots[at]) >= 0:
            if self.hashes[e] == h and self.contents[e] == content:
                self.counts[e] += n
                if _before(chars, key, *self.best[e]):
                    self.best[e] = (chars, key)
                return
            at = (at + 1) & self.mask
        self.slots[at] = len(self.hashes)
        self.hashes.append(h), self.contents.append(content), self.counts.append(n), self.best.append((chars, key))
        self.bytes += len(content)
        if 2 * len(self.hashes) > self.mask:
            self._grow()

    def _grow(self) -> None:
        self.mask = 2 * self.mask + 1
        self.slots = [-1] * (self.mask + 1)
        for e, h in enumerate(self.hashes):
            at = h & self.mask
            while self.slots[at] >= 0:
                at = (at + 1) & self.mask
            self.slots[at] = e


def _before(chars: int, key, other_chars: int, other) -> bool:
    """More code points first, then the smaller id, no id last."""
    if chars != other_chars:
        return chars > other_chars
    return key is not None and (other is None or key < other)


def normalised(text: Column) -> Column:
    """Text without the characters of ``[\\x20\\x09-\\x0D]``."""
    return F.regexp_replace(text, _SPACE, "")


def _record(id_type: T.DataType) -> T.StructType:
    return T.StructType(
        [
            T.StructField("hash", T.LongType()),
            T.StructField("content", T.BinaryType()),
            T.StructField("n", T.LongType()),
            T.StructField("chars", T.LongType()),
            T.StructField("id", id_type),
        ]
    )


def _rows(batch: pa.RecordBatch):
    return zip(*(batch.column(c).to_pylist() for c in ("hash", "content", "n", "chars", "id")))


def _combiner(limit: int, id_type: pa.DataType):
    """Records with equal contents of a task become one, as long as they fit the table together."""

    def emit(table: ContentTable) -> Iterator[pa.RecordBatch]:
        step = max(1, len(table.hashes) * (4 << 20) // max(1, table.bytes))
        for lo in range(0, len(table.hashes), step):
            part = slice(lo, lo + step)
            yield pa.record_batch(
                {
                    "hash": pa.array(table.hashes[part], pa.int64()),
                    "content": pa.array(table.contents[part], pa.binary()),
                    "n": pa.array(table.counts[part], pa.int64()),
                    "chars": pa.array([b[0] for b in table.best[part]], pa.int64()),
                    "id": pa.array([b[1] for b in table.best[part]], id_type),
                }
            )
        table.clear()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        table = ContentTable()
        for batch in batches:
            for row in _rows(batch):
                table.add(*row)
                if table.bytes > limit:
                    yield from emit(table)
        yield from emit(table)
        release()

    return run


def _group_finder(id_type: pa.DataType):
    """Groups of equal contents of each bucket; records come bucket by bucket."""

    def emit(table: ContentTable) -> Iterator[pa.RecordBatch]:
        if table.hashes:
            yield pa.record_batch(
                {
                    "digest": pa.array([hashlib.sha256(c).digest() for c in table.contents], pa.binary()),
                    "keep_id": pa.array([b[1] for b in table.best], id_type),
                    "keep_chars": pa.array([b[0] for b in table.best], pa.int64()),
                    "group_size": pa.array(table.counts, pa.int64()),
                }
            )
        table.clear()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        table, now = ContentTable(), None
        for batch in batches:
            for bucket, row in zip(batch.column("bucket").to_pylist(), _rows(batch)):
                if bucket != now:
                    yield from emit(table)
                    now = bucket
                table.add(*row)
        yield from emit(table)
        release()

    return run


def _arrow(kind: T.DataType) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(kind)


def groups(
    docs: DataFrame, text: str = "text", id: str = "doc_id", table_bytes: int = TABLE_BYTES, fanout: int = FANOUT
) -> DataFrame:
    """One row per distinct normalised text: ``digest`` (SHA-256, binary), ``keep_id``, ``keep_chars``, ``group_size``.

    ``table_bytes``: contents that one task's table may hold; ``fanout``: parts of a bucket that exceeds it.
    """
    id_type = docs.schema[id].dataType
    body = text_of(docs, text)
    content = normalised(body)
    records = docs.select(
        F.xxhash64(content).alias("hash"),
        content.cast("binary").alias("content"),
        F.lit(1).cast("long").alias("n"),
        F.char_length(body).cast("long").alias("chars"),
        F.col(id).alias("id"),
    )
    buckets, over = _first_buckets(records, table_bytes)
    bucket = F.pmod(_cell(), F.lit(buckets))
    combined = records.mapInArrow(_combiner(table_bytes, _arrow(id_type)), _record(id_type)).withColumn("bucket", bucket)
    if not over:
        return written(_in_buckets(combined, id_type, buckets), "groups")
    over = F.broadcast(docs.sparkSession.createDataFrame([(b,) for b in over], "bucket long"))  # at most CELLS rows
    found = [_in_buckets(combined.join(over, "bucket", "left_anti"), id_type, buckets)]
    spill = written(combined.join(over, "bucket", "left_semi"), "spill")
    level, buckets = 0, buckets * fanout
    while True:
        level += 1
        part = F.pmod(F.xxhash64("hash", F.lit(level)), F.lit(fanout))
        spill = spill.withColumn("bucket", F.xxhash64("bucket", part))
        # distinct contents by their hashes; one content alone cannot be split and needs one entry
        over = (
            spill.groupBy("bucket", "hash")
            .agg(F.max(F.length("content")).alias("bytes"))
            .groupBy("bucket")
            .agg(F.sum("bytes").alias("bytes"), F.count("*").alias("contents"))
            .where((F.col("bytes") > table_bytes) & (F.col("contents") > 1))
            .select("bucket")
        )
        over = written(over, "over")
        n_over = over.count()
        found.append(_in_buckets(spill if not n_over else spill.join(over, "bucket", "left_anti"), id_type, buckets))
        if not n_over:
            break
        spill = written(spill.join(over, "bucket", "left_semi"), "spill")
        buckets = n_over * fanout
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return written(out, "groups")


def _cell() -> Column:
    return F.pmod(F.xxhash64("hash", F.lit(0)), F.lit(CELLS))


def _first_buckets(records: DataFrame, table_bytes: int) -> tuple[int, list[int]]:
    """The number of buckets, a power of two, and those whose distinct contents exceed the table."""
    sizes = records.groupBy("hash").agg(F.max(F.length("content")).cast("long").alias("bytes"))
    sizes = sizes.groupBy(_cell().alias("cell")).agg(F.sum("bytes").alias("bytes"), F.count("*").alias("contents")).collect()
    total, buckets = sum(r["bytes"] for r in sizes), 1
    while buckets < CELLS and buckets * table_bytes < 2 * total:
        buckets *= 2
    in_bucket: dict[int, list[int]] = {}
    for r in sizes:
        held = in_bucket.setdefault(r["cell"] % buckets, [0, 0])
        held[0] += r["bytes"]
        held[1] += r["contents"]
    return buckets, [b for b, (size, contents) in in_bucket.items() if size > table_bytes and contents > 1]


def _in_buckets(records: DataFrame, id_type: T.DataType, buckets: int) -> DataFrame:
    schema = T.StructType(
        [
            T.StructField("digest", T.BinaryType()),
            T.StructField("keep_id", id_type),
            T.StructField("keep_chars", T.LongType()),
            T.StructField("group_size", T.LongType()),
        ]
    )
    return (
        records.select("bucket", "hash", "content", "n", "chars", "id")
        .repartition(buckets, "bucket")
        .sortWithinPartitions("bucket")
        .mapInArrow(_group_finder(_arrow(id_type)), schema)
        .coalesce(buckets)
    )


def _digest(text: Column) -> Column:
    return F.unhex(F.sha2(normalised(text), 256))


def mark_duplicates(docs: DataFrame, text: str = "text", id: str = "doc_id", **sizes: int) -> DataFrame:
    """One row per row of ``docs``: its id, ``keep_id``, ``group_size``, ``kept`` and ``text_sha256``."""
    body = text_of(docs, text)
    rows = docs.select(F.col(id).alias("id"), _digest(body).alias("digest"), F.char_length(body).alias("chars"))
    # the groups are a written table, so both sides of the join are exchanged and a group of many copies can be split
    joined = rows.join(groups(docs, text, id, **sizes), "digest")
    stays = F.col("id").eqNullSafe(F.col("keep_id")) & (F.col("chars") == F.col("keep_chars"))
    # by the pair as one value: the rows are dealt anew, and the join above stays free to split a large group
    first = F.row_number().over(W.partitionBy(F.struct("digest", "id")).orderBy(F.desc("chars")))
    return joined.withColumn("place", first).select(
        F.col("id").alias(id),
        "keep_id",
        "group_size",
        (stays & (F.col("place") == 1)).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def drop_duplicates(docs: DataFrame, text: str = "text", id: str = "doc_id", **sizes: int) -> DataFrame:
    """The rows of ``docs`` that stay, with their own columns."""
    body = text_of(docs, text)
    rows = docs.select(
        whole_row(docs), docs[id].alias("id"), _digest(body).alias("digest"), F.char_length(body).alias("chars")
    )
    best = groups(docs, text, id, **sizes).select(
        F.col("digest").alias("best"), "keep_id", F.col("keep_chars").alias("best_chars")
    )
    # joined by id and content, so that the rows of a large group lie apart
    same = rows["id"].eqNullSafe(best["keep_id"]) & (rows["digest"] == best["best"])
    place = F.row_number().over(W.partitionBy("digest", "id").orderBy(F.desc("chars")))
    return rows.join(best, same).withColumn("place", place).where("place = 1").select("row.*")


@query(
    r"""
    WITH t AS (SELECT doc_id, coalesce(text, '') AS body FROM documents),
    d AS (SELECT doc_id, length(body) AS chars, sha256(regexp_replace(body, '[\x20\x09-\x0D]+', '', 'g')) AS s FROM t),
    k AS (SELECT doc_id, s, first_value(doc_id) OVER (PARTITION BY s ORDER BY chars DESC, doc_id) AS keep_id,
                 count(*) OVER (PARTITION BY s) AS group_size FROM d)
    SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, s AS text_sha256 FROM k
    """
)
def op3_exact_dedup(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return mark_duplicates(docs)
