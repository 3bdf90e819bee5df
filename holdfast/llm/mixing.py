"""Mixing sources to target weights by weighted fair queueing.

Every document is queued once per allowed repeat, in the shuffled order of its
source. Its virtual finish time is the words of its source up to and including
it, divided by the source's target. The queue of all sources is range-sorted by
finish time and truncated at the total budget, so each source is cut at about
finish time 1, where its words meet its target. Running sums are taken inside
range partitions and completed by one total per partition; a source with most
of the rows is spread over many partitions.

Cases: null text has size 0; a document without words is never taken; an absent
source is a source of its own, ordered last; repeated rows are separate
documents; equal finish times are ordered by source, repeat and shuffle key; an
empty table gives no rows; other columns pass through :func:`mixed`.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from holdfast.functions.ordering import with_running_sums
from holdfast.llm.store import registry, text_of, whole_row, written
from holdfast.llm.text import WORD

WEIGHTS = (5, 2, 1)
SHARE = 1.5
REPEATS = 2

QUERIES, ORACLE, query = registry()


def words_in(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def targets(sizes: DataFrame, weights: Sequence[int], share: float, repeats: int) -> DataFrame:
    """``source, source_size, target, queued_before, budget`` per source; the budget is that of all.

    Weights repeat over the sources in code point order. Targets share ``share``
    times all words by weight; a target stops at ``repeats`` times its source's
    words and its excess goes to the others by weight: the level at which the
    capped targets add up to the budget is found over the sources in the order in
    which they reach their caps. One row per source goes through one task.
    """
    by_name = W.orderBy(F.col("source").asc_nulls_last())
    place = F.row_number().over(by_name)
    weight = F.array(*[F.lit(float(w)) for w in weights])[(place - 1) % len(weights)]
    cap = F.lit(float(repeats)) * F.col("source_size")
    per_source = (
        sizes.groupBy("source")
        .agg(F.sum("size").alias("source_size"))
        .withColumn("place", place)
        .withColumn("weight", weight)
        .withColumn("cap", cap)
        .withColumn("queued_before", F.lit(repeats) * F.sum("source_size").over(by_name) - F.lit(repeats) * F.col("source_size"))
    )
    by_cap = W.orderBy(F.col("cap") / F.col("weight"), "place")
    before, onward = by_cap.rowsBetween(W.unboundedPreceding, -1), by_cap.rowsBetween(0, W.unboundedFollowing)
    everything = W.partitionBy(F.lit(0))
    budget = F.lit(float(share)) * F.sum("source_size").over(everything)
    per_source = per_source.withColumn("budget", budget)
    level = (F.col("budget") - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("weight").over(onward)
    levels = per_source.withColumn("level", level).withColumn("at", F.row_number().over(by_cap))
    open_at = F.when(F.col("level") <= F.col("cap") / F.col("weight"), F.struct("at", "level"))
    level = F.min(open_at).over(everything)["level"]
    return levels.select(
        "source",
        "source_size",
        F.when(F.col("source_size") == 0, 0.0).otherwise(F.least("cap", F.coalesce(level * F.col("weight"), "cap"))).alias("target"),
        "queued_before",
        "budget",
    )


def plan(
    docs: DataFrame,
    text: str = "text",
    id: str = "doc_id",
    source: str = "source",
    weights: Sequence[int] = WEIGHTS,
    share: float = SHARE,
    repeats: int = REPEATS,
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, hash, copy, size, source_size, target, taken``.

    ``copy`` numbers the rows that share an id, a text (its ``hash``) and a source; ``taken`` counts words with repeats.
    """
    return _plan(docs, text, id, source, weights, share, repeats).drop("source")


def _plan(docs: DataFrame, text: str, id: str, source: str, weights: Sequence[int], share: float, repeats: int) -> DataFrame:
    """The rows of :func:`plan` with their source."""
    body = text_of(docs, text)
    rows = docs.select(F.col(id).alias("doc_id"), F.col(source).alias("source"), words_in(body).alias("size"), F.xxhash64(body).alias("hash"))
    n = docs.count()
    rows = written(rows.withColumn("copy", _copy()), "sizes", n)
    goals = written(targets(rows, weights, share, repeats), "targets", n)
    epoch = F.explode(F.sequence(F.lit(0), F.lit(repeats - 1)))
    key = F.md5(F.concat_ws(":", F.col("doc_id").cast("string"), F.col("epoch").cast("string")))
    queue = rows.where("size > 0").withColumn("epoch", epoch).withColumn("key", key)
    shuffled = [F.col("source").asc_nulls_last(), *map(F.col, ("epoch", "key", "size", "hash", "copy"))]
    queue = with_running_sums(queue, shuffled, {"up_to": "size"}, rows=repeats * n)
    finish = (F.col("up_to") - F.col("queued_before")) / F.col("target")
    same = queue["source"].eqNullSafe(goals["source"])
    queue = queue.join(goals, same).drop(goals["source"]).withColumn("finish", finish)
    queue = with_running_sums(queue.drop("up_to"), [F.col("finish"), *shuffled], {"total": "size"}, rows=repeats * n)
    took = (
        queue.where(F.col("total") <= F.col("budget"))
        .groupBy(*[F.col(c).alias(f"_{c}") for c in _ROW])
        .agg(F.sum("size").alias("taken"))
    )
    rows = rows.join(goals.withColumnRenamed("source", "_of"), F.col("source").eqNullSafe(F.col("_of"))).drop("_of")
    same = F.col("doc_id").eqNullSafe(F.col("_doc_id")) & F.col("source").eqNullSafe(F.col("_source"))
    out = rows.join(took, same & (F.col("hash") == F.col("_hash")) & (F.col("copy") == F.col("_copy")), "left")
    return out.select("doc_id", "hash", "source", "copy", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).alias("taken"))


_ROW = ("doc_id", "source", "hash", "copy")


def _copy() -> Column:
    """Numbers rows with one id, text and source; they are interchangeable."""
    return F.row_number().over(W.partitionBy("doc_id", "hash", "source").orderBy(F.lit(0)))


def mixed(
    docs: DataFrame,
    text: str = "text",
    id: str = "doc_id",
    source: str = "source",
    weights: Sequence[int] = WEIGHTS,
    share: float = SHARE,
    repeats: int = REPEATS,
) -> DataFrame:
    """The rows of ``docs`` that the mix takes, as often as it takes them, with their own columns."""
    rows = docs.select(whole_row(docs), docs[id].alias("doc_id"), docs[source].alias("source"), F.xxhash64(text_of(docs, text)).alias("hash"))
    rows = rows.withColumn("copy", _copy())
    # of interchangeable rows, how many are taken once at least, twice at least and so on; then the first ones are
    taken = _plan(docs, text, id, source, weights, share, repeats).where("taken > 0")
    times = (F.col("taken") / F.col("size")).cast("int")
    upto = F.array(*[F.count_if(times >= k + 1) for k in range(repeats)]).alias("upto")
    taken = taken.groupBy(*[F.col(c).alias(f"_{c}") for c in _ROW[:-1]]).agg(upto)
    same = F.col("doc_id").eqNullSafe(F.col("_doc_id")) & F.col("source").eqNullSafe(F.col("_source")) & (F.col("hash") == F.col("_hash"))
    each = F.filter("upto", lambda n: n >= F.col("copy"))
    return rows.join(taken, same).select("row", F.explode(each)).select("row.*")


MIX_SQL = r"""
    d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size FROM {docs}),
    s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
                 [5.0::DOUBLE, 2.0::DOUBLE, 1.0::DOUBLE][1 + CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS INT)] AS weight,
                 row_number() OVER (ORDER BY source NULLS LAST) AS place FROM d GROUP BY source),
    c AS (SELECT *, 2.0::DOUBLE * source_size AS cap, 2.0::DOUBLE * source_size / weight AS ratio FROM s),
    l AS (SELECT *, (1.5::DOUBLE * (SELECT sum(source_size) FROM s)
                     - coalesce(sum(cap) OVER (ORDER BY ratio, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
                    / sum(weight) OVER (ORDER BY ratio, place ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM c),
    t AS (SELECT source, source_size, CASE WHEN source_size = 0 THEN 0.0::DOUBLE ELSE
                 least(cap, (SELECT level FROM l WHERE level <= ratio ORDER BY ratio, place LIMIT 1) * weight) END AS target FROM l),
    q AS (SELECT d.*, e.epoch, md5(concat_ws(':', doc_id, e.epoch)) AS k FROM d, (VALUES (0), (1)) e(epoch) WHERE size > 0),
    f AS (SELECT q.doc_id, q.source, q.epoch, q.k, q.size,
                 sum(q.size) OVER (PARTITION BY q.source ORDER BY q.epoch, q.k ROWS UNBOUNDED PRECEDING)::DOUBLE / t.target AS finish
          FROM q JOIN t ON q.source IS NOT DISTINCT FROM t.source),
    g AS (SELECT *, sum(size) OVER (ORDER BY finish, source NULLS LAST, epoch, k ROWS UNBOUNDED PRECEDING) AS total FROM f),
    k AS (SELECT doc_id, CAST(sum(size) AS BIGINT) AS taken FROM g WHERE total <= 1.5 * (SELECT sum(size) FROM d) GROUP BY doc_id),
    m AS (SELECT d.doc_id, d.size, t.source_size, t.target, coalesce(k.taken, 0) AS taken
          FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source LEFT JOIN k ON d.doc_id = k.doc_id)"""


@query("WITH" + MIX_SQL.format(docs="documents") + " SELECT * FROM m")
def op4_fair_mixing(spark, sf_dir):
    return plan(spark.read.parquet(f"{sf_dir}/documents.parquet")).drop("hash", "copy")
