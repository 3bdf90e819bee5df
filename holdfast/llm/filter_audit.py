"""How filters interact: what each removes at each step of every order, and its Shapley value.

A document is a bit mask of the filters that it fails. For each part of the table,
counts per mask give what every coalition of filters removes (32 coalitions of
five filters, the empty one included); a coalition's removals hold all that the
orders need: a step removes the difference of two coalitions. The Shapley value
of the removals is the solution of a constrained least squares problem: additive
values that fit all coalitions, weighted by the Shapley kernel, and add up to what
all filters remove. Its normal equations with the constraint are the same for all
parts, so they are solved once, in rationals, for the matrix that takes coalition
removals to values; times the number of orders it is whole, and Spark applies it
to each part.

Rows are reduced to (part, mask) counts on the map side, at most 32 rows a part,
whatever a part's share of the table. A text's first id is found by digest, and
rows are compared with it by (digest, id), so that copies of one text lie apart.

Cases: null text counts as empty (it fails A, and no share); a null part is the
empty string, together with parts of that name; a row without id is identical to no
*smaller* id and gives none; rows that repeat an id and text are equal to each other,
not to a smaller one; of repeated labels of an id any 1 counts, and without labels
a document is neither good nor toxic; an empty table gives no rows; other columns
are not read.
"""

from __future__ import annotations

from collections.abc import Sequence
from fractions import Fraction
from itertools import permutations
from math import comb, factorial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from holdfast.llm.store import registry, text_of
from holdfast.llm.text import WORD

MIN_WORDS = 50
MIN_DISTINCT = 65  # distinct words in a hundred
MAX_CAPITALS = 5  # capitals in a hundred characters
SYMBOLS = r"[#$%&*|]"
FILTERS = "ABCDE"

QUERIES, ORACLE, query = registry()


def solved(matrix: Sequence[Sequence[Fraction]], right: Sequence[Sequence[Fraction]]) -> list[list[Fraction]]:
    """X with ``matrix`` X = ``right``, by Gauss-Jordan elimination in rationals."""
    rows = [[*map(Fraction, m), *map(Fraction, r)] for m, r in zip(matrix, right)]
    for k in range(len(rows)):
        pivot = next(i for i in range(k, len(rows)) if rows[i][k])
        rows[k], rows[pivot] = rows[pivot], rows[k]
        rows[k] = [x / rows[k][k] for x in rows[k]]
        for i in range(len(rows)):
            if i != k and (factor := rows[i][k]):
                rows[i] = [x - factor * y for x, y in zip(rows[i], rows[k])]
    return [row[len(matrix) :] for row in rows]


def shapley_matrix(n: int) -> list[list[Fraction]]:
    """Of each filter, the coefficients by which its Shapley value is a sum over all 2^n coalition removals.

    Least squares over the coalitions between the empty and the full one, with kernel weights
    (n - 1) / (C(n, s) s (n - s)), under the constraint that the values add up to what all remove.
    A Lagrange multiplier makes the constraint the last normal equation.
    """
    whole = (1 << n) - 1
    members = lambda s: [i for i in range(n) if s >> i & 1]
    left = [[Fraction(0)] * (n + 1) for _ in range(n + 1)]
    right = [[Fraction(0)] * (1 << n) for _ in range(n + 1)]
    for s in range(1, whole):
        size = s.bit_count()
        weight = Fraction(n - 1, comb(n, size) * size * (n - size))
        for i in members(s):
            right[i][s] += weight
            for j in members(s):
                left[i][j] += weight
    for i in range(n):
        left[i][n] = left[n][i] = Fraction(1)
    right[n][whole] = Fraction(1)
    return solved(left, right)[:n]


def failures(text: Column) -> list[Column]:
    """Whether a text fails each of the filters that look at it alone."""
    words = F.regexp_extract_all(text, F.lit(WORD), F.lit(0))
    capitals = F.regexp_count(text, F.lit("[A-Z]"))
    return [
        F.size(words) < MIN_WORDS,
        100 * F.size(F.array_distinct(words)) < MIN_DISTINCT * F.size(words),
        100 * capitals.cast("long") > MAX_CAPITALS * F.char_length(text),
        text.rlike(SYMBOLS),
    ]


def masks(docs: DataFrame, text: str = "text", id: str = "doc_id", part: str = "source") -> DataFrame:
    """``id, part, mask, n``: numbers of rows that repeat an id, a text and a part; bit k of the mask is filter k."""
    body = text_of(docs, text)
    bits = [F.when(fails, 1 << k).otherwise(0) for k, fails in enumerate(failures(body))]
    rows = docs.select(
        docs[f"`{id}`"].alias("id"),
        F.coalesce(docs[f"`{part}`"].cast("string"), F.lit("")).alias("part"),
        F.unhex(F.sha2(body, 256)).alias("digest"),
        sum(bits[1:], bits[0]).alias("mask"),
    )
    rows = rows.groupBy("digest", "id", "part", "mask").agg(F.count("*").alias("n"))
    first = docs.groupBy(F.unhex(F.sha2(body, 256)).alias("_digest")).agg(F.min(docs[f"`{id}`"]).alias("_id"))
    again = F.when(F.col("_id").isNull() & F.col("id").isNotNull(), 1 << 4).otherwise(0)
    # by both columns: the rows of a text with many copies lie apart
    same = (F.col("digest") == F.col("_digest")) & (F.col("id") == F.col("_id"))
    return rows.join(first, same, "left").select("id", "part", (F.col("mask") + again).alias("mask"), "n")


def mask_counts(rows: DataFrame, labels: DataFrame, id: str = "doc_id") -> DataFrame:
    """``part, mask, n, good, toxic``: documents, those of label quality 1, and those of label toxic 1."""
    is_one = lambda c: F.max(F.when(F.col(c) == 1, 1).otherwise(0))
    marks = labels.groupBy(F.col(id).alias("_label")).agg(is_one("quality").alias("good"), is_one("toxic").alias("toxic"))
    marked = rows.join(marks, F.col("id") == F.col("_label"), "left")
    n, good, toxic = F.col("n"), F.coalesce("good", F.lit(0)), F.coalesce("toxic", F.lit(0))
    return marked.groupBy("part", "mask").agg(F.sum(n).alias("n"), F.sum(n * good).alias("good"), F.sum(n * toxic).alias("toxic"))


def coalitions(counts: DataFrame, filters: str = FILTERS) -> DataFrame:
    """Per part ``total`` and arrays over all coalitions, of removed, good and toxic documents; and ``only`` per filter."""
    hits = lambda value, s: F.sum(F.when(F.col("mask").bitwiseAND(F.lit(s)) != 0, F.col(value)).otherwise(0))
    every = range(1 << len(filters))
    return counts.groupBy("part").agg(
        F.sum("n").alias("total"),
        *[F.array(*[hits(value, s) for s in every]).alias(value) for value in ("n", "good", "toxic")],
        F.array(*[F.sum(F.when(F.col("mask") == 1 << k, F.col("n")).otherwise(0)) for k in range(len(filters))]).alias("only"),
    )


def steps(parts: DataFrame, filters: str = FILTERS) -> DataFrame:
    """One row per part, order of the filters and step, from the coalitions of each part."""
    orders = factorial(len(filters))
    matrix = [[orders * x for x in row] for row in shapley_matrix(len(filters))]
    if any(x.denominator != 1 for row in matrix for x in row):
        raise ArithmeticError("Shapley coefficients times the orders are whole numbers")
    shapley = [sum((F.lit(int(x)) * F.col("n")[s] for s, x in enumerate(row) if x), F.lit(0).cast("long")) for row in matrix]
    every = F.array(*[F.lit("".join(p)) for p in permutations(filters)])
    out = parts.withColumn("shapleys", F.array(*shapley)).withColumn("filter_order", F.explode(every))
    out = out.withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(len(filters)))))
    bit = lambda at: F.instr(F.lit(filters), F.substring("filter_order", at, F.lit(1))) - 1
    joined = lambda s, at: s.bitwiseOR(F.call_function("shiftleft", F.lit(1), bit(at)))
    before = F.aggregate(F.slice(F.sequence(F.lit(1), F.lit(len(filters))), 1, F.col("step") - 1), F.lit(0), joined)
    out = out.withColumn("at", bit(F.col("step"))).withColumn("before", before)
    out = out.withColumn("own", F.call_function("shiftleft", F.lit(1), F.col("at")))
    out = out.withColumn("after", F.col("before").bitwiseOR(F.col("own")))
    here = lambda value: F.col(value)[F.col("after")] - F.col(value)[F.col("before")]
    return out.select(
        "part",
        "filter_order",
        "step",
        (F.col("total") - F.col("n")[F.col("after")]).alias("kept"),
        here("n").alias("removed"),
        (F.col("n")[F.col("own")] - here("n")).alias("redundant"),
        F.col("only")[F.col("at")].alias("unique_fails"),
        here("good").alias("good_lost"),
        here("toxic").alias("toxic_lost"),
        F.col("shapleys")[F.col("at")].alias("shapley"),
    )


def audit(docs: DataFrame, labels: DataFrame, text: str = "text", id: str = "doc_id", part: str = "source") -> DataFrame:
    """Per part, order and step: kept, removed, redundant, unique_fails, good_lost, toxic_lost and shapley (times the orders)."""
    return steps(coalitions(mask_counts(masks(docs, text, id, part), labels, id)))


@query(
    r"""
    WITH d AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS body,
                      regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words,
                      min(doc_id) OVER (PARTITION BY coalesce(text, '')) AS first_id FROM documents),
    f AS (SELECT doc_id, part, [len(words) < 50, 100 * len(list_distinct(words)) < 65 * len(words),
                 100 * len(regexp_extract_all(body, '[A-Z]')) > 5 * length(body),
                 regexp_matches(body, '[#$%&*|]'), doc_id > first_id] AS fails FROM d),
    l AS (SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels GROUP BY doc_id),
    m AS (SELECT part, fails, count(*) AS n, coalesce(sum(good), 0) AS good, coalesce(sum(toxic), 0) AS toxic
          FROM f LEFT JOIN l ON f.doc_id = l.doc_id GROUP BY part, fails),
    x AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS letter),
    o AS (SELECT a.letter || b.letter || c.letter || d.letter || e.letter AS filter_order
          FROM x a, x b, x c, x d, x e WHERE len(list_distinct([a.letter, b.letter, c.letter, d.letter, e.letter])) = 5),
    s AS (SELECT filter_order, step, ascii(filter_order[step]) - 64 AS k,
                 [ascii(c) - 64 FOR c IN string_split(filter_order[1:step - 1], '') IF c != ''] AS earlier
          FROM o, (SELECT unnest([1, 2, 3, 4, 5]) AS step)),
    g AS (SELECT part, filter_order, step, k,
                 CAST(sum(CASE WHEN gone OR fails[k] THEN 0 ELSE n END) AS BIGINT) AS kept,
                 CAST(sum(CASE WHEN fails[k] AND NOT gone THEN n ELSE 0 END) AS BIGINT) AS removed,
                 CAST(sum(CASE WHEN fails[k] AND gone THEN n ELSE 0 END) AS BIGINT) AS redundant,
                 CAST(sum(CASE WHEN fails[k] AND len([f FOR f IN fails IF f]) = 1 THEN n ELSE 0 END) AS BIGINT) AS unique_fails,
                 CAST(sum(CASE WHEN fails[k] AND NOT gone THEN good ELSE 0 END) AS BIGINT) AS good_lost,
                 CAST(sum(CASE WHEN fails[k] AND NOT gone THEN toxic ELSE 0 END) AS BIGINT) AS toxic_lost
          FROM (SELECT *, len([e FOR e IN earlier IF fails[e]]) > 0 AS gone FROM m, s) GROUP BY ALL)
    SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
           CAST(sum(removed) OVER (PARTITION BY part, k) AS BIGINT) AS shapley FROM g
    """
)
def op13_filter_audit(spark, sf_dir):
    read = lambda table: spark.read.parquet(f"{sf_dir}/{table}.parquet")
    return audit(read("documents"), read("labels"))
