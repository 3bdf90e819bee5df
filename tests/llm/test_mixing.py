import math

from pyspark.sql import functions as F

from holdfast.llm import mixing as M

from .conftest import SCHEMA, rows_of


def targets(sizes, weights=(5, 2, 1), share=1.5):
    """Budget shared by weight; what exceeds a cap is shared again until nothing does."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    left, out, open_ = share * sum(sizes.values()), {}, set(names)
    while open_:
        level = left / sum(weight[s] for s in open_)
        full = {s for s in open_ if level * weight[s] >= 2 * sizes[s]}
        if not full:
            return out | {s: level * weight[s] for s in open_}
        for s in full:
            out[s] = 2.0 * sizes[s]
            left -= out[s]
        open_ -= full
    return out


def test_targets_and_mix(spark, documents):
    found = M.plan(documents).collect()
    docs = {r.doc_id: r for r in documents.collect()}
    sizes = {}
    for r in found:
        source = docs[r.doc_id].source
        sizes[source] = sizes.get(source, 0) + r.size
    want, taken = targets(sizes), {}
    for r in found:
        source = docs[r.doc_id].source
        assert r.source_size == sizes[source] and math.isclose(r.target, want[source], rel_tol=1e-12)
        assert r.taken in (0, r.size, 2 * r.size)
        taken[source] = taken.get(source, 0) + r.taken
    assert sum(taken.values()) <= 1.5 * sum(sizes.values())
    largest = max(r.size for r in found)
    assert all(abs(taken[s] - want[s]) <= 2 * largest for s in sizes)
    assert sorted(found) == sorted(M.plan(documents.repartition(7)).collect())  # reruns and other orders agree


def test_edges(edges, empty):
    found = M.plan(edges).collect()
    assert len(found) == edges.count()
    assert all(r.taken == 0 and r.size == 0 for r in found if r.doc_id in (0, 1, 2))
    mixed = M.mixed(edges)
    assert mixed.columns == edges.columns
    assert mixed.count() == sum(r.taken // r.size for r in found if r.size)
    assert M.plan(empty).count() == 0 and M.mixed(empty).count() == 0


def test_rows_without_id_are_linear(spark):
    """Equal rows, rows of one id, and different texts without an id."""
    n = 100_000
    text = F.when(F.col("id") % 2 == 0, "the same three").otherwise(F.concat(F.lit("row "), "id"))
    rows = spark.range(n).select(F.when(F.col("id") % 4 < 2, 5).cast("long").alias("doc_id"), text.alias("text"), F.lit("s").alias("source"))
    plan = M.plan(rows)
    taken = plan.groupBy("doc_id").agg(F.sum("taken").alias("taken"), F.count("*").alias("n")).collect()
    total = 3 * (n // 2) + 2 * (n // 2)
    assert sum(r.n for r in taken) == n and 1.5 * total - 6 <= sum(r.taken for r in taken) <= 1.5 * total
    mixed = M.mixed(rows)
    assert mixed.columns == rows.columns
    words = mixed.agg(F.sum(M.words_in(F.col("text")))).first()[0]
    assert words == sum(r.taken for r in taken)
    most = mixed.groupBy("doc_id", "text").count().where("text LIKE 'row %'").agg(F.max("count")).first()[0]
    assert most <= 2


def test_sources_by_code_point_with_null_last(spark):
    rows = rows_of([(" ".join("w" * 8), "en", s) for s in ("b", "a", None, "Z", "é")] * 4)
    found = M.plan(spark.createDataFrame(rows, SCHEMA)).join(spark.createDataFrame(rows, SCHEMA).select("doc_id", "source"), "doc_id")
    got = {r.source: r.target for r in found.groupBy("source").agg(F.first("target").alias("target")).collect()}
    want = targets({s: 32 for s in ("b", "a", None, "Z", "é")})
    assert got.keys() == want.keys() and all(math.isclose(got[s], want[s]) for s in want)
    assert got["Z"] == got["é"] == 64.0  # weight 5, both capped
