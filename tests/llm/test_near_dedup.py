import random
from itertools import combinations

import numpy as np
import pytest

from holdfast.llm import near_dedup as N

from .conftest import SCHEMA, rows_of, words


def expected(rows, n):
    """Least reachable id of every row with an id, by comparing all pairs."""
    sets = {}
    for r in rows:
        w = words(r.text)
        sets[r.doc_id] = {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} if w else set()
    least = {k: k for k in sets}

    def find(k):
        while least[k] != k:
            k = least[k]
        return k

    for a, b in combinations(sets, 2):
        common = len(sets[a] & sets[b])
        if sets[a] and sets[b] and 100 * common >= 80 * (len(sets[a]) + len(sets[b]) - common):
            a, b = sorted((find(a), find(b)))
            least[b] = a
    return {k: (len(s), find(k)) for k, s in sets.items()}


def family(rng, size, n_words, changes):
    base = [f"t{rng.randrange(10**6)}" for _ in range(n_words)]
    out = []
    for _ in range(size):
        w = list(base)
        for _ in range(rng.randrange(changes + 1)):
            w[rng.randrange(n_words)] = f"c{rng.randrange(10**6)}"
        out.append(" ".join(w))
    return out


@pytest.mark.parametrize("shingle, block", [(2, 256), (5, 4)])  # small blocks deal out every list
def test_against_all_pairs(spark, monkeypatch, shingle, block):
    monkeypatch.setattr(N, "FEW_HEADS", block // 8)  # texts by a join of both sides as well
    monkeypatch.setattr(N, "BLOCK", block)
    monkeypatch.setattr(N.components, "__defaults__", (block,))
    rng = random.Random(shingle)
    texts = [None, "", "one", "one", "two words", "Two  WORDS", "two words more"]
    for size, n, changes in ((40, 120, 6), (6, 30, 2), (5, 400, 30), (8, 12, 1)):
        texts += family(rng, size, n, changes)
    rng.shuffle(texts)
    docs = spark.createDataFrame(rows_of(texts), SCHEMA)
    want = expected(docs.collect(), shingle)
    found = N.near_duplicates(docs, shingle=shingle).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in found) and len(found) == len(texts)


def test_edges(edges, empty):
    found = N.near_duplicates(edges, shingle=2).collect()
    assert len(found) == edges.count()
    by_id = {r.doc_id: r for r in found if r.doc_id is not None}
    assert [by_id[k].n_shingles for k in (0, 1, 2, 3, 5)] == [0, 0, 0, 1, 1]
    assert by_id[4].component_id == 3 and by_id[6].component_id == 5 and by_id[13].component_id == 12
    assert all(by_id[k].component_id == k and by_id[k].kept for k in (0, 1, 2))
    no_id = {r.n_shingles: r for r in found if r.doc_id is None}
    assert no_id[1].component_id == 5 and not no_id[1].kept and no_id[0].kept
    stay = N.drop_near_duplicates(edges)
    assert stay.columns == edges.columns
    # three texts without words and the row without both; of the repeated rows one
    assert sorted(r.doc_id for r in stay.collect() if r.doc_id is not None) == [0, 1, 2, 3, 5, 7, 8, 9, 10, 12, 14, 15]
    assert N.near_duplicates(empty).count() == 0 and N.drop_near_duplicates(empty).count() == 0


def test_many_rows_without_id_or_with_one(spark):
    """Sets are read once a class, whatever number of rows share a head's id; time grows with the rows."""
    from pyspark.sql import functions as F

    n = 100_000
    text = F.when(F.col("id") % 3 == 0, "a b c d e f g h i j").when(F.col("id") % 3 == 1, "a b c d e f g h i k").otherwise(F.concat_ws(" ", *[F.concat(F.lit(w), "id") for w in "xyz"]))
    docs = spark.range(n).select(F.when(F.col("id") % 2 == 0, 7).cast("long").alias("doc_id"), text.alias("text"))
    found = N.near_duplicates(docs, shingle=2)
    counts = {(r.n_shingles, r.component_id): r["count"] for r in found.groupBy("n_shingles", "component_id").count().collect()}
    assert counts[9, 7] == sum(k % 3 < 2 for k in range(n)) and sum(counts.values()) == n
    stay = N.drop_near_duplicates(docs, shingle=2)
    lasting = {"a b c d e f g h i j", "a b c d e f g h i k"}
    assert stay.where(F.col("text").isin(list(lasting))).count() == 1


def test_sets_are_distinct(spark, monkeypatch):
    """Two classes whose heads have no id, among many rows without id."""
    made = []
    keep = N.written

    def spy(df, label, *size):
        out = keep(df, label, *size)
        if label == "sets":
            made.append(out.count())
        return out

    monkeypatch.setattr(N, "written", spy)
    texts = ["p q r s t u v w x y z", "p q r s t u v w x y a"] * 50 + [f"x{k} y{k} z{k} u{k}" for k in range(50)]
    docs = spark.createDataFrame([(None, *r[1:]) for r in rows_of(texts)], SCHEMA)
    N.near_duplicates(docs, shingle=2, percent=50).collect()
    assert made[-1] == 2


@pytest.mark.parametrize("few", [0, 10**6])
def test_contracted(spark, monkeypatch, few):
    monkeypatch.setattr(N, "FEW_EDGES", few)
    rng = np.random.default_rng(3)
    n = 200 if few else 60  # every round of the loop is some jobs
    path = [(k, k + 1) for k in range(n)]
    star = [(1000, 1001 + k) for k in range(100)]
    rng.shuffle(path)
    found = N.contracted(spark.createDataFrame([*map(tuple, path), *star, (5000, 5000), (7, 1)], "u long, v long"))
    assert {(r.node, r.label) for r in found.collect()} >= {(n, 0), (0, 0), (57, 0), (1100, 1000)}


def test_five_bytes_a_member():
    values = np.sort(np.random.default_rng(1).integers(0, 2**63, 100, dtype=np.uint64))
    short = np.ascontiguousarray((values >> np.uint64(24)).view(np.uint8).reshape(-1, 8)[:, :5])
    assert (N.unpacked(short.tobytes()) == values >> np.uint64(24)).all()


def test_binomial_tail():
    from math import comb

    missed = sum(comb(N.COORDINATES, k) * 0.8**k * 0.2 ** (N.COORDINATES - k) for k in range(N.NEED))
    assert missed < 4e-7
