import numpy as np
import pytest
from pyspark.sql import functions as F

from holdfast.functions.neighbours import nearest_neighbours


def brute(ids, groups, vectors, k):
    out = set()
    for i, v in enumerate(vectors):
        d = np.sqrt(((vectors - v) ** 2).sum(1))
        order = sorted((d[j], ids[j]) for j in range(len(ids)) if j != i and groups[j] == groups[i])
        out |= {(ids[i], n, r + 1) for r, (_, n) in enumerate(order[:k])}
    return out


def run(spark, groups, vectors, k, **kw):
    rows = [(int(g), i, [float(x) for x in v]) for i, (g, v) in enumerate(zip(groups, vectors))]
    df = spark.createDataFrame(rows, "group int, id long, vector array<double>")
    return {(r["id"], r["neighbour_id"], r["rank"]) for r in nearest_neighbours(df, k, **kw).collect()}


@pytest.mark.parametrize("blocks", [{}, {"block_rows": 25}, {"block_rows": 10, "max_pivots": 3}])
def test_equal_to_brute_force(spark, blocks):
    rng = np.random.default_rng(0)
    vectors = rng.normal(size=(200, 4)) + rng.integers(0, 4, size=(200, 1)) * 6
    groups = rng.integers(0, 2, size=200)
    assert run(spark, groups, vectors, 5, **blocks) == brute(list(range(200)), groups, vectors, 5)


@pytest.mark.parametrize("blocks", [{}, {"block_rows": 15}])
def test_a_third_are_copies(spark, blocks):
    rng = np.random.default_rng(1)
    vectors = rng.normal(size=(150, 3))
    vectors[::3] = vectors[0]
    vectors[1::30] = vectors[1]
    groups = np.zeros(150, dtype=int)
    assert run(spark, groups, vectors, 4, **blocks) == brute(list(range(150)), groups, vectors, 4)


def test_fewer_points_than_neighbours(spark):
    vectors = np.array([[0.0], [1.0], [3.0]])
    assert run(spark, [0, 0, 0], vectors, 5) == brute([0, 1, 2], [0, 0, 0], vectors, 5)


def test_one_outlier_does_not_make_all_pairs_candidates():
    from holdfast.functions import neighbours

    rng = np.random.default_rng(5)
    v = rng.normal(size=(1000, 8)) + 100
    v[17] = 1e9
    ids = np.arange(1000)
    found = neighbours._nearest(ids, v, ids, v, 5)
    assert len(found) == 5000
    for i in (0, 500, 999):
        d = np.sqrt(((v - v[i]) ** 2).sum(1))
        d[i] = np.inf
        assert sorted(found[found["id"] == i]["neighbour_id"]) == sorted(np.argsort(d)[:5])


def test_comparing_a_block_takes_bounded_memory():
    import tracemalloc

    from holdfast.functions import neighbours

    v = np.random.default_rng(7).normal(size=(4096, 16))
    ids = np.arange(4096)
    tracemalloc.start()
    neighbours._nearest(ids, v, ids, v, 5)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 64 << 20
    runs = list(neighbours._runs(10_000, 1024))
    assert max(r.stop - r.start for r in runs) * 1024 <= neighbours.PAIRS_HELD
    assert [i for r in runs for i in range(10_000)[r]] == list(range(10_000))


def test_batches_cut_into_runs_give_equal_neighbours(spark, monkeypatch):
    from holdfast.functions import neighbours

    monkeypatch.setattr(neighbours, "PAIRS_HELD", 50)  # seven rows or fewer in a run
    rng = np.random.default_rng(8)
    vectors, groups = rng.normal(size=(120, 3)), rng.integers(0, 2, size=120)
    assert run(spark, groups, vectors, 4, block_rows=15) == brute(list(range(120)), groups, vectors, 4)


def test_far_cells_are_not_compared(spark, monkeypatch):
    """Points on a line far from the origin of the pivots' distances: a query meets few blocks, not nearly all."""
    from holdfast.functions import neighbours as N

    rng = np.random.default_rng(5)
    vectors = np.c_[rng.uniform(0, 1e6, 4000), rng.normal(size=(4000, 3))]
    squares = lambda x, p: ((x[:, None] - p[None]) ** 2).sum(2)
    pivots = vectors[:16]
    cell = squares(vectors, pivots).argmin(1)
    own = [vectors[cell == c] for c in range(16)]
    reach = N._Reach(
        np.arange(16), np.ones(16, int), np.array([N._away(x, pivots[[c]]).max() for c, x in enumerate(own)]),
        np.array([N._away(x, pivots).min(0) for x in own]), np.array([N._away(x, pivots).max(0) for x in own]),
    )
    limits = np.full(4000, 1e4)
    open_to = reach.open_to(squares(vectors, pivots), np.zeros((4000, 16)), N._away(vectors, pivots), limits)
    near = np.zeros((4000, 16), bool)
    for c, x in enumerate(own):
        near[:, c] = (np.abs(vectors[:, None, 0] - x[None, :, 0]) <= 9_999).any(1)
    assert (open_to >= near).all() and open_to.mean() < 1.3 * near.mean()
