"""Exact k nearest neighbours within groups, without comparing everything with everything.

Points are assigned to the nearest of a few pivots; a pivot's points, its
cell, are cut into blocks of bounded size. A point's k-th distance inside its
own block bounds how far a neighbour can be, and the triangle inequality then
rules out every cell that lies farther away: by the distance to its pivot, and
by the least and largest distance of its points to some other pivots, the
references, which cut a cell from many sides. Only the remaining
(point, block) pairs are compared, block by block, and each comparison hands
on at most k rows per point.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from holdfast.session import pinned

# ship the helpers below with the tasks: executors need not have this package installed
cloudpickle.register_pickle_by_value(sys.modules[__name__])

BLOCK_ROWS = 1024
MAX_PIVOTS = 1024
REFERENCES = 32
PAIRS_HELD = 1 << 19  # numbers of one array while pairs are compared; about eight such arrays live at once


def _distances(queries: np.ndarray, points: np.ndarray) -> np.ndarray:
    squares = (queries**2).sum(1)[:, None] + (points**2).sum(1)[None, :] - 2 * queries @ points.T
    return np.maximum(squares, 0)


def _away(vectors: np.ndarray, references: np.ndarray) -> np.ndarray:
    """Distance of every vector to every reference, computed directly: no digits cancel."""
    return np.stack([np.sqrt(((vectors - r) ** 2).sum(1)) for r in references], axis=1)


def _nearest(q_ids, queries, p_ids, points, k: int) -> pd.DataFrame:
    """Up to k nearest points per query, itself left out, ties to the smaller id.

    The matrix product, around the block's centre, only picks candidates, by
    each pair's own rounding error; their distances are then computed directly,
    so no digits cancel. Queries are taken in runs of bounded memory.
    """
    centre = np.median(points, axis=0)
    parts, step = [], max(1, PAIRS_HELD // max(1, len(points)))
    p = points - centre
    size = (p**2).sum(1)
    k_th = min(k, len(points)) - 1
    for lo in range(0, len(queries), step):
        ids, q = q_ids[lo : lo + step], queries[lo : lo + step]
        squares = _distances(q - centre, p)
        error = 1e-12 * points.shape[1] * (((q - centre) ** 2).sum(1)[:, None] + size[None, :])
        own = ids[:, None] == p_ids[None, :]
        upper = np.where(own, np.inf, squares + error)
        limit = np.partition(upper, k_th, axis=1)[:, k_th]
        rows, cols = np.nonzero((squares - error <= limit[:, None]) & ~own)
        exact = np.empty(len(rows))
        many = max(1, PAIRS_HELD // points.shape[1])
        for at in range(0, len(rows), many):
            r, c = rows[at : at + many], cols[at : at + many]
            exact[at : at + many] = np.sqrt(((q[r] - points[c]) ** 2).sum(1))
        found = pd.DataFrame({"id": ids[rows], "neighbour_id": p_ids[cols], "distance": exact})
        found = found.sort_values(["id", "distance", "neighbour_id"], kind="stable")
        parts.append(found[found.groupby("id").cumcount() < k])
    if not parts:
        return pd.DataFrame({"id": q_ids[:0], "neighbour_id": p_ids[:0], "distance": np.empty(0)})
    return pd.concat(parts, ignore_index=True)


def _runs(rows: int, width: int) -> Iterator[slice]:
    """Slices of ``rows`` for which an array of ``width`` columns keeps to ``PAIRS_HELD`` numbers."""
    step = max(1, PAIRS_HELD // max(1, width))
    return (slice(lo, lo + step) for lo in range(0, rows, step))


def _stack(vectors: pd.Series) -> np.ndarray:
    return np.stack(vectors.to_numpy()).astype("float64") if len(vectors) else np.empty((0, 1))


def nearest_neighbours(
    points: DataFrame,
    k: int = 5,
    block_rows: int = BLOCK_ROWS,
    max_pivots: int = MAX_PIVOTS,
) -> DataFrame:
    """From (group, id, vector array<double>) to (id, neighbour_id, distance, rank), rank 1..k.

    ``group`` is a small set of classes; neighbours come from the same one.
    Equal vectors are compared once, by their smallest id, so a large set of
    copies costs no comparisons among its members.
    """
    distinct = points.groupBy("group", "vector").agg(F.min("id").alias("id"), F.count("*").alias("copies"))
    distinct = _with_cells(distinct, block_rows, max_pivots)
    near = _between(distinct.cells, distinct, k, block_rows)
    if distinct.most_copies > 1:
        near = _spread_copies(points, distinct.cells, pinned(near, "near"), k)
    ranked = F.row_number().over(W.partitionBy("id").orderBy("distance", "neighbour_id"))
    return near.withColumn("rank", ranked).where(F.col("rank") <= k)


@dataclass
class _Reach:
    """Of a group's cells: number, blocks, largest distance to the own pivot, least and largest ones to the references."""

    cell: np.ndarray
    blocks: np.ndarray
    radius: np.ndarray
    low: np.ndarray
    high: np.ndarray

    def open_to(self, squares: np.ndarray, error: np.ndarray, away: np.ndarray, limits: np.ndarray) -> np.ndarray:
        """Whether a cell may hold a point within a query's limit; a row per query, a column per cell."""
        far = squares[:, self.cell] - error[:, self.cell] > (limits[:, None] + self.radius) ** 2
        for k in range(away.shape[1]):
            at = away[:, k, None]
            slack = limits[:, None] + 1e-9 * at  # the distances carry rounding
            far |= (self.low[:, k] - at > slack) | (at - self.high[:, k] > slack)
        return ~far


@dataclass
class _Cells:
    """Distinct points with their cell and block, and the bounded facts about all cells."""

    cells: DataFrame
    pivots: np.ndarray
    references: np.ndarray
    reach: dict[object, _Reach]
    single_block: bool
    most_copies: int


def _with_cells(points: DataFrame, block_rows: int, max_pivots: int) -> _Cells:
    points = pinned(points.select("group", "id", "vector", "copies"), "vectors")
    size = points.agg(F.count("*").alias("rows"), F.max("copies").alias("most")).first()
    n_pivots = int(min(max_pivots, max(1, size["rows"] // block_rows)))
    # at most max_pivots vectors on the driver; any choice of pivots gives the same neighbours
    chosen = points.orderBy(F.xxhash64("id"), "id").limit(n_pivots).select("vector").collect()
    pivots = np.array([r["vector"] for r in chosen], dtype="float64")

    references = pivots[:REFERENCES]

    def assign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for whole in batches:
            for run in _runs(len(whole), max(pivots.shape)):
                batch = whole.iloc[run]
                cell = _distances(_stack(batch["vector"]), pivots).argmin(1)
                yield batch.assign(cell=cell.astype("int32"))

    def edges(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Per task and (group, cell): rows, largest distance to the pivot, least and largest ones to the references."""
        seen: dict = {}
        for whole in batches:
            for run in _runs(len(whole), max(pivots.shape)):
                batch = whole.iloc[run]
                v, cells = _stack(batch["vector"]), batch["cell"].to_numpy()
                away = np.column_stack([np.sqrt(((v - pivots[cells]) ** 2).sum(1)), _away(v, references)])
                for group, own in batch.groupby("group", sort=False).indices.items():
                    own = own[np.argsort(cells[own], kind="stable")]
                    cell, at, rows = np.unique(cells[own], return_index=True, return_counts=True)
                    found = zip(cell.tolist(), rows.tolist(), np.minimum.reduceat(away[own], at), np.maximum.reduceat(away[own], at))
                    for c, n, low, high in found:
                        old = seen.get((group, c))
                        seen[group, c] = (n, low, high) if old is None else (old[0] + n, np.minimum(old[1], low), np.maximum(old[2], high))
        if seen:
            yield pd.DataFrame(
                [(group, c, n, high[0], low[1:].tolist(), high[1:].tolist()) for (group, c), (n, low, high) in seen.items()],
                columns=["group", "cell", "rows", "radius", "low", "high"],
            )

    kinds = {f.name: f.dataType.simpleString() for f in points.schema}
    base = ", ".join(f"{c} {kinds[c]}" for c in ("group", "id", "vector"))
    assigned = points.select("group", "id", "vector").mapInPandas(assign, f"{base}, cell int")
    if size["rows"] > block_rows:
        assigned = pinned(assigned, "cells")

    # one row per (group, cell): at most groups x max_pivots
    bounds = f"group {kinds['group']}, cell int, rows long, radius double, low array<double>, high array<double>"
    each = lambda f, c: F.array(*[f(F.col(c)[k]) for k in range(len(references))]).alias(c)
    found = assigned.mapInPandas(edges, bounds).groupBy("group", "cell").agg(
        F.max("radius").alias("radius"),
        F.ceil(F.sum("rows") / block_rows).cast("int").alias("blocks"),
        each(F.min, "low"),
        each(F.max, "high"),
    ).collect()
    by_group: dict = {}
    for c in found:
        by_group.setdefault(c["group"], []).append(c)
    reach = {
        group: _Reach(*[np.array([c[name] for c in cells]) for name in ("cell", "blocks", "radius", "low", "high")])
        for group, cells in by_group.items()
    }
    sizes = points.sparkSession.createDataFrame(
        [(c["group"], c["cell"], c["blocks"]) for c in found], f"group {kinds['group']}, cell int, blocks int"
    )
    blocked = assigned.join(F.broadcast(sizes), ["group", "cell"]).select(
        "group", "id", "vector", "cell", F.pmod(F.xxhash64("id"), "blocks").cast("int").alias("block")
    )
    single = all(r.blocks.tolist() == [1] for r in reach.values())
    return _Cells(blocked, pivots, references, reach, single, size["most"] or 0)


def _between(blocked: DataFrame, known: _Cells, k: int, block_rows: int) -> DataFrame:
    """(id, neighbour_id, distance): at least the k nearest of every point, at most k per compared block."""
    kinds = {f.name: f.dataType.simpleString() for f in blocked.schema}
    base = ", ".join(f"{c} {kinds[c]}" for c in ("group", "id", "vector"))
    pairs = f"id {kinds['id']}, neighbour_id {kinds['id']}, distance double"
    place = ["group", "cell", "block"]
    pivots, references, reach = known.pivots, known.references, known.reach

    if known.single_block:

        def within(block: pd.DataFrame) -> pd.DataFrame:
            v, ids = _stack(block["vector"]), block["id"].to_numpy()
            return _nearest(ids, v, ids, v, k)

        return blocked.groupBy(*place).applyInPandas(within, pairs)

    def bound(block: pd.DataFrame) -> pd.DataFrame:
        v, ids = _stack(block["vector"]), block["id"].to_numpy()
        near = _nearest(ids, v, ids, v, k)
        full = near.groupby("id")["distance"].agg(["size", "max"])
        limit = full["max"].where(full["size"] == k, np.inf).reindex(ids).fillna(np.inf)
        return block.assign(bound=limit.to_numpy())[["group", "id", "vector", "bound"]]

    def targets(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in (whole.iloc[run] for whole in batches for run in _runs(len(whole), max(pivots.shape))):
            v, ids = _stack(batch["vector"]), batch["id"].to_numpy()
            squares, away = _distances(v, pivots), _away(v, references)
            error = 1e-12 * v.shape[1] * ((v**2).sum(1)[:, None] + (pivots**2).sum(1)[None, :])
            limits = batch["bound"].to_numpy() * (1 + 1e-6) + 1e-6
            for group, rows in batch.groupby("group", sort=False).indices.items():
                cells = reach[group]
                query, at = np.nonzero(cells.open_to(squares[rows], error[rows], away[rows], limits[rows]))
                times = cells.blocks[at]
                block = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
                asked = rows[np.repeat(query, times)]
                yield pd.DataFrame({"group": batch["group"].to_numpy()[asked], "id": ids[asked], "cell": np.repeat(cells.cell[at], times), "block": block})

    wanted = (
        blocked.groupBy(*place)
        .applyInPandas(bound, f"{base}, bound double")
        .mapInPandas(targets, f"group {kinds['group']}, id {kinds['id']}, cell int, block int")
    )
    # ids only are written; vectors are joined where they are compared.
    # a block asked for by very many points is copied, each copy serving some of them
    wanted = pinned(wanted, "targets")
    parts = wanted.groupBy(*place).agg(F.ceil(F.count("*") / block_rows).cast("int").alias("parts"))
    queries = wanted.join(parts, place).withColumn("part", F.pmod(F.xxhash64("id"), "parts").cast("int"))
    vectors = blocked.select(*[F.col(c).alias(f"_{c}") for c in ("group", "id", "vector")])
    same = (F.col("group") == F.col("_group")) & (F.col("id") == F.col("_id"))
    queries = queries.join(vectors, same).withColumn("vector", F.col("_vector"))
    stored = blocked.join(parts, place).withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))

    def compare(asked: pd.DataFrame, block: pd.DataFrame) -> pd.DataFrame:
        if not len(asked) or not len(block):
            return pd.DataFrame({"id": asked["id"][:0], "neighbour_id": block["id"][:0], "distance": []})
        return _nearest(
            asked["id"].to_numpy(), _stack(asked["vector"]), block["id"].to_numpy(), _stack(block["vector"]), k
        )

    return (
        queries.select(*place, "part", "id", "vector")
        .groupBy(*place, "part")
        .cogroup(stored.select(*place, "part", "id", "vector").groupBy(*place, "part"))
        .applyInPandas(compare, pairs)
    )


def _spread_copies(points: DataFrame, distinct: DataFrame, near: DataFrame, k: int) -> DataFrame:
    """From neighbours of distinct vectors to neighbours of all points.

    A point needs at most k + 1 candidates: the smallest ids of its own copies
    at distance 0 and of its neighbours' copies. The member table may be
    skewed towards one vector; its joins can be split by the adaptive planner
    and its ranking keeps at most k + 1 rows per map task.
    """
    members = pinned(
        points.select("group", "vector", "id")
        .join(distinct.select("group", "vector", F.col("id").alias("rep")), ["group", "vector"])
        .select("id", "rep"),
        "members",
    )
    place = F.row_number().over(W.partitionBy("rep").orderBy("id"))
    first = members.withColumn("place", place).where(F.col("place") <= k + 1)
    own = first.select("rep", F.lit(0.0).alias("distance"), F.col("id").alias("candidate"))
    others = near.join(
        first.select(F.col("rep").alias("neighbour_id"), F.col("id").alias("candidate")), "neighbour_id"
    ).select(F.col("id").alias("rep"), "distance", "candidate")
    best = F.row_number().over(W.partitionBy("rep").orderBy("distance", "candidate"))
    lists = (
        own.unionByName(others)
        .withColumn("place", best)
        .where(F.col("place") <= k + 1)
        .groupBy("rep")
        .agg(F.array_sort(F.collect_list(F.struct("distance", "candidate"))).alias("best"))
    )
    return (
        members.join(lists, "rep")
        .select("id", F.explode(F.slice(F.filter("best", lambda e: e["candidate"] != F.col("id")), 1, k)).alias("e"))
        .select("id", F.col("e.candidate").alias("neighbour_id"), F.col("e.distance").alias("distance"))
    )
