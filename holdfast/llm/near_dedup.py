"""Near duplicates by an inverted join over MinHash signature coordinates.

Every distinct shingle set (a class; its copies follow it) has a signature of 64
coordinates. A class is posted under its coordinate-value pairs. Classes that
agree on at least ``need`` coordinates must meet in one of the first
``64 - need + 1`` of each other's pairs in any common order, so only that prefix
is posted, rarest pairs first (prefix merging); a pair of classes that meets in
several lists is counted in the first of them only (skip merging), over whole
signatures. At similarity 0.8 a link is missed with a chance of 3e-7 (binomial tail of 64 coordinates).

Pairs above the match threshold are not emitted: where a list is read, they are
confirmed on full sets, best first, unless links found before connect them
already, so a list gives fewer links than it has members. A list of up to
``BLOCK`` postings is settled so in one step. A longer one is first dealt over
blocks by a hash; links are contracted to components, and in the last step the
blocks of its largest component meet those of the others only. Nothing is left
out: each pair of a list is counted unless its ends are known to be connected.

Members of full sets are kept as 40 bits of their hashes; two sets of 1,000 share
a member by accident with a chance of 1e-6, which matters only at the threshold.

Cases: null or empty text has an empty set, is linked with nothing and stays; a
text with fewer words than a shingle is one shingle; repeated rows of one id and
text share their component and one of them stays; rows without id take part, and
a component of such rows alone has no id; an empty table gives no rows; other
columns pass through :func:`drop_near_duplicates`.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from holdfast.llm.store import FILE_BYTES, registry, text_bytes, text_of, whole_row, written
from holdfast.llm.text import Words, forget, mix, release, slices, windows

COORDINATES = 64
NEED = 34
SHINGLE = 5
PERCENT = 80
BLOCK = 512
MAX_ROUNDS = 6
FEW_EDGES = 200_000  # that one task unites
FEW_HEADS = 200_000  # classes whose ids go to all tasks that read texts

QUERIES, ORACLE, query = registry()

_U = np.uint64
_SEEDS = mix(np.arange(1, COORDINATES + 1, dtype=_U) * _U(0x9E3779B97F4A7C15))
_FACTORS = mix(_SEEDS) | _U(1)


def shingle_sets(words: Words, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingles of all rows, one row after the other, and the offsets of the rows."""
    values, at = windows(words, n)
    row = np.searchsorted(words.first, at, side="right") - 1
    counts = np.bincount(row, minlength=len(words.counts)) if len(at) else np.zeros(len(words.counts), np.int64)
    short = np.flatnonzero((words.counts > 0) & (words.counts < n))
    parts, last = [], 0
    bounds = np.concatenate([[0], np.cumsum(counts)])
    for r in short:  # the whole sequence is the only shingle
        value = words.hash[words.first[r] : words.first[r] + 1]
        for k in range(words.first[r] + 1, words.first[r + 1]):
            value = mix(value) * _U(0xD6E8FEB86659FD93) + words.hash[k : k + 1]
        parts += [values[last : bounds[r]], mix(value)]
        last = bounds[r]
        counts[r] = 1
    values = np.concatenate([*parts, values[last:]])
    bounds = np.concatenate([[0], np.cumsum(counts)])
    for lo, hi in zip(bounds[:-1], bounds[1:]):
        values[lo:hi].sort()
    fresh = np.ones(len(values), bool)
    fresh[1:] = values[1:] != values[:-1]
    fresh[bounds[:-1][counts > 0]] = True
    kept = np.concatenate([[0], np.cumsum(fresh)])
    return values[fresh], kept[bounds]


def _sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.concatenate([np.zeros(1, _U), np.cumsum(values, dtype=_U)])
    return total[offsets[1:]] - total[offsets[:-1]]


def class_ids(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """A 64-bit id of each set, from its size and two sums over its members."""
    n = np.diff(offsets).astype(_U)
    return mix(_sums(values, offsets) ^ mix(_sums(mix(values), offsets) + n)).view(np.int64)


def signatures(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Rows x coordinates: the least of each coordinate's hashes over the set (sets must not be empty)."""
    out = np.empty((len(offsets) - 1, COORDINATES), np.int32)
    for j in range(COORDINATES):
        least = np.minimum.reduceat((values ^ _SEEDS[j]) * _FACTORS[j], offsets[:-1])
        out[:, j] = (least >> _U(32)).astype(np.uint32).view(np.int32)
    return out


def _sketcher(n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        for batch in slices(batches):
            values, offsets = shingle_sets(Words(batch.column("text"), lower=True), n)
            sizes = np.diff(offsets)
            full = sizes > 0
            ids = class_ids(values, offsets)
            sigs = signatures(values, np.concatenate([offsets[:-1][full], offsets[-1:]])) if full.any() else np.zeros((0, COORDINATES), np.int32)
            lists = np.concatenate([[0], np.cumsum(full * COORDINATES)]).astype(np.int32)
            yield pa.record_batch(
                {
                    "doc_id": batch.column("doc_id"),
                    "hash": batch.column("hash"),
                    "n_shingles": pa.array(sizes, pa.int64()),
                    "cls": pa.array(ids, pa.int64(), mask=~full),
                    "signature": pa.ListArray.from_arrays(lists, pa.array(sigs.ravel()), mask=pa.array(~full)),
                }
            )

    return run


def unpacked(data) -> np.ndarray:
    """The members of a set stored as five bytes each."""
    wide = np.zeros((len(data) // 5, 8), np.uint8)
    wide[:, :5] = np.frombuffer(data, np.uint8).reshape(-1, 5)
    return wide.view(_U).ravel()


def _set_builder(n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            values, offsets = shingle_sets(Words(batch.column("text"), lower=True), n)
            short = np.ascontiguousarray((values >> _U(24)).view(np.uint8).reshape(-1, 8)[:, :5])
            sets = pa.LargeBinaryArray.from_buffers(
                pa.large_binary(), len(offsets) - 1, [None, pa.py_buffer((offsets * 5).tobytes()), pa.py_buffer(short.tobytes())]
            )
            yield pa.record_batch({"cls": pa.array(class_ids(values, offsets)), "members": sets.cast(pa.binary())})

    return run


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches whose lists are whole: the last list of a batch is carried to the next."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        token, part = (batch.column(c).to_numpy() for c in ("token", "part"))
        first = held[-1] if held else None
        same = first is not None and first.column("token")[-1].as_py() == token[0] and first.column("part")[-1].as_py() == part[0]
        change = np.flatnonzero((token[1:] != token[:-1]) | (part[1:] != part[:-1]))
        if held and not same:
            yield _glue(held)
            held = []
        if not len(change):
            held.append(batch)
            continue
        cut = int(change[-1]) + 1
        yield _glue([*held, batch.slice(0, cut)])
        held = [batch.slice(cut)]
    if held:
        yield _glue(held)
    release()


def _glue(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
    return parts[0] if len(parts) == 1 else pa.Table.from_batches(parts).combine_chunks().to_batches()[0]


def _pairs(batch: pa.RecordBatch, need: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(first, second, matches) for each list of the batch: pairs of rows of different components that
    agree on ``need`` coordinates and were not counted in an earlier list."""
    token, part, comp, side = (batch.column(c).to_numpy() for c in ("token", "part", "comp", "side"))
    mask = batch.column("mask").to_numpy().view(_U)
    sigs = batch.column("signature").flatten().to_numpy().reshape(-1, COORDINATES)
    edges = np.flatnonzero((token[1:] != token[:-1]) | (part[1:] != part[:-1])) + 1
    for lo, hi in zip([0, *edges], [*edges, len(token)]):
        bit = _U(1) << _U(int(token[lo]) >> 32)
        found = []
        for i in range(lo, hi - 1):
            rest = slice(i + 1, hi)
            other = np.flatnonzero((comp[rest] != comp[i]) & ((side[rest] != side[i]) | (side[i] == 0))) + i + 1
            if not len(other):
                continue
            equal = sigs[other] == sigs[i]
            count = equal.sum(1)
            good = np.flatnonzero(count >= need)
            if not len(good):
                continue
            agree = np.packbits(equal[good], axis=1, bitorder="little").view(_U).ravel() & mask[i] & mask[other[good]]
            good = good[(agree & (~agree + _U(1))) == bit]
            found.append((np.full(len(good), i), other[good], count[good]))
        if found:
            yield tuple(np.concatenate(x) for x in zip(*found))


def _suspects(need: int):
    """The postings that are in some pair."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _runs(batches):
            found = [np.concatenate([a, b]) for a, b, _ in _pairs(batch, need)]
            if found:
                yield batch.select(["token", "part", "cls", "comp", "side", "mask"]).take(pa.array(np.unique(np.concatenate(found))))

    return run


def _linker(need: int, percent: int):
    """Links between components that connect what the pairs of a list connect, confirmed on full sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _runs(batches):
            comp, members = batch.column("comp").to_pylist(), batch.column("members")
            links = []
            for a, b, count in _pairs(batch, need):
                order = np.argsort(-count, kind="stable")
                sets: dict[int, np.ndarray] = {}
                leader: dict[int, int] = {}

                def find(x: int) -> int:
                    while (up := leader.get(x, x)) != x:
                        leader[x] = x = leader.get(up, up)
                    return x

                for i, j in zip(a[order].tolist(), b[order].tolist()):
                    u, v = find(comp[i]), find(comp[j])
                    if u == v:
                        continue
                    for k in (i, j):
                        if k not in sets:
                            sets[k] = unpacked(members[k].as_buffer())
                    if _similar(sets[i], sets[j], percent):
                        leader[max(u, v)] = min(u, v)
                        links.append((comp[i], comp[j]))
            if links:
                u, v = zip(*links)
                yield pa.record_batch({"u": pa.array(u, pa.int64()), "v": pa.array(v, pa.int64())})

    return run


def _similar(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    """Whether two sorted sets meet the similarity; sizes that cannot are not compared."""
    small, large = sorted((len(x), len(y)))
    if 100 * small < percent * large:
        return False
    both = np.concatenate([x, y])
    both.sort(kind="stable")
    common = int((both[1:] == both[:-1]).sum())
    return 100 * common >= percent * (len(both) - common)


def _united(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Union-find over edges; the least node leads."""
    leader: dict[int, int] = {}

    def find(x: int) -> int:
        while (up := leader.setdefault(x, x)) != x:
            leader[x] = x = leader[up]
        return x

    for batch in batches:
        for u, v in zip(batch.column("u").to_pylist(), batch.column("v").to_pylist()):
            u, v = find(u), find(v)
            leader[max(u, v)] = min(u, v)
    nodes = list(leader)
    yield pa.record_batch({"node": pa.array(nodes, pa.int64()), "label": pa.array([find(x) for x in nodes], pa.int64())})


def contracted(edges: DataFrame) -> DataFrame:
    """(node, label): the least node of each component, for the nodes that have edges ``(u, v)``.

    Few edges are united in one task. Of more, every round hooks each label to its least
    neighbour, follows the hook of that one too, and carries on with the edges between
    different labels.
    """
    both = edges.select("u", "v").union(edges.select("v", "u")).where("u != v").distinct()
    n = edges.count()
    if n <= FEW_EDGES:
        return written(both.where("u < v").coalesce(1).mapInArrow(_united, "node long, label long"), "labels")
    nodes = 2 * n
    edges = written(both, "edges", nodes)
    labels = edges.select(F.col("u").alias("node"), F.col("u").alias("label")).distinct()
    while n := edges.count():
        hook = edges.groupBy("u").agg(F.least("u", F.min("v")).alias("to"))
        next_hook = hook.select(F.col("u").alias("to"), F.col("to").alias("then"))
        hook = written(hook.join(next_hook, "to").select("u", F.col("then").alias("to")), "hooks", n)
        old = hook.select(F.col("u").alias("label"), "to")
        labels = written(labels.join(old, "label", "left").select("node", F.coalesce("to", "label").alias("label")), "labels", nodes)
        far = hook.select(F.col("u").alias("v"), F.col("to").alias("to_v"))
        moved = edges.join(hook, "u").join(far, "v").select(F.col("to").alias("u"), F.col("to_v").alias("v"))
        edges = written(moved.where("u != v").distinct(), "edges", n)
    return labels


def _lists(classes: DataFrame, need: int, n: int) -> DataFrame:
    """(token, cls, mask): prefix postings under pairs that more than one class has; ``mask``: the class's listed coordinates."""
    token = F.shiftleft(F.col("at").cast("long"), 32).bitwiseOR(F.col("value").cast("long").bitwiseAND(0xFFFFFFFF))
    posts = classes.select("cls", F.posexplode("signature").alias("at", "value")).select("cls", token.alias("token"))
    often = written(posts.groupBy("token").agg(F.count("*").alias("n")).where("n > 1"), "frequency", n * COORDINATES // 2)
    prefix = COORDINATES - need + 1
    shared = posts.join(often, "token").groupBy("cls").agg(F.sort_array(F.collect_list(F.struct("n", "token"))).alias("tokens"))
    # pairs of this class alone come first in the order and meet nobody
    length = F.greatest(F.lit(0), F.lit(prefix - COORDINATES) + F.size("tokens"))
    listed = shared.select("cls", F.slice(F.col("tokens.token"), F.lit(1), length).alias("tokens")).where(F.size("tokens") > 0)
    mask = F.expr("aggregate(tokens, 0L, (m, t) -> m | shiftleft(1L, cast(shiftright(t, 32) as int)))")
    return listed.withColumn("mask", mask).select("cls", "mask", F.explode("tokens").alias("token"))


def _sizes(lists: DataFrame, comps: DataFrame | None) -> DataFrame:
    """Per list of several components: ``n`` members, the largest component ``main`` and its ``n_main`` members.

    Without components every member is one.
    """
    if comps is None:
        counts = lists.groupBy("token").agg(F.count("*").alias("n"), F.min("cls").alias("main"))
        return counts.where("n > 1").select("token", "main", F.lit(1).cast("long").alias("n_main"), "n")
    counts = lists.join(comps, "cls").groupBy("token", "comp").agg(F.count("*").alias("n"))
    counts = counts.groupBy("token").agg(F.max(F.struct("n", "comp")).alias("main"), F.sum("n").alias("n"), F.count("*").alias("comps"))
    return counts.where("comps > 1").select("token", F.col("main.comp").alias("main"), F.col("main.n").alias("n_main"), "n")


def _dealt(posts: DataFrame, block: int, turn: int, everything: bool) -> DataFrame:
    """Postings with the sizes of their lists, dealt over parts that are compared within themselves."""
    spread = F.xxhash64("cls", "token", F.lit(turn))
    blocks = lambda n: F.ceil(n / F.lit(block)).cast("long")
    if not everything:
        return posts.withColumn("part", F.pmod(spread, blocks(F.col("n")))).withColumn("side", F.lit(0)).select(*_POSTING)
    # the largest component's blocks meet the others' blocks, the others' blocks meet one another
    posts = posts.withColumn("inner", F.col("comp") == F.col("main"))
    n_in, n_out = blocks(F.col("n_main")), F.greatest(F.lit(1), blocks(F.col("n") - F.col("n_main")))
    mine = F.pmod(spread, F.when(F.col("inner"), n_in).otherwise(n_out))
    each = lambda n: F.sequence(F.lit(0).cast("long"), n - 1)
    part = lambda kind, i, j, side: F.struct(
        (F.lit(kind).cast("long") + 2 * (i * F.lit(1 << 30) + j)).alias("part"), F.lit(side).cast("int").alias("side")
    )
    with_others = F.transform(each(n_out), lambda j: part(0, F.col("mine"), j, 1))
    with_main = F.transform(each(n_in), lambda i: part(0, i, F.col("mine"), 2))
    among = F.transform(
        each(n_out),
        lambda j: F.struct(
            (F.lit(1).cast("long") + 2 * (F.least(j, F.col("mine")) * F.lit(1 << 30) + F.greatest(j, F.col("mine")))).alias("part"),
            F.when(j == F.col("mine"), 0).when(F.col("mine") < j, 1).otherwise(2).alias("side"),
        ),
    )
    whole = F.array(part(0, F.lit(0).cast("long"), F.lit(0).cast("long"), 0))
    parts = F.when(F.col("n") <= block, whole).when(F.col("inner"), with_others).otherwise(F.concat(with_main, among))
    posts = posts.withColumn("mine", mine).select("token", "cls", "mask", "comp", F.explode(parts).alias("to"))
    return posts.select("token", "cls", "mask", "comp", "to.part", "to.side").select(*_POSTING)


_POSTING = ("token", "part", "cls", "comp", "side", "mask")


def _by_list(posts: DataFrame, classes: DataFrame, *more: DataFrame) -> DataFrame:
    """Postings with their signatures (and sets), list by list."""
    for columns in (classes.select("cls", "signature"), *more):
        posts = posts.join(columns, "cls")
    return posts.repartition("token", "part").sortWithinPartitions("token", "part")


def components(texts_of, classes: DataFrame, lists: DataFrame, need: int, percent: int, shingle: int, block: int = BLOCK) -> DataFrame:
    """(cls, comp) for the classes in ``lists``. ``texts_of``: texts of the classes of a table."""
    schema = "token long, part long, cls long, comp long, side int, mask long"
    n_lists = lists.count()
    sizes = written(_sizes(lists, None), "lists", n_lists)
    posts = lists.join(sizes, "token").withColumn("comp", F.col("cls"))
    suspects = _by_list(_dealt(posts, block, 0, False), classes).mapInArrow(_suspects(need), schema)
    suspects = written(suspects, "suspects", n_lists, 100_000)
    hot = written(sizes.where(F.col("n") > block).select("token"), "hot", n_lists)
    hot_lists = written(lists.join(hot, "token", "left_semi"), "hot", n_lists)
    met = written(suspects.select("cls").union(hot_lists.select("cls")).distinct(), "met", n_lists)
    members = met.count()
    size = classes.join(met, "cls", "left_semi").agg(F.coalesce(F.sum("n_shingles"), F.lit(0))).first()[0]
    sets = written(texts_of(met).mapInArrow(_set_builder(shingle), "cls long, members binary"), "sets", 5 * size, FILE_BYTES >> 1)
    if sets.count() > members:  # rows that repeat an id and a text
        sets = written(sets.dropDuplicates(["cls"]), "sets", 5 * size, FILE_BYTES >> 1)
    comps = met.withColumn("comp", F.col("cls"))

    def linked(suspects: DataFrame, comps: DataFrame) -> tuple[DataFrame, int]:
        """Components after the links that the suspects' pairs give, and the number of links."""
        links = _by_list(suspects, classes, sets).mapInArrow(_linker(need, percent), "u long, v long").distinct()
        links = written(links, "links", members)
        if not (found := links.count()):
            return comps, 0
        moved = contracted(links).select(F.col("node").alias("comp"), "label")
        return written(comps.join(moved, "comp", "left").select("cls", F.coalesce("label", "comp").alias("comp")), "components", members), found

    comps, found = linked(suspects, comps)
    for turn in range(1, MAX_ROUNDS + 1):
        sizes = written(_sizes(hot_lists, comps), "lists", n_lists)
        left = sizes.agg(F.max(F.col("n") - F.col("n_main"))).first()[0]
        if left is None:
            break
        # blocks by another hash join what they can, as long as that is much
        last = left <= block or 20 * found < left or turn == MAX_ROUNDS
        posts = _dealt(hot_lists.join(comps, "cls").join(sizes, "token"), block, turn, last)
        comps, found = linked(_by_list(posts, classes).mapInArrow(_suspects(need), schema), comps)
        if last:
            break
    return comps


def near_duplicates(docs: DataFrame, text: str = "text", id: str = "doc_id", shingle: int = SHINGLE, percent: int = PERCENT, need: int = NEED) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, hash`` (of the text)``, n_shingles, component_id, kept``."""
    id_type = docs.schema[id].dataType
    source = docs.select(F.col(id).alias("doc_id"), text_of(docs, text).alias("text"))
    schema = T.StructType(
        [
            T.StructField("doc_id", id_type),
            T.StructField("hash", T.LongType()),
            T.StructField("n_shingles", T.LongType()),
            T.StructField("cls", T.LongType()),
            T.StructField("signature", T.ArrayType(T.IntegerType())),
        ]
    )
    sketches = source.withColumn("hash", F.xxhash64("text")).mapInArrow(_sketcher(shingle), schema)
    sketches = written(sketches, "sketches", text_bytes(docs, text), FILE_BYTES)
    classes = sketches.where("cls IS NOT NULL").groupBy("cls")
    # the least id, an absent one last, with the text it stands beside
    least = F.min(F.struct(F.col("doc_id").isNull().alias("last"), F.col("doc_id").alias("id"), "hash")).alias("least")
    classes = classes.agg(F.first("signature").alias("signature"), F.first("n_shingles").alias("n_shingles"), least)
    classes = classes.select("cls", "signature", "n_shingles", F.col("least.id").alias("smallest"), F.col("least.hash").alias("head_hash"))
    classes = written(classes, "classes", sketches.count(), 30_000)
    n = classes.count()
    lists = written(_lists(classes, need, n), "postings", n * (COORDINATES - need + 1))

    def texts_of(met: DataFrame) -> DataFrame:
        heads = classes.join(met, "cls", "left_semi").select(F.col("smallest").alias("met"), "head_hash")
        heads = written(heads, "ids", n)
        if isinstance(id_type, T.NumericType) and heads.limit(FEW_HEADS + 1).count() <= FEW_HEADS:
            heads = F.broadcast(heads)  # an id and a hash each, so a few megabytes; the texts then stay where they are
        same = F.col("doc_id").eqNullSafe(F.col("met")) & (F.col("hash") == F.col("head_hash"))
        return source.withColumn("hash", F.xxhash64("text")).join(heads, same, "left_semi").select("text")

    comps = components(texts_of, classes, lists, need, percent, shingle)
    of_class = classes.join(comps, "cls", "left").select("cls", "smallest", F.coalesce("comp", "cls").alias("comp"))
    least = F.min(F.struct(F.col("smallest").isNull().alias("last"), F.col("smallest").alias("id"), F.col("cls").alias("cls"))).alias("least")
    heads = written(of_class.groupBy("comp").agg(least), "heads", n)
    of_class = written(of_class.join(heads, "comp").select("cls", F.col("least.id").alias("head"), F.col("least.cls").alias("head_cls")), "classes", n)
    rows = sketches.select("doc_id", "hash", "n_shingles", "cls")
    full = rows.where("cls IS NOT NULL").join(of_class, "cls")
    out = full.select("doc_id", "hash", "n_shingles", F.col("head").alias("component_id"), (F.col("doc_id").eqNullSafe(F.col("head")) & (F.col("cls") == F.col("head_cls"))).alias("kept"))
    alone = rows.where("cls IS NULL").select("doc_id", "hash", "n_shingles", F.col("doc_id").alias("component_id"), F.lit(True).alias("kept"))
    return out.unionByName(alone)


def drop_near_duplicates(docs: DataFrame, text: str = "text", id: str = "doc_id", **settings) -> DataFrame:
    """The rows of ``docs`` that stay, with their own columns."""
    stay = near_duplicates(docs, text, id, **settings).where("kept")
    stay = stay.groupBy(F.col("doc_id").alias("_id"), F.col("hash").alias("_hash")).agg(F.max("n_shingles").alias("n_shingles"))
    rows = docs.select(whole_row(docs), docs[id].alias("doc_id"), F.xxhash64(text_of(docs, text)).alias("hash"))
    rows = rows.join(stay, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("hash") == F.col("_hash")))
    place = F.row_number().over(W.partitionBy("doc_id", "hash").orderBy(F.lit(0)))
    # one of the rows that repeat an id and a text, which map tasks see to before the rows are dealt
    one = rows.where("n_shingles > 0").withColumn("place", place).where("place = 1")
    return one.select("row.*").unionByName(rows.where("n_shingles = 0").select("row.*"))


@query()
def op10_minhash_near_dedup(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return near_duplicates(docs, shingle=2).drop("hash")
