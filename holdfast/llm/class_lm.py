"""Brown class n-grams: exchange clustering of words, and smoothed scores of texts.

A text is its lower-cased words and one end. Words are clustered by units: each
word with a count of ``AMPLE`` or more, and each of the ``FREQUENT`` most frequent
ones, is a unit of its own; rarer words share a unit with those whose last three
bytes have the same hash, so every word, an unknown one too, has a class.

Clustering begins with the ``FREQUENT`` words and the suffix units, the other
units counted with their suffix: their bigram matrix has a fixed size, and
exchange moves one after the other to the class that gives the largest likelihood
of the class bigrams, until a sweep moves few. If there are other units, they
start in their suffix's class, and up to ``ROUNDS`` sweeps over all units follow as
jobs: for a hashed part of the units, tasks count the classes before and after
each and choose its best class by the class bigrams. A part whose moves, made
together, lower the likelihood is taken back, and parts are halved. The driver
holds the class bigrams, and of each unit its hash, count and class.

A token's probability is that of its class after the class before, times that of
the word in its class:

    P(c' | c) = (n(c, c') + K p(c')) / (n(c) + K),   p(c') = (n(c') + 1) / (N + C)
    P(w | c)  = (n(w) + 1) / (N_c + V_c + 1)

with one slot of each class for its unknown words; the end has a class of its
own and follows itself at the start of a text. Word counts stay distributed: a
word of the ``LOOKED_UP`` most frequent is found in a table sent to the tasks,
all others by a join.

Cases: null counts as empty and is the end alone; words of a text that training
has not seen count 0; rows without id are learned from and not held out;
repeated rows are counted and scored each; without training texts every count is
0; an empty table gives no rows; of other columns only the id is returned.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from holdfast.llm.store import registry, text_of, written
from holdfast.llm.text import Words, mix, slices, utf8

CLASSES = 48
FREQUENT = 512
SUFFIXES = 511
AMPLE = 100  # words that occur as often are units of their own
LOOKED_UP = 1 << 18
PRIOR = 10.0  # K
SWEEPS = 12
ROUNDS, PARTS = 3, 3  # sweeps over all units, and the jobs of each
FOLDS, HELD_OUT = 7, 2
_FLUSH = 1 << 20  # distinct words that a task holds at a time

QUERIES, ORACLE, query = registry()

_U = np.uint64
END = np.int64(0x3A4D5B1E0C2F7A61)  # stands for the end among word hashes
_UNITS = 1 + FREQUENT + SUFFIXES  # further units are numbered from here
_RUN = 1024  # unit bigrams in a row of the written sequences
_SLOTS = 2 * CLASSES + 1  # of a unit: the class after it, the class before it, itself after itself


def suffix_groups(words: Words) -> np.ndarray:
    """For each word, a number below ``SUFFIXES`` that its last three bytes give."""
    code = np.zeros(len(words), _U)
    for k in (1, 2, 3) if len(words) else ():
        at = words.end - k
        code = (code << _U(8)) | np.where(at >= words.start, words.data[np.maximum(at, 0)], 0).astype(_U)
    return (mix(code + _U(1)) % _U(SUFFIXES)).astype(np.int64)


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(hash, suffix group, count) of a task's words, combined as far as memory allows."""
    held = [np.zeros((0, 3), np.int64)]

    def combined() -> np.ndarray:
        rows = np.concatenate(held)
        rows = rows[np.argsort(rows[:, 0], kind="stable")]
        new = np.flatnonzero(np.concatenate([[True], rows[1:, 0] != rows[:-1, 0]])) if len(rows) else np.zeros(0, np.int64)
        out = rows[new]
        if len(new):
            out[:, 2] = np.add.reduceat(rows[:, 2], new)
        return out

    def batch_of(rows: np.ndarray) -> pa.RecordBatch:
        return pa.record_batch({"hash": pa.array(rows[:, 0]), "suffix": pa.array(rows[:, 1], pa.int32()), "n": pa.array(rows[:, 2])})

    size = 0
    for batch in slices(batches):
        words = Words(batch.column("text"), lower=True)
        hashes, first, counts = np.unique(words.hash, return_index=True, return_counts=True)
        held.append(np.column_stack([hashes.view(np.int64), suffix_groups(words)[first], counts]))
        held.append(np.array([[END, 0, batch.num_rows]]))
        size += len(hashes)
        if size > 2 * _FLUSH:
            rows = combined()
            if len(rows) > _FLUSH:
                yield batch_of(rows)
                rows = rows[:0]
            held[:] = [rows]
            size = len(rows)
    rows = combined()
    for lo in range(0, len(rows), _FLUSH >> 2):
        yield batch_of(rows[lo : lo + (_FLUSH >> 2)])


class Units(NamedTuple):
    """Hashes, in order, of the words with units of their own, and the unit of each; the end is unit 0."""

    hashes: np.ndarray
    units: np.ndarray

    def of(self, words: Words) -> np.ndarray:
        unit = 1 + FREQUENT + suffix_groups(words)
        if len(self.hashes) and len(words):
            own = words.hash.view(np.int64)
            at = np.minimum(np.searchsorted(self.hashes, own), len(self.hashes) - 1)
            unit = np.where(self.hashes[at] == own, self.units[at], unit)
        return unit

    def sequence(self, words: Words) -> tuple[np.ndarray, np.ndarray]:
        """Units of all texts, each text followed by the end, and the places of the texts' first tokens."""
        first = words.first + np.arange(len(words.first))
        out = np.zeros(first[-1], np.int64)
        out[np.arange(len(words)) + words.row] = self.of(words)
        return out, first


def _before(sequence: np.ndarray, first: np.ndarray) -> np.ndarray:
    """The unit before each token; the end before a text's first."""
    out = np.concatenate([[0], sequence[:-1]]) if len(sequence) else sequence
    out[first[:-1]] = 0
    return out


def _sequencer(sent):
    """The units of texts, each text followed by the end, as runs that begin with the last unit of the run before."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        units: Units = sent.value
        for batch in slices(batches):
            sequence, _ = units.sequence(Words(batch.column("text"), lower=True))
            sequence = np.concatenate([[0], sequence]).astype(np.int32)  # the end comes before a first token
            runs = [sequence[at : at + _RUN + 1].tobytes() for at in range(0, len(sequence) - 1, _RUN)]
            yield pa.record_batch({"units": pa.array(runs, pa.binary())})

    return run


def _bigrams(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Units and the units after them, some hundred runs at a time."""
    for batch in batches:
        data, offsets = utf8(batch.column(0))
        for lo in range(0, batch.num_rows, 256):
            ends = offsets[lo : lo + 257]
            sequence = data[ends[0] : ends[-1]].view(np.int32)
            inside = np.ones(len(sequence), bool)
            inside[(ends[1:] - ends[0]) // 4 - 1] = False  # the last of a run is the first of the next
            at = np.flatnonzero(inside)
            yield sequence[at].astype(np.int64), sequence[at + 1].astype(np.int64)


def _pair_counter(sent):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        home, total = sent.value, np.zeros(_UNITS * _UNITS, np.int64)
        for unit, after in _bigrams(batches):
            pairs, counts = np.unique(home[unit] * _UNITS + home[after], return_counts=True)
            total[pairs] += counts
        some = np.flatnonzero(total)
        yield pa.record_batch({"pair": pa.array(some, pa.int32()), "n": pa.array(total[some])})

    return run


def _neighbour_counter(sent, part: int, parts: int):
    """(key, n): for the units of one part by unit and slot, and below 0 the class bigrams of all units."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cls = sent.value
        asked = mix(np.arange(1, len(cls) + 1, dtype=_U)) % _U(parts) == _U(part)
        asked[0] = False
        grid = np.zeros(CLASSES * CLASSES, np.int64)
        held, size = [], 0

        def combined() -> tuple[np.ndarray, np.ndarray]:
            if not held:
                return np.zeros(0, np.int64), np.zeros(0, np.int64)
            keys, at = np.unique(np.concatenate([k for k, _ in held]), return_inverse=True)
            return keys, np.bincount(at, np.concatenate([n for _, n in held]), len(keys)).astype(np.int64)

        def batch_of(keys: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
            return pa.record_batch({"key": pa.array(keys), "n": pa.array(n)})

        for unit, after in _bigrams(batches):
            before_cls, after_cls = cls[unit].astype(np.int64), cls[after].astype(np.int64)
            grid += np.bincount(before_cls * CLASSES + after_cls, minlength=CLASSES * CLASSES)
            own = unit == after
            right, left = asked[unit], asked[after] & ~own
            keys = [unit[right] * _SLOTS + np.where(own, 2 * CLASSES, after_cls)[right], after[left] * _SLOTS + CLASSES + before_cls[left]]
            held.append(np.unique(np.concatenate(keys), return_counts=True))
            size += len(held[-1][0])
            if size > 2 * _FLUSH:
                held[:] = [combined()]
                size = len(held[0][0])
                if size > _FLUSH:
                    yield batch_of(*held.pop())
                    size = 0
        keys, n = combined()
        for lo in range(0, len(keys), _FLUSH >> 2):
            yield batch_of(keys[lo : lo + (_FLUSH >> 2)], n[lo : lo + (_FLUSH >> 2)])
        some = np.flatnonzero(grid)
        yield batch_of(-1 - some, grid[some])

    return run


def _xlogx(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1))


def _best(grid: np.ndarray, right: np.ndarray, left: np.ndarray, self_count: float, old: int) -> int:
    """The class that a unit of class ``old`` should be in; ``grid``: class bigrams without the unit.

    ``right``, ``left``: its bigrams with the classes after and before it, without those with itself.
    """
    rows, cols = grid.sum(1), grid.sum(0)
    diagonal = np.arange(len(grid))
    gain = _xlogx(grid + right[None, :]) - _xlogx(grid)
    gain_cols = _xlogx(grid + left[:, None]) - _xlogx(grid)
    both = grid[diagonal, diagonal]
    total = gain.sum(1) - gain[diagonal, diagonal] + gain_cols.sum(0) - gain_cols[diagonal, diagonal]
    total += _xlogx(both + right + left + self_count) - _xlogx(both)
    n_right, n_left = right.sum() + self_count, left.sum() + self_count
    total -= _xlogx(rows + n_right) - _xlogx(rows) + _xlogx(cols + n_left) - _xlogx(cols)
    # marginals of the other classes do not depend on the choice
    total[0] = -np.inf
    new = int(total.argmax())
    return new if total[new] > total[old] + 1e-9 else int(old)


def exchange(counts: np.ndarray, classes: int = CLASSES, sweeps: int = SWEEPS) -> np.ndarray:
    """The class of each unit. Unit 0, the end, is class 0 alone.

    ``counts[u, v]``: how often unit v follows unit u. Units start in classes by turns, most frequent
    first, and each is moved to the class that maximises the likelihood of the class bigrams.
    """
    n_units = len(counts)
    often = counts.sum(0) + counts.sum(1)
    order = [int(u) for u in np.argsort(-often[1:], kind="stable") + 1 if often[u] > 0]
    cls = np.zeros(n_units, np.int64)
    for k, u in enumerate(order):
        cls[u] = 1 + k % (classes - 1)
    for u in range(1, n_units):  # units that training has not seen
        if often[u] == 0:
            cls[u] = 1 + u % (classes - 1)
    member = np.zeros((n_units, classes))
    member[np.arange(n_units), cls] = 1
    out_of, into = counts @ member, counts.T @ member  # of each unit: followers and predecessors by class
    grid = member.T @ out_of
    for _ in range(sweeps):
        moved = 0
        for u in order:
            old, self_count = cls[u], float(counts[u, u])
            right, left = out_of[u].copy(), into[u].copy()
            right[old] -= self_count
            left[old] -= self_count
            # without the unit
            grid[old] -= right
            grid[:, old] -= left
            grid[old, old] -= self_count
            new = _best(grid, right, left, self_count, old)
            grid[new] += right
            grid[:, new] += left
            grid[new, new] += self_count
            if new != old:
                moved += 1
                cls[u] = new
                out_of[:, old] -= counts[:, u]
                out_of[:, new] += counts[:, u]
                into[:, old] -= counts[u]
                into[:, new] += counts[u]
        if moved * 200 < len(order):
            break
    return cls


def _mover(sent, grid: np.ndarray):
    """(unit, cls) of the units that another class suits better than their own."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cls = sent.value
        for batch in batches:
            moved = []
            for unit, slots, counts in zip(batch.column("unit").to_pylist(), batch.column("slots"), batch.column("counts")):
                own = np.bincount(slots.values.to_numpy(), counts.values.to_numpy(), _SLOTS)
                right, left, self_count, old = own[:CLASSES], own[CLASSES:-1], own[-1], int(cls[unit])
                rest = grid.copy()
                rest[old] -= right
                rest[:, old] -= left
                rest[old, old] -= self_count
                new = _best(rest, right, left, self_count, old)
                if new != old:
                    moved.append((unit, new))
            units, classes = zip(*moved) if moved else ((), ())
            yield pa.record_batch({"unit": pa.array(units, pa.int64()), "cls": pa.array(classes, pa.int32())})

    return run


def likelihood(grid: np.ndarray) -> float:
    return float(_xlogx(grid).sum() - _xlogx(grid.sum(0)).sum() - _xlogx(grid.sum(1)).sum())


def refine(sequences: DataFrame, cls: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sweeps over all units from the classes ``cls``: the classes found, and their bigrams."""
    context = sequences.sparkSession.sparkContext
    kept, grid, parts, moves = cls, None, PARTS, []
    for step in range(ROUNDS * PARTS + 1):
        sent = context.broadcast(cls.astype(np.int8))
        counted = sequences.mapInArrow(_neighbour_counter(sent, step % parts, parts), "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))
        counted = written(counted, "neighbours")
        bigrams = _arrow(counted.where("key < 0"))  # at most classes squared
        found = np.zeros(CLASSES * CLASSES)
        found[-1 - bigrams.column("key").to_numpy()] = bigrams.column("n").to_numpy()
        found = found.reshape(CLASSES, CLASSES)
        if grid is not None and likelihood(found) < likelihood(grid):
            cls, parts, moves = kept, 2 * parts, []
            continue
        kept, grid = cls, found
        if step == ROUNDS * PARTS:
            break
        slots = F.struct((F.col("key") % _SLOTS).cast("int").alias("slot"), "n")
        of_unit = counted.where("key >= 0").groupBy(F.expr(f"key div {_SLOTS}").alias("unit")).agg(F.collect_list(slots).alias("all"))  # at most _SLOTS each
        of_unit = of_unit.select("unit", F.col("all.slot").alias("slots"), F.col("all.n").alias("counts"))
        moved = _arrow(of_unit.mapInArrow(_mover(sent, grid), "unit long, cls int"))
        moves.append(moved.num_rows)
        if len(moves) >= parts and sum(moves[-parts:]) * 200 < len(cls):
            break
        cls = kept.copy()
        cls[moved.column("unit").to_numpy()] = moved.column("cls").to_numpy()
    return kept, grid


class Model(NamedTuple):
    units: Units
    cls: np.ndarray  # class of each unit
    follow: np.ndarray  # log10 P(c' | c)
    size: np.ndarray  # log10 of N_c + V_c + 1
    known: np.ndarray  # hashes looked up in the tasks, in order
    counts: np.ndarray  # and their counts
    tokens: int
    types: int


def _arrow(df: DataFrame) -> pa.Table:
    return df.toArrow().combine_chunks()


def held_out(id: Column) -> Column:
    return F.coalesce(F.crc32(id.cast("string")) % FOLDS == HELD_OUT, F.lit(False))


def word_counts(texts: DataFrame) -> DataFrame:
    """(hash, suffix, n) of all words of a ``text`` column, and of the ends."""
    found = texts.mapInArrow(_count_words, "hash long, suffix int, n long")
    return written(found.groupBy("hash").agg(F.first("suffix").alias("suffix"), F.sum("n").alias("n")), "words")


def _least_count(words: DataFrame, most: int) -> int:
    """A count that at most ``most`` words reach, from the numbers of words by size of their counts."""
    steps = words.groupBy(F.floor(F.log2("n") * 16).alias("step")).agg(F.count("*").alias("words")).collect()  # some hundreds
    total, least = 0, 1 << 62
    for step, n in sorted(((r["step"], r["words"]) for r in steps), reverse=True):
        total += n
        if total > most:
            break
        least = math.ceil(2 ** (step / 16) - 1e-6)
    return least


def fit(texts: DataFrame, words: DataFrame) -> Model:
    """A model of the texts, whose words are counted in ``words``."""
    least = _least_count(words, LOOKED_UP)
    table = _arrow(words.where(F.col("n") >= min(least, AMPLE)))  # at most LOOKED_UP words, or all of AMPLE and more
    hashes, counts = (table.column(c).to_numpy() for c in ("hash", "n"))
    order = np.argsort(hashes)
    hashes, counts, suffix = hashes[order], counts[order], table.column("suffix").to_numpy()[order]
    ranked = np.lexsort((hashes, -counts))
    ranked = ranked[hashes[ranked] != END]
    ranked = ranked[: max(FREQUENT, int((counts[ranked] >= AMPLE).sum()))]
    place = np.arange(len(ranked))
    unit_of = np.zeros(len(hashes), np.int64)
    unit_of[ranked] = np.where(place < FREQUENT, 1 + place, _UNITS + place - FREQUENT)
    chosen = np.sort(ranked)
    units = Units(hashes[chosen], unit_of[chosen])
    home = np.concatenate([np.arange(_UNITS), 1 + FREQUENT + suffix[ranked[FREQUENT:]]])
    context = texts.sparkSession.sparkContext
    sequences = written(texts.mapInArrow(_sequencer(context.broadcast(units)), "units binary"), "units")
    pairs = sequences.mapInArrow(_pair_counter(context.broadcast(home)), "pair int, n long").groupBy("pair").agg(F.sum("n").alias("n"))
    pairs = _arrow(pairs)  # at most _UNITS squared
    bigrams = np.zeros(_UNITS * _UNITS)
    bigrams[pairs.column("pair").to_numpy()] = pairs.column("n").to_numpy()
    bigrams = bigrams.reshape(_UNITS, _UNITS)
    cls = exchange(bigrams)
    if len(home) > _UNITS:
        cls, grid = refine(sequences, cls[home])
    else:
        member = np.zeros((_UNITS, CLASSES))
        member[np.arange(_UNITS), cls] = 1
        grid = member.T @ bigrams @ member
    share = (grid.sum(0) + 1) / (grid.sum() + CLASSES)
    follow = np.log10((grid + PRIOR * share) / (grid.sum(1, keepdims=True) + PRIOR))
    # tokens and types of each class
    groups = _arrow(words.where(F.col("hash") != int(END)).groupBy("suffix").agg(F.sum("n").alias("n"), F.count("*").alias("types")))
    tokens, types = np.zeros(len(cls)), np.zeros(len(cls))
    at = 1 + FREQUENT + groups.column("suffix").to_numpy()
    tokens[at], types[at] = groups.column("n").to_numpy(), groups.column("types").to_numpy()
    tokens[unit_of[ranked]], types[unit_of[ranked]] = counts[ranked], 1
    np.subtract.at(tokens, 1 + FREQUENT + suffix[ranked], counts[ranked])
    np.subtract.at(types, 1 + FREQUENT + suffix[ranked], 1)
    size = np.bincount(cls, tokens + types, CLASSES) + 1
    ends = counts[hashes == END].sum()
    size[0] = ends + 1  # the end is all of its class
    total = words.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count("*").alias("types")).first()
    known = counts >= least
    return Model(units, cls, follow, np.log10(size), hashes[known], counts[known], total["n"], total["types"])


def _scorer(sent):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model: Model = sent.value
        for batch in slices(batches):
            words = Words(batch.column("text"), lower=True)
            sequence, first = model.units.sequence(words)
            cls = model.cls[sequence]
            steps = model.follow[model.cls[_before(sequence, first)], cls] - model.size[cls]
            sums = np.add.reduceat(steps, first[:-1])
            own, row = words.hash.view(np.int64), words.row
            n = np.zeros(len(own), np.int64)
            if len(model.known) and len(own):
                at = np.minimum(np.searchsorted(model.known, own), len(model.known) - 1)
                n = np.where(model.known[at] == own, model.counts[at], 0)
            ends = int(model.counts[model.known == END].sum())
            rows = batch.num_rows
            found = np.bincount(row, np.log10(n + 1.0), rows) + math.log10(ends + 1)
            n_known = np.bincount(row, n > 0, rows).astype(np.int64) + (ends > 0)
            rare = np.flatnonzero(n == 0)
            order = rare[np.lexsort((own[rare], row[rare]))]
            h, r = own[order], row[order]
            new = np.flatnonzero(np.concatenate([[True], (h[1:] != h[:-1]) | (r[1:] != r[:-1])])) if len(h) else np.zeros(0, np.int64)
            times = np.diff(np.concatenate([new, [len(h)]]))
            lists = np.concatenate([[0], np.cumsum(np.bincount(r[new], minlength=rows))]).astype(np.int32)
            yield pa.record_batch(
                {
                    "doc_id": batch.column("doc_id"),
                    "n_tokens": pa.array(np.diff(first)),
                    "found": pa.array(found),
                    "n_found": pa.array(n_known),
                    "steps": pa.array(sums),
                    "rare": pa.ListArray.from_arrays(lists, pa.array(h[new])),
                    "times": pa.ListArray.from_arrays(lists, pa.array(times, pa.int32())),
                }
            )

    return run


def score(docs: DataFrame, model: Model, words: DataFrame, text: str = "text", id: str = "doc_id") -> DataFrame:
    """One row per row of ``docs``: ``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, perplexity``."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    source = docs.select(F.col(id).alias("doc_id"), text_of(docs, text).alias("text"))
    schema = T.StructType(
        [
            source.schema["doc_id"],
            T.StructField("n_tokens", T.LongType()),
            T.StructField("found", T.DoubleType()),
            T.StructField("n_found", T.LongType()),
            T.StructField("steps", T.DoubleType()),
            T.StructField("rare", T.ArrayType(T.LongType())),
            T.StructField("times", T.ArrayType(T.IntegerType())),
        ]
    )
    # written, so that the row numbers stay
    rows = written(source.mapInArrow(_scorer(sent), schema).withColumn("row", F.monotonically_increasing_id()), "scores")
    least = int(model.counts.min()) if len(model.counts) else 1 << 62
    others = words.where(F.col("n") < least).select("hash", "n")
    rare = rows.select("row", F.explode(F.arrays_zip("rare", "times")).alias("x")).select("row", F.col("x.rare").alias("hash"), "x.times")
    more = rare.join(others, "hash").groupBy("row").agg(F.sum(F.col("times") * F.log10(F.col("n") + 1)).alias("more"), F.sum("times").alias("n_more"))
    out = rows.drop("rare", "times").join(more, "row", "left")
    numerator = F.col("found") + F.coalesce("more", F.lit(0.0))
    out = out.select(
        F.col("doc_id").alias(id),
        held_out(F.col("doc_id")).alias("held_out"),
        "n_tokens",
        (F.col("n_found") + F.coalesce("n_more", F.lit(0))).alias("n_known"),
        F.lit(model.tokens).cast("long").alias("train_tokens"),
        (numerator - F.col("n_tokens") * math.log10(model.tokens + model.types + 1)).alias("base_score"),
        (numerator + F.col("steps")).alias("score"),
    )
    return out.withColumn("perplexity", F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")))


def scored(docs: DataFrame, text: str = "text", id: str = "doc_id") -> DataFrame:
    """Every row of ``docs`` scored by a model of those that are not held out."""
    texts = docs.where(~held_out(docs[id])).select(text_of(docs, text).alias("text"))
    words = word_counts(texts)
    return score(docs, fit(texts, words), words, text, id)


@query()
def op2_class_lm(spark, sf_dir):
    return scored(spark.read.parquet(f"{sf_dir}/documents.parquet"))
