"""Language identification with string kernels.

Two texts are compared by the blended spectrum presence kernel: the byte
n-grams of length 1 to 3 (lower-cased A-Z; trigrams hashed) that both contain,
normalised by each text's own number. Kernel ridge regression, one language
versus the rest, is fitted in the Nystroem space of a few landmark texts. The
kernel is a product of presence vectors, so landmarks and their coefficients
fold into one weight matrix, and texts are scored by batched products of their
presence matrix with it.

Fitting uses at most ``TRAIN_ROWS`` labelled rows, spread evenly over the
languages, in the order of a hash of their ids; every row is scored, on its
whole text.

The score is what a text's n-grams add to the best language's share of the learned
rows, relative to what a sure text of it has: 0 if they say nothing or speak
against it, 1 if sure. It does not depend on the number of languages, so texts of
symbols and texts in languages never learned are near 0 with any number.

Cases: a text that is null or has no letter is ``und`` with score 0, and so is
every text if nothing could be learned; equal scores go to the first language in
code point order; rows without id are never learned from; repeated rows are
scored alike; an empty table gives no rows; other columns pass through
:func:`keep_identified`.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from holdfast.llm.store import registry, text_of, whole_row
from holdfast.llm.text import PIECE, _LOWER, slices, utf8

TRAIN_ROWS = 2000
LANDMARKS = 256
RIDGE = 1e-3
PAIR_BITS, TRIPLE_BITS = 14, 15
FEATURES = 256 + (1 << PAIR_BITS) + (1 << TRIPLE_BITS)
BATCH = 64
SLICE = 512  # bytes of packed features that the fit unpacks at a time
MIN_SCORE = 0.1  # symbols and unlearned languages stay below 0.04, with two to eight languages
UNKNOWN = "und"
FOLDS, HELD_OUT = 4, 2

QUERIES, ORACLE, query = registry()

_MULTIPLIER = np.uint32(2654435761)


def _mark(flags: np.ndarray, data: np.ndarray) -> None:
    """Set the n-grams of the bytes in one row of a presence matrix."""
    for lo in range(0, len(data), PIECE):  # pieces overlap by two bytes
        one = _LOWER[data[lo : lo + PIECE + 2]].astype(np.uint32)
        flags[one] = True
        two = (one[:-1] << np.uint32(8)) | one[1:]
        flags[256 + ((two * _MULTIPLIER) >> np.uint32(32 - PAIR_BITS))] = True
        three = (two[:-1] << np.uint32(8)) | one[2:]
        flags[256 + (1 << PAIR_BITS) + ((three * _MULTIPLIER) >> np.uint32(32 - TRIPLE_BITS))] = True


def presence(column: pa.Array) -> np.ndarray:
    """Rows x features: which n-grams each text contains."""
    data, offsets = utf8(column)
    flags = np.zeros((len(offsets) - 1, FEATURES), bool)
    for row, lo, hi in zip(flags, offsets[:-1], offsets[1:]):
        _mark(row, data[lo:hi])
    return flags


def _normalised(flags: np.ndarray) -> np.ndarray:
    out = flags.astype(np.float32)
    out /= np.sqrt(np.maximum(1, flags.sum(1, dtype=np.float32)))[:, None]
    return out


def _slices(bits: np.ndarray):
    """Packed rows x features, unpacked to floats, so many features at a time."""
    for lo in range(0, bits.shape[1], SLICE):
        yield 8 * lo, np.unpackbits(bits[:, lo : lo + SLICE], axis=1).astype(np.float32)


class Classifier:
    """Folded weights: features x languages, and the share of each language as offset.

    Fitted on packed presence bits, of which a slice of features is unpacked at a time.
    """

    def __init__(self, bits: np.ndarray, labels: list[str]) -> None:
        self.languages = sorted(set(labels), key=lambda x: x.encode())
        n = len(labels)
        # rows come language after language, in a hashed order, so even steps spread over all of them
        marks = np.arange(n) if n <= LANDMARKS else np.linspace(0, n - 1, LANDMARKS).astype(int)
        kernel, sizes = np.zeros((n, len(marks))), np.zeros(n)
        for _, part in _slices(bits):
            kernel += part @ part[marks].T
            sizes += part.sum(1)
        norms = np.sqrt(np.maximum(1, sizes))
        kernel /= norms[:, None] * norms[marks]
        values, vectors = np.linalg.eigh(kernel[marks])
        good = values > 1e-8 * values.max()
        root = vectors[:, good] / np.sqrt(values[good])
        phi = kernel @ root
        goal = np.where(np.array(labels)[:, None] == np.array(self.languages)[None, :], 1.0, -1.0)
        self.offset = goal.mean(0)
        beta = np.linalg.solve(phi.T @ phi + RIDGE * n * np.eye(phi.shape[1]), phi.T @ (goal - self.offset))
        folded = (root @ beta) / norms[marks][:, None]
        self.weights = np.zeros((8 * bits.shape[1], len(self.languages)), np.float32)
        for lo, part in _slices(bits[marks]):
            self.weights[lo : lo + part.shape[1]] = part.T @ folded
        self.weights = self.weights[:FEATURES]

    def scores(self, column: pa.Array) -> np.ndarray:
        return _normalised(presence(column)) @ self.weights + self.offset


def held_out(id: Column) -> Column:
    return F.coalesce(F.crc32(id.cast("string")) % FOLDS == HELD_OUT, F.lit(False))


def fit(docs: DataFrame, text: str = "text", id: str = "doc_id", label: str = "lang", rows: int = TRAIN_ROWS) -> Classifier | None:
    """Learn from labelled rows that are not held out; None if there are none."""
    known = docs.where(docs[label].isNotNull() & docs[id].isNotNull() & ~held_out(docs[id]))
    known = known.select(F.col(id).alias("id"), F.col(label).cast("string").alias("label"), F.md5(docs[id].cast("string")).alias("key"))
    # four times the wanted rows of a label by their hash, so that no label's rows meet in one task; at most `rows` labels
    sizes = known.groupBy("label").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "label").limit(rows)
    share = F.conv(F.substring("key", 1, 8), 16, 10).cast("double") / 2.0**32
    known = known.join(F.broadcast(sizes), "label").where(share * F.col("n") < 4 * rows)
    place = F.row_number().over(W.partitionBy("label").orderBy("key"))
    chosen = known.withColumn("place", place).where(F.col("place") <= rows).orderBy("place", "label").limit(rows)
    chosen = F.broadcast(chosen.select("id").distinct())  # at most `rows` ids
    texts = docs.where(docs[label].isNotNull()).select(F.col(id).alias("id"), F.col(label).cast("string").alias("label"), text_of(docs, text).alias("text"))
    texts = texts.join(chosen, "id", "left_semi").where(F.col("text").rlike(r"\p{L}"))

    def bits(batches):
        for batch in slices(batches, size=PIECE >> 2):
            packed = [x.tobytes() for x in np.packbits(presence(batch.column("text")), axis=1)]
            yield pa.RecordBatch.from_arrays([batch.column("id").cast(pa.string()), batch.column("label"), pa.array(packed, pa.binary())], ["id", "label", "bits"])

    marked = texts.mapInArrow(bits, "id string, label string, bits binary").dropDuplicates(["id"])
    learned = marked.orderBy("label", F.md5("id")).limit(rows).collect()
    if not learned:
        return None
    bits = np.frombuffer(b"".join(r["bits"] for r in learned), np.uint8).reshape(len(learned), -1)
    return Classifier(bits, [r["label"] for r in learned])


def identify(docs: DataFrame, model: Classifier | None, text: str = "text") -> Column:
    """A struct ``lang_pred, score`` for the texts of ``docs``."""
    body = text_of(docs, text)
    nothing = F.struct(F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"))
    if model is None:
        return nothing
    sent = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("lang_pred string, score double")
    def predict(column: pa.Array) -> pa.Array:
        names, best = [], []
        model = sent.value
        for batch in slices([pa.record_batch({"text": column})], size=PIECE >> 2):
            for at in range(0, batch.num_rows, BATCH):
                scores = model.scores(batch.column("text").slice(at, BATCH))
                first = scores.argmax(1)
                names += [model.languages[k] for k in first]
                # one language alone has all rows: nothing to add
                share = model.offset[first]
                best.append(np.where(share < 1, (scores[np.arange(len(first)), first] - share) / np.maximum(1 - share, 1e-9), 1.0))
        score = np.clip(np.concatenate(best), 0, 1) if best else np.zeros(0)
        return pa.StructArray.from_arrays([pa.array(names, pa.string()), pa.array(score.astype(float))], ["lang_pred", "score"])

    return F.when(body.rlike(r"\p{L}"), predict(body)).otherwise(nothing)


def predictions(docs: DataFrame, text: str = "text", id: str = "doc_id", label: str = "lang") -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` of every row."""
    found = docs.select(F.col(id), held_out(docs[id]).alias("held_out"), identify(docs, fit(docs, text, id, label), text).alias("found"))
    return found.select(id, "held_out", "found.lang_pred", "found.score")


def keep_identified(docs: DataFrame, text: str = "text", id: str = "doc_id", label: str = "lang", min_score: float = MIN_SCORE) -> DataFrame:
    """The rows of ``docs`` with a language, with their own columns."""
    found = docs.select(whole_row(docs), identify(docs, fit(docs, text, id, label), text).alias("found"))
    return found.where((F.col("found.lang_pred") != UNKNOWN) & (F.col("found.score") >= min_score)).select("row.*")


@query()
def op7_language_id(spark, sf_dir):
    return predictions(spark.read.parquet(f"{sf_dir}/documents.parquet"))
