"""Quality rules: base counts of each text, and a hashed n-gram log-likelihood ratio.

Byte n-grams of length 1 to 3 are hashed into buckets. Two smoothed multinomials
over the buckets, one of trusted texts and one of the whole corpus, give each
n-gram a weight, the logarithm of its probability ratio. A text's score is the
mean weight of its n-grams, and a text stays if the score reaches a fixed
threshold and it does not fail the base rules. The corpus counts cover every
document; the trusted texts are at most ``TRUSTED_ROWS`` documents labelled good,
taken in the order of a hash of their ids.

Cases: null counts as empty, has no words and fails; a text of any length is
counted whole; without trusted texts every score is 0 and only the base rules
speak; a document labelled twice counts once; rows without id are scored but
never trusted; repeated rows are judged alike; an empty table gives no rows;
other columns pass through :func:`keep_good`.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from holdfast.llm.store import registry, text_of, whole_row
from holdfast.llm.text import PIECE, Words, slices, utf8, windows

BITS = 16
BUCKETS = 1 << BITS
SMOOTHING = 1.0
THRESHOLD = -0.3
TRUSTED_ROWS = 20_000
WINDOW = 5
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20

QUERIES, ORACLE, query = registry()

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_MULTIPLIERS = (np.uint32(2654435761), np.uint32(2246822519), np.uint32(3266489917))


def buckets(data: np.ndarray) -> Iterator[np.ndarray]:
    """The buckets of all n-grams of a text's bytes, run by run."""
    shift = np.uint32(32 - BITS)
    for lo in range(0, len(data), PIECE):
        code = data[lo : lo + PIECE + 2].astype(np.uint32)
        for n, multiplier in enumerate(_MULTIPLIERS):
            if n:
                code = (code[:-1] << np.uint32(8)) | data[lo + n : lo + n + len(code) - 1]
            # the bytes shared with the next run begin an n-gram there
            yield ((code[:PIECE] + np.uint32(n)) * multiplier) >> shift


def base_counts(column: pa.Array) -> dict[str, np.ndarray]:
    """``n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words`` of each text."""
    words = Words(column)
    data, offsets = words.data, words.offsets
    rows = len(offsets) - 1
    per_row = lambda flags: np.diff(np.concatenate([[0], np.cumsum(flags)])[offsets])
    space = (data == 0x20) | ((data >= 0x09) & (data <= 0x0D))
    hashes, at = windows(words, WINDOW)
    row = np.searchsorted(words.first, at, side="right") - 1
    order = np.lexsort((hashes, row))
    h, r = hashes[order], row[order]
    same = (h[1:] == h[:-1]) & (r[1:] == r[:-1])
    twice = np.zeros(len(at), bool)
    twice[order[1:][same]] = twice[order[:-1][same]] = True
    steps = np.zeros(len(words) + WINDOW + 1, np.int64)
    np.add.at(steps, at[twice], 1)
    np.add.at(steps, at[twice] + WINDOW, -1)
    covered = np.cumsum(steps)[: len(words)] > 0
    dup_lines = np.zeros(rows, np.int64)
    whole = data.tobytes()
    for k in range(rows):
        lines = whole[offsets[k] : offsets[k + 1]].split(b"\n")
        if len(lines) > 1:
            full = [x for x in lines if x.strip(b" \t\n\x0b\x0c\r")]
            dup_lines[k] = len(full) - len(set(full))
    return {
        "n_words": words.counts.astype(np.int64),
        "word_chars": per_row(~space & ((data & 0xC0) != 0x80)),
        "n_symbols": per_row(_SYMBOL[data]),
        "n_dup_lines": dup_lines,
        "n_repeat_words": np.diff(np.concatenate([[0], np.cumsum(covered)])[words.first]),
    }


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Bucket counts of a task's trusted texts and of all its texts."""
    total = np.zeros((2, BUCKETS), np.int64)
    for batch in slices(batches):
        data, offsets = utf8(batch.column("text"))
        for trusted, lo, hi in zip(batch.column("trusted").to_pylist(), offsets[:-1], offsets[1:]):
            for found in buckets(data[lo:hi]):
                counts = np.bincount(found, minlength=BUCKETS) if len(found) > BUCKETS >> 4 else None
                for kind in (0, 1) if trusted else (1,):
                    if counts is None:
                        np.add.at(total[kind], found, 1)
                    else:
                        total[kind] += counts
    some = np.flatnonzero(total[1])
    yield pa.record_batch({"bucket": pa.array(some, pa.int32()), "trusted": pa.array(total[0][some]), "corpus": pa.array(total[1][some])})


def fit(
    docs: DataFrame, labels: DataFrame, text: str = "text", id: str = "doc_id", good: str = "quality", rows: int = TRUSTED_ROWS
) -> np.ndarray:
    """The weight of each bucket."""
    trusted = labels.where((F.col(good) == 1) & F.col(id).isNotNull()).select(F.col(id).alias("id")).distinct()
    trusted = F.broadcast(trusted.orderBy(F.md5(F.col("id").cast("string"))).limit(rows).withColumn("is", F.lit(True)))  # at most `rows` ids
    texts = docs.select(F.col(id).alias("id"), text_of(docs, text).alias("text")).join(trusted, "id", "left")
    texts = texts.select(F.coalesce("is", F.lit(False)).alias("trusted"), "text")
    counts = texts.mapInArrow(_count, "bucket int, trusted long, corpus long")
    found = counts.groupBy("bucket").agg(F.sum("trusted").alias("trusted"), F.sum("corpus").alias("corpus")).collect()  # one row per bucket
    total = np.zeros((2, BUCKETS))
    for r in found:
        total[:, r["bucket"]] = r["trusted"], r["corpus"]
    if not total[0].any():
        return np.zeros(BUCKETS)
    share = (total + SMOOTHING) / (total.sum(1, keepdims=True) + SMOOTHING * BUCKETS)
    return np.log(share[0]) - np.log(share[1])


_JUDGED = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, score double"
_JUDGED_TYPE = pa.struct([(f.split()[0], pa.float64() if f.endswith("double") else pa.int64()) for f in _JUDGED.split(", ")])


def judge(docs: DataFrame, weights: np.ndarray, text: str = "text") -> Column:
    """A struct of the base counts and the score for the texts of ``docs``."""
    sent = docs.sparkSession.sparkContext.broadcast(weights)

    @F.arrow_udf(_JUDGED)
    def judged(column: pa.Array) -> pa.Array:
        weights, parts = sent.value, [pa.array([], _JUDGED_TYPE)]
        for batch in slices([pa.record_batch({"text": column})]):
            counts = base_counts(batch.column("text"))
            data, offsets = utf8(batch.column("text"))
            scores = []
            for lo, hi in zip(offsets[:-1], offsets[1:]):
                sums = [(weights[found].sum(), len(found)) for found in buckets(data[lo:hi])]
                scores.append(sum(s for s, _ in sums) / max(1, sum(n for _, n in sums)))
            parts.append(pa.StructArray.from_arrays([*map(pa.array, counts.values()), pa.array(scores, pa.float64())], [*counts, "score"]))
        return pa.concat_arrays(parts)

    return judged(text_of(docs, text))


def verdicts(docs: DataFrame, labels: DataFrame, text: str = "text", id: str = "doc_id", threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id``, the base counts, ``base_failed``, ``score`` and ``kept`` of every row."""
    found = docs.select(F.col(id), judge(docs, fit(docs, labels, text, id), text).alias("f")).select(id, "f.*")
    return _with_verdict(found, threshold)


def _with_verdict(found: DataFrame, threshold: float) -> DataFrame:
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    return found.withColumn("base_failed", failed).withColumn("kept", ~failed & (F.col("score") >= threshold))


def keep_good(docs: DataFrame, labels: DataFrame, text: str = "text", id: str = "doc_id", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that stay, with their own columns."""
    found = docs.select(whole_row(docs), judge(docs, fit(docs, labels, text, id), text).alias("f")).select("row", "f.*")
    return _with_verdict(found, threshold).where("kept").select("row.*")


@query()
def op8_quality_rules(spark, sf_dir):
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    return verdicts(docs, labels)
