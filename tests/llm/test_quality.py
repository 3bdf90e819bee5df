import re
from collections import Counter

import numpy as np
import pyarrow as pa

from holdfast.llm import quality as Q

from .conftest import EDGES, WORD


def base(text):
    text = text or ""
    w = WORD.findall(text)
    runs = [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
    often, covered, seen, again = Counter(runs), set(), set(), 0
    for i, run in enumerate(runs):
        if often[run] > 1:
            covered.update(range(i, i + 5))
    for line in text.split("\n"):
        if WORD.search(line):
            again += line in seen
            seen.add(line)
    failed = len(w) < 10 or 100 * len(covered) > 20 * len(w)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), again, len(covered), failed


def weights(texts, trusted):
    """The model by plain counting."""

    def grams(data):
        for n, multiplier in enumerate(map(int, Q._MULTIPLIERS)):
            for i in range(len(data) - n):
                code = int.from_bytes(data[i : i + n + 1], "big")
                yield (((code + n) * multiplier) & 0xFFFFFFFF) >> (32 - Q.BITS)

    counts = [Counter(), Counter()]
    for k, t in texts.items():
        found = Counter(grams((t or "").encode()))
        counts[1] += found
        if k in trusted:
            counts[0] += found
    total = [sum(c.values()) + Q.SMOOTHING * Q.BUCKETS for c in counts]
    score = {}
    for k, t in texts.items():
        found = list(grams((t or "").encode()))
        value = sum(np.log((counts[0][g] + Q.SMOOTHING) / total[0]) - np.log((counts[1][g] + Q.SMOOTHING) / total[1]) for g in found)
        score[k] = value / max(1, len(found))
    return score


def test_against_brute_force(spark, documents, sf):
    docs = documents.where("doc_id < 60")
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    want = weights(texts, {r.doc_id for r in labels.where("quality = 1").collect()})
    found = Q.verdicts(docs, labels).collect()
    assert len(found) == len(texts)
    for r in found:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == base(texts[r.doc_id])
        assert abs(r.score - want[r.doc_id]) < 1e-9
        assert r.kept == (not r.base_failed and r.score >= Q.THRESHOLD)


def test_good_texts_stay(spark, documents, sf):
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    found = Q.verdicts(documents, labels).join(labels, "doc_id").where("NOT base_failed").collect()
    good = [r for r in found if r.quality == 1]
    poor = [r for r in found if r.quality == 0]
    assert all(r.kept for r in good) and sum(r.kept for r in poor) < 0.2 * len(poor)


def test_edges(spark, edges, empty, sf):
    labels = spark.createDataFrame([(12, 1, 0), (12, 1, 0), (14, 0, 0), (None, 1, 1), (10, None, None)], "doc_id long, quality int, toxic int")
    found = {r.doc_id: r for r in Q.verdicts(edges, labels).collect()}
    for k, t in enumerate(EDGES):
        text = t[0] if isinstance(t, tuple) else t
        r = found[k]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == base(text)
    kept = Q.keep_good(edges, labels)
    assert kept.columns == edges.columns and kept.count() > 0
    none = Q.verdicts(edges, labels.limit(0)).collect()
    assert all(r.score == 0 and r.kept != r.base_failed for r in none) and len(none) == edges.count()
    assert Q.verdicts(empty, labels).count() == 0 and Q.keep_good(empty, labels).count() == 0


def test_pieces_of_a_long_text(monkeypatch):
    data = np.frombuffer(b"abcdefghij klmno pq" * 9, np.uint8)
    whole = np.sort(np.concatenate(list(Q.buckets(data))))
    monkeypatch.setattr(Q, "PIECE", 5)
    assert (np.sort(np.concatenate(list(Q.buckets(data)))) == whole).all()
    assert list(Q.base_counts(pa.array([], pa.string()))["n_words"]) == []
