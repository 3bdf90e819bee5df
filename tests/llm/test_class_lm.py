import math
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from holdfast.llm import class_lm as M

from .conftest import words


def counted(rows):
    texts = [(r.doc_id, [*words(r.text), None]) for r in rows]
    held = {id(t): t[0] is not None and zlib.crc32(str(t[0]).encode()) % 7 == 2 for t in texts}
    count = Counter()
    for t in texts:
        if not held[id(t)]:
            count.update(t[1])
    n, v = sum(count.values()), len(count)
    return sorted(
        (
            (t[0] is None, t[0] or 0, held[id(t)], len(t[1]), sum(count[w] > 0 for w in t[1]), n, round(sum(math.log10((count[w] + 1) / (n + v + 1)) for w in t[1]), 4))
            for t in texts
        )
    )


@pytest.mark.parametrize("looked_up", [1 << 18, 40])  # few words looked up: most are joined
def test_counts_and_base(edges, documents, monkeypatch, looked_up):
    monkeypatch.setattr(M, "LOOKED_UP", looked_up)
    for docs in (edges, documents):
        found = M.scored(docs).collect()
        got = sorted((r.doc_id is None, r.doc_id or 0, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 4)) for r in found)
        want = counted(docs.collect())
        assert len(got) == len(want)
        for a, b in zip(got, want):
            assert a[:6] == b[:6] and math.isclose(a[6], b[6], abs_tol=2e-4)
    tested = [r for r in found if r.held_out]
    assert sum(r.score for r in tested) > sum(r.base_score for r in tested)


def test_probabilities_add_up(documents):
    texts = documents.select("text")
    words_ = M.word_counts(texts)
    model = M.fit(texts, words_)
    assert np.allclose((10**model.follow).sum(1), 1)
    # the known words of each class and its unknown slot
    rows = words_.collect()
    unit = dict(zip(model.units.hashes.tolist(), model.units.units.tolist()))
    total = np.zeros(M.CLASSES)
    for r in rows:
        u = 0 if r.hash == int(M.END) else unit.get(r.hash, 1 + M.FREQUENT + r.suffix)
        total[model.cls[u]] += (r.n + 1) / 10 ** model.size[model.cls[u]]
    assert np.allclose(total[0], 1) and np.allclose(total[1:] + 10 ** -model.size[1:], 1)


def test_exchange_finds_classes():
    rng = np.random.default_rng(1)
    kinds = np.array([0, *rng.integers(1, 4, 60)])  # words of three kinds follow one another in turn
    counts = np.zeros((61, 61))
    for _ in range(4000):
        k, before = 1, 0
        for _ in range(6):
            w = int(rng.choice(np.flatnonzero(kinds == k)))
            counts[before, w] += 1
            before, k = w, 1 + k % 3
        counts[before, 0] += 1
    cls = M.exchange(counts, classes=4)
    assert cls[0] == 0 and all(len(set(cls[kinds == k])) == 1 for k in (1, 2, 3)) and len(set(cls)) == 4


@pytest.mark.parametrize("flush", [1 << 20, 500])
def test_words_after_the_most_frequent_are_clustered(spark, monkeypatch, flush):
    monkeypatch.setattr(M, "AMPLE", 20)
    monkeypatch.setattr(M, "_FLUSH", flush)
    rng = np.random.default_rng(2)
    # words of three kinds follow one another in turn; all end alike
    kinds = [[f"w{3 * k + kind}ing" for k in range(250)] for kind in range(3)]
    texts = [(" ".join(kinds[(at + k) % 3][int(rng.integers(250))] for k in range(60)),) for at in rng.integers(0, 3, 800)]
    docs = spark.createDataFrame(texts, "text string").repartition(4)
    model = M.fit(docs, M.word_counts(docs))
    names = [w for kind in kinds for w in kind]
    found = M.Words(pa.array(names))
    units = model.units.of(found)
    assert len(set(units.tolist())) == 750 and (units >= M._UNITS).sum() == 750 - M.FREQUENT
    late = units >= M._UNITS
    kind = np.repeat(np.arange(3), 250)
    table = np.zeros((M.CLASSES, 3))
    np.add.at(table, (model.cls[units[late]], kind[late]), 1)
    assert table.max(1).sum() >= 0.95 * late.sum()


def test_sequences_hold_every_bigram(spark, documents):
    texts = documents.select("text")
    words_ = M.word_counts(texts)
    units = M.Units(np.zeros(0, np.int64), np.zeros(0, np.int64))
    sent = spark.sparkContext.broadcast(units)
    table = pa.table({"text": [r.text for r in texts.collect()]})
    n = sum(len(u) for u, _ in M._bigrams(M._sequencer(sent)(iter(table.to_batches()))))
    assert n == words_.agg({"n": "sum"}).first()[0]


def test_flushed_counts_are_the_same(documents, monkeypatch):
    whole = {(r.hash, r.n) for r in M.word_counts(documents.select("text")).collect()}
    import pyarrow as pa

    texts = pa.array([r.text for r in documents.collect()])
    monkeypatch.setattr(M, "_FLUSH", 500)
    total = Counter()
    for batch in M._count_words(iter([pa.record_batch({"text": texts})])):
        for h, n in zip(batch.column("hash").to_pylist(), batch.column("n").to_pylist()):
            total[h] += n
    assert set(total.items()) == whole


def test_empty(empty):
    assert M.scored(empty).count() == 0
