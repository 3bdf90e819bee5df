import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

import pytest

from holdfast.llm import language as L


def test_held_out_accuracy(documents):
    found = L.predictions(documents).join(documents.select("doc_id", "lang"), "doc_id").collect()
    assert len(found) == documents.count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in found)
    assert all(0 <= r.score <= 1 for r in found)
    tested = [r for r in found if r.held_out]
    assert sum(r.lang_pred == r.lang for r in tested) >= 0.98 * len(tested)
    assert L.keep_identified(documents).count() == documents.count()


@pytest.mark.parametrize("n", [2, 4, 5, 8])
def test_junk_and_unlearned_languages_go(spark, n):
    rng = np.random.default_rng(n)
    letters = [list("aeioubdfglm"), list("öäükrtsche"), list("éèçpqvntou"), list("ñóázjlera"), list("yþðæhfnr"), list("øåkgdtls"), list("ăîşţcbmu"), list("őűzsgyle")]
    syllables = [["".join(rng.choice(l, 3)) for _ in range(12)] for l in letters]

    def text(k, words):
        return " ".join("".join(rng.choice(syllables[k], 2)) for _ in range(words))

    rows = [(k * 1000 + i, text(k, 30), f"l{k}") for k in range(n) for i in range(60)]
    short = [(10**5 + k * 10 + i, text(k, 4), None) for k in range(n) for i in range(5)]
    gone = ["x 12345 ... !!", "#### $$$$ %%%% 123 456 w", "1234567890 -- 77", "Быстрая лиса прыгает через собаку", "中文字是一种文字", "سريع الثعلب البني يقفز فوق الكلب"]
    docs = spark.createDataFrame(rows + short + [(10**6 + k, t, None) for k, t in enumerate(gone)], "doc_id long, text string, lang string")
    kept = {r.doc_id for r in L.keep_identified(docs).collect()}
    assert kept == {r[0] for r in rows + short}


def test_labels_and_ids_are_no_input_of_a_prediction(documents):
    model = L.fit(documents)
    text = documents.where("doc_id < 20")
    other = text.withColumn("lang", F.lit("xx")).withColumn("source", F.lit("y")).withColumn("doc_id", F.col("doc_id") + 10**6)
    one = text.orderBy("doc_id").select(L.identify(text, model).alias("p")).collect()
    two = other.orderBy("doc_id").select(L.identify(other, model).alias("p")).collect()
    assert one == two


def test_kernel_equals_shared_ngrams():
    texts = ["the cat", "the hat", "", "äx"]
    flags = L.presence(pa.array(texts))
    grams = [{t.encode()[i : i + n] for n in (1, 2, 3) for i in range(len(t.encode()) - n + 1)} for t in texts]
    for a in range(4):
        for b in range(4):  # so few n-grams do not collide
            assert int((flags[a] & flags[b]).sum()) == len(grams[a] & grams[b])
    model = L.Classifier(np.packbits(flags[:2], axis=1), ["a", "b"])
    z = L._normalised(flags[:2])
    assert model.weights.shape == (L.FEATURES, 2)
    # folded weights give what kernels with the landmarks give
    again = np.linalg.lstsq(z @ z.T, z @ model.weights, rcond=None)[0]
    assert np.allclose((z @ z.T) @ again, z @ model.weights, atol=1e-4)


def test_fit_equals_kernels_on_unpacked_rows(documents, monkeypatch):
    """Ridge regression in the landmarks' space, from whole matrices; predictions of all rows from it."""
    rows = [r for r in documents.collect() if r.text and r.lang and r.doc_id % 2][:60]
    texts, labels = [r.text for r in rows], [r.lang for r in rows]
    flags = L.presence(pa.array(texts))
    monkeypatch.setattr(L, "LANDMARKS", 20)
    monkeypatch.setattr(L, "SLICE", 100)
    model = L.Classifier(np.packbits(flags, axis=1), labels)
    x = flags / np.sqrt(flags.sum(1))[:, None]
    z = x[np.linspace(0, len(x) - 1, 20).astype(int)]
    values, vectors = np.linalg.eigh(z @ z.T)
    root = vectors / np.sqrt(values)
    phi, goal = x @ z.T @ root, np.where(np.array(labels)[:, None] == np.array(sorted(set(labels))), 1.0, -1.0)
    beta = np.linalg.solve(phi.T @ phi + L.RIDGE * len(x) * np.eye(20), phi.T @ (goal - goal.mean(0)))
    everything = pa.array([r.text or "" for r in documents.collect()])
    every = L.presence(everything)
    want = (every / np.sqrt(np.maximum(1, every.sum(1)))[:, None]) @ z.T @ root @ beta + goal.mean(0)
    got = model.scores(everything)
    assert np.allclose(got, want, atol=1e-4)
    clear = np.sort(want, axis=1)[:, -1] - np.sort(want, axis=1)[:, -2] > 1e-3
    assert (got.argmax(1) == want.argmax(1))[clear].all() and clear.mean() > 0.9


def test_fit_is_small():
    """Two thousand rows are fitted in under 200 MB beside their bits."""
    import tracemalloc

    bits = np.random.default_rng(0).integers(0, 256, (2000, L.FEATURES // 8), dtype=np.uint8)
    tracemalloc.start()
    L.Classifier(bits, [f"l{k % 4}" for k in range(2000)])
    assert tracemalloc.get_traced_memory()[1] < 200e6
    tracemalloc.stop()


def test_pieces_of_a_long_text(monkeypatch):
    text = pa.array(["abcdefghij klmno" * 20])
    whole = L.presence(text)
    monkeypatch.setattr(L, "PIECE", 7)
    assert (L.presence(text) == whole).all()


def test_edges(edges, empty):
    found = L.predictions(edges).collect()
    assert len(found) == edges.count()
    none = [r for r in found if r.doc_id in (0, 1, 2, 8)]
    assert all(r.lang_pred == "und" and r.score == 0 for r in none) and len(none) == 4
    assert {r.lang_pred for r in found} <= {"und", "en", "fr"}
    kept = L.keep_identified(edges, min_score=0.0)
    assert kept.columns == edges.columns and kept.count() == sum(r.lang_pred != "und" for r in found)
    unlabelled = L.predictions(edges.withColumn("lang", F.lit(None).cast("string"))).collect()
    assert {(r.lang_pred, r.score) for r in unlabelled} == {("und", 0.0)}
    assert L.predictions(empty).count() == 0 and L.keep_identified(empty).count() == 0
