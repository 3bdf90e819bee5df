import random

import numpy as np
import pyarrow as pa
import pytest

from holdfast.llm import text as T

from .conftest import LOWER, WORD


@pytest.mark.parametrize("piece", [1 << 20, 16])
def test_words_and_windows(monkeypatch, piece):
    monkeypatch.setattr(T, "PIECE", piece)
    rng = random.Random(piece)
    for _ in range(60):
        rows = [None if rng.random() < 0.1 else "".join(rng.choice("ab é\n\t  X　") for _ in range(rng.choice([0, 1, 5, 40, 100]))) for _ in range(rng.choice([0, 1, 7]))]
        found = T.Words(pa.array(rows, pa.string()), lower=True)
        want = [WORD.findall((r or "").translate(LOWER)) for r in rows]
        got = [
            [bytes(found.data[s:e]).decode() for s, e in zip(found.start[lo:hi], found.end[lo:hi])]
            for lo, hi in zip(found.first[:-1], found.first[1:])
        ]
        assert got == want
        flat = [w for r in want for w in r]
        assert len(set(zip(flat, found.hash.tolist()))) == len(set(flat)) == len(set(found.hash.tolist()))
        for n in (1, 2, 5):
            hashes, at = T.windows(found, n)
            runs = [tuple(r[i : i + n]) for r in want for i in range(len(r) - n + 1)]
            assert len(runs) == len(hashes) == len(at)
            assert len(set(zip(runs, hashes.tolist()))) == len(set(runs)) == len(set(hashes.tolist()))


def test_slices_keep_every_row():
    batch = pa.record_batch({"text": pa.array(["x" * 40, None, "y" * 400, "", "z"])})
    parts = list(T.slices([batch, batch.slice(0, 0)], size=50))
    assert pa.Table.from_batches(parts)["text"].to_pylist() == batch["text"].to_pylist()
    assert max(p.num_rows for p in parts) < 5


def test_mix_is_a_bijection_on_a_sample():
    x = np.arange(100_000, dtype=np.uint64)
    assert len(np.unique(T.mix(x))) == len(x)


def test_other_operators_caches_are_dropped():
    from holdfast.llm import bpe, text, token_cache

    bpe._loaded[1], token_cache._loaded["a"] = "held", "held"
    text.forget()
    assert not bpe._loaded and not token_cache._loaded
