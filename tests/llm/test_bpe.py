import hashlib
import random

import numpy as np
import pytest
from tokenizers import Tokenizer

from holdfast.llm import bpe as B

from .conftest import EDGES


@pytest.fixture(scope="module")
def vocabulary():
    return B.Vocabulary(open(B.vocabulary_path(), "rb").read())


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(B.vocabulary_path())


def same(vocabulary, library, texts):
    for text, coded in zip(texts, library.encode_batch(texts, add_special_tokens=False)):
        assert np.frombuffer(vocabulary.encode(text), "<u4").tolist() == coded.ids, text[:80]


def test_every_character(vocabulary, library):
    characters = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    same(vocabulary, library, ["".join(f"a{c} {c}{c}b" for c in characters[k : k + 64]) for k in range(0, len(characters), 64)])


def test_random_and_repeated_pieces(vocabulary, library):
    rng = random.Random(4)
    parts = ["the", "in", "ing", " ", "  ", "\n", "'s", "aaaa", "é", "1", "!?", "<|", "<|endoftext|>", " ", "x", "中"]
    texts = ["".join(rng.choices(parts, k=rng.randrange(40))) for _ in range(3000)]
    texts += ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=rng.randrange(60))) for _ in range(3000)]
    texts += [c * n for c in ("a", " ", "=", "ab", "\n ") for n in range(0, 300, 7)]
    same(vocabulary, library, texts)


def test_segments_do_not_change_a_text(vocabulary, library, monkeypatch):
    monkeypatch.setattr(B, "SEGMENT", 5)
    same(vocabulary, library, ["the quick  brown\n\n fox's 123 jumped!!   ", "a" * 50, " " * 30 + "x"])


def test_long_piece_is_linear(vocabulary):
    ids = np.frombuffer(vocabulary.encode("ab" * 200_000), "<u4")
    assert vocabulary.decode(ids, np.array([0, len(ids)]))[0].tobytes() == b"ab" * 200_000


def test_round_trip(vocabulary, library, edges, empty):
    texts = {k: t[0] if isinstance(t, tuple) else t for k, t in enumerate(EDGES)}
    found = B.digests(edges, B.vocabulary_path()).collect()
    assert len(found) == edges.count()
    for r in found:
        text = texts.get(r.doc_id, "two words" if r.n_tokens else "") or ""
        ids = library.encode(text, add_special_tokens=False).ids
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()
    kept = B.encode(edges, B.vocabulary_path(), keep=["ids", "n_tokens", "doc_id"][2:] + ["source", "row"])
    assert kept.columns == ["doc_id", "source", "row", "ids", "n_tokens"] and kept.count() == edges.count()
    assert B.digests(empty, B.vocabulary_path()).count() == 0


def test_ids_that_are_not_text_decode_with_replacements(spark, vocabulary, library):
    half = vocabulary.packed["é"][:4]
    one = [i for i, t in enumerate(vocabulary.bytes) if t == b"\xc3"][0]
    df = spark.createDataFrame([(1, bytearray(one.to_bytes(4, "little"))), (2, None), (3, bytearray(half))], "doc_id long, ids binary")
    found = {r.doc_id: r.decoded for r in B.decode(df, B.vocabulary_path()).collect()}
    assert found[1] == library.decode([one], skip_special_tokens=False) and found[2] == ""
