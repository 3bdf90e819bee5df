import hashlib

import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from holdfast.llm import token_cache as C
from holdfast.llm.bpe import vocabulary_path
from holdfast.session import scratch_path

FILES = ["byte_bpe_50k.json", "word_bpe_49k.json", "piece_bpe_32k.model"]


def library(name):
    path = public_tokenizers.path(name)
    if name.endswith(".model"):
        pieces = sentencepiece.SentencePieceProcessor(model_file=path)
        return lambda text: len(pieces.encode(text))
    loaded = Tokenizer.from_file(path)
    loaded.no_truncation(), loaded.no_padding()
    return lambda text: len(loaded.encode(text, add_special_tokens=False).ids)


@pytest.fixture
def cache(spark):
    return scratch_path(spark, "cache")


def stored(spark, cache):
    return spark.read.parquet(cache).count()


@pytest.mark.parametrize("name", FILES)
def test_equals_the_library(edges, cache, name):
    count = library(name)
    rows = [(r.doc_id, len((r.text or "").encode()), n := count(r.text or ""), n > 1024) for r in edges.collect()]
    found = C.token_counts(edges, cache, public_tokenizers.path(name))
    assert found.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
    assert sorted(map(tuple, found.collect()), key=str) == sorted(rows, key=str)


def test_whole_table(spark, documents, cache):
    count = library(FILES[0])
    want = {r.doc_id: count(r.text or "") for r in documents.collect()}
    assert {r.doc_id: r.n_tokens for r in C.token_counts(documents, cache, vocabulary_path()).collect()} == want


@pytest.mark.parametrize("sent", [0, 10**6])
def test_only_distinct_misses_are_encoded(spark, documents, cache, sent):
    version, text = C.Version(vocabulary_path()), F.coalesce("text", F.lit(""))
    half = documents.where("doc_id % 2 = 0").unionByName(documents.where("doc_id % 2 = 0"))
    distinct = lambda df: df.select(text).distinct().count()
    assert C.fill(half, cache, version, text, sent) == distinct(half) == stored(spark, cache)
    assert C.fill(half, cache, version, text, sent) == 0
    assert C.fill(documents, cache, version, text, sent) == distinct(documents) - distinct(half)
    assert stored(spark, cache) == distinct(documents)
    digests = {bytes(r.digest) for r in spark.read.parquet(cache).collect()}
    assert digests == {hashlib.sha256((r.text or "").encode()).digest() for r in documents.collect()}


def test_stored_counts_are_used_and_other_tokenizers_are_not(spark, cache):
    docs = spark.createDataFrame([(1, "some words here"), (2, "more")], "doc_id long, text string")
    name = C.Version(vocabulary_path()).name
    digest = lambda t: bytearray(hashlib.sha256(t.encode()).digest())
    rows = [(digest("some words here"), name, 77), (digest("some words here"), name, 77), (digest("more"), "another", 55)]
    spark.createDataFrame(rows, C.CACHE).write.parquet(cache)
    assert {r.doc_id: r.n_tokens for r in C.token_counts(docs, cache, vocabulary_path()).collect()} == {1: 77, 2: 1}


def test_normalised_contents_share_a_count(spark, cache):
    """This vocabulary drops white space at the ends, so trimmed texts have the counts of the whole ones."""
    docs = spark.createDataFrame([(1, " two words  "), (2, "two words")], "doc_id long, text string")
    path, count = public_tokenizers.path("word_bpe_49k.json"), library("word_bpe_49k.json")
    found = {r.doc_id: (r.n_bytes, r.n_tokens) for r in C.token_counts(docs, cache, path, normalise=F.trim).collect()}
    assert found == {1: (12, count(" two words  ")), 2: (9, count("two words"))} and stored(spark, cache) == 1


def test_runs_of_a_long_text(monkeypatch):
    text = "the quick  brown\n\n fox's 123 jumped!!   <|endoftext|> x" * 9 + "a" * 50 + " " * 30 + "x"
    monkeypatch.setattr(C, "SEGMENT", 5)
    for name in FILES[:2]:
        tokenizer = C.Tokenizer("json", open(public_tokenizers.path(name), "rb").read())
        assert tokenizer.count(text) == library(name)(text)


def test_every_character_and_random_pieces():
    import random

    rng, tokenizer, count = random.Random(5), C.Tokenizer("json", open(vocabulary_path(), "rb").read()), library(FILES[0])
    characters = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    texts = ["".join(f"a{c} {c}{c}b" for c in characters[k : k + 64]) for k in range(0, len(characters), 64)]
    parts = ["the", "in", "ing", " ", "  ", "\n", "'s", "aaaa", "é", "1", "!?", "<|", "<|endoftext|>", "\u00a0", "x", "中", "''"]
    texts += ["".join(rng.choices(parts, k=rng.randrange(40))) for _ in range(5000)]
    assert all(tokenizer.count(t) == count(t) for t in texts)


def test_empty_table_and_clashing_columns(spark, empty, edges, cache):
    assert C.token_counts(empty, cache, vocabulary_path()).count() == 0
    kept = C.token_counts(edges, cache, vocabulary_path(), keep=["hash", "doc_id", "digest", "row"])
    assert kept.columns == ["hash", "doc_id", "digest", "row", "n_bytes", "n_tokens", "over_limit"]
    assert kept.count() == edges.count()
    with pytest.raises(ValueError):
        C.Tokenizer("txt", b"")
