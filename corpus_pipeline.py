"""The corpus pipeline: five stages over ``documents``, each written and read again by the next.

Language ID drops texts without a language, exact dedup keeps one of equal texts,
MinHash near-dedup (five-word shingles, similarity 0.8) one of each group, mixing
takes documents by source weights, once or twice each, and the last stage encodes
every text with a public vocabulary and decodes it again.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from holdfast.llm import bpe, exact_dedup, language, mixing, near_dedup
from holdfast.llm.store import FILE_BYTES, text_bytes, written


def sized(kept: DataFrame, docs: DataFrame) -> DataFrame:
    """A stage's rows in no more files than its input's texts need, so that sparse partitions leave no tiny files."""
    return kept.coalesce(1 + text_bytes(docs) // FILE_BYTES)


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return sized(language.keep_identified(docs), docs)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return sized(exact_dedup.drop_duplicates(docs), docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return sized(near_dedup.drop_near_duplicates(docs), docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return sized(mixing.mixed(docs), docs)


def encode_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Per document: id, language, source, packed token ids, their number, and digests of the ids and of the decoded text."""
    coded = bpe.round_trip(docs, bpe.vocabulary_path(), keep=["doc_id", "lang", "source"])
    coded = coded.select(
        "doc_id",
        "lang",
        "source",
        "ids",
        "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )
    return sized(coded, docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language ID", identify_language),
    ("exact dedup", drop_exact_copies),
    ("MinHash near-dedup", drop_near_copies),
    ("mixing sources to target weights", mix_sources),
    ("BPE encoding and decoding", encode_tokens),
]

# a classifier, signatures and merges have no SQL; tests/llm compares with a brute-force version
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = written(docs, f"stage-{k + 1}")
    return docs
