import re

import pytest
from pyspark.sql import types as T

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
# names that the operators use for themselves
CLASHING = "row hash cls kept ids found _id _hash copy place size digest chars keep_id text_sha256 times n_tokens score lang_pred decoded f".split()
SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        *[T.StructField(c, T.StringType()) for c in CLASHING],
    ]
)


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def rows_of(texts, start=0):
    """Rows with ids from ``start`` for (text, lang, source) or text alone."""
    out = []
    for k, t in enumerate(texts):
        text, lang, source = t if isinstance(t, tuple) else (t, "en", "src0")
        out.append((start + k, text, lang, source, len(text or ""), *["x"] * len(CLASHING)))
    return out


LONG = " ".join(f"w{k % 7919}x{k}" for k in range(30_000))
EDGES = [
    None,
    "",
    " \n\t ",
    "one",
    "One",
    "two words",
    "two  words",
    "twowords",
    "12345 ... !!",
    "中文字 éÉ \U0001f600",
    ("a b c d e f g h i j", None, None),
    ("a b c d e f g h i j", "fr", ""),
    LONG,
    LONG + " tail",
    "line one\nline one\nline two\n\nline one",
    "<|endoftext|> text <|endoftext|>",
]


@pytest.fixture(scope="session")
def edges(spark):
    """Rows with every oddity: no id, null and long texts, repeated rows, clashing columns."""
    rows = rows_of(EDGES)
    rows += [rows[5], rows[5], (None, "two words", None, None, None, *[None] * len(CLASHING)), (None, None, None, None, None, *[None] * len(CLASHING))]
    return spark.createDataFrame(rows, SCHEMA).coalesce(2)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def documents(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet")
