"""Token counts of texts, kept in a cache by digest.

The cache is a table of (content digest, tokenizer digest, tokens). Digests of the
texts are joined with the rows of this tokenizer; what is missing is reduced to one
text per digest, encoded once, and appended; then every row gets its count by its
digest. The tokenizer digest covers the file, the library and its version, so a
changed vocabulary or library never meets old counts.

Missing digests are found without moving texts. Texts move once, one per digest and
reading task: copies are combined on the map side, so a text that a third of all
rows share reaches its task a few times and not a million. If a bounded list of
missing digests goes to the readers, only missing texts move at all.

The content is the text as UTF-8, null as empty. ``normalise`` may take off more,
where a caller knows that it changes no count of the tokenizer.

The cache is only appended to, in one write per call whose files appear when it is
done. Calls that append at the same time may both add a digest: equal counts, of
which readers take one. A lost executor repeats its tasks; a failed call adds nothing.

Cases: null text counts as empty and has no tokens or bytes of its own (a tokenizer
may still give some for an empty text, which count); texts of any length are encoded
whole, byte-level BPE in runs that end where a piece ends; rows that repeat are
counted each; an empty table gives no rows and leaves the cache alone; of other
columns those named in ``keep`` pass through, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from holdfast.llm.bpe import CACHED_LENGTH, CACHED_PIECES, PATTERN, VOCABULARY_BYTES, vocabulary_path
from holdfast.llm.store import registry, text_of, written
from holdfast.llm.text import cache, slices
from holdfast.session import scratch_path

LIMIT = 1024  # tokens
SENT_DIGESTS = 100_000  # missing digests of 32 bytes that may go to all tasks
SEGMENT = 1 << 18  # characters of a byte-level text encoded at a time
CACHE = "digest binary, tokenizer string, n_tokens long"

QUERIES, ORACLE, query = registry()


class Tokenizer:
    """Counts by the library that a file is for: tokenizers for .json, sentencepiece for .model."""

    def __init__(self, kind: str, content: bytes) -> None:
        if kind == "json":
            self._load_json(content)
        elif kind == "model":
            import sentencepiece

            self._pieces = sentencepiece.SentencePieceProcessor(model_proto=content)
            self.count = lambda text: len(self._pieces.encode(text))
        else:
            raise ValueError(f"no library for .{kind} files")

    def _load_json(self, content: bytes) -> None:
        import json

        import regex
        import tokenizers

        self._library = tokenizers.Tokenizer.from_str(content.decode())
        self._library.no_truncation()
        self._library.no_padding()
        file = json.loads(content)
        cutter = file.get("pre_tokenizer") or {}
        byte_level = cutter.get("type") == "ByteLevel" and cutter.get("use_regex", True) and not cutter.get("add_prefix_space")
        added = file.get("added_tokens") or []
        bound = any(t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"] or any(map(str.isspace, t["content"])) for t in added)
        if not byte_level or file.get("normalizer") or bound:
            self.count = lambda text: len(self._library.encode(text, add_special_tokens=False))
            return
        # such a vocabulary encodes each piece of the pattern by itself, and begins one at white space after other characters
        names = sorted((t["content"] for t in added), key=len, reverse=True)
        self._added = regex.compile("(" + "|".join(map(regex.escape, names)) + ")") if names else None
        self._pieces, self._cut = regex.compile(PATTERN).findall, regex.compile(r"(?<=\S)\s").search
        self._known = _Pieces(self._library)
        self.count = self._count_pieces

    def _count_pieces(self, text: str) -> int:
        """Tokens of the added tokens and of the pieces of a text."""
        parts = self._added.split(text) if self._added and self._added.search(text) else [text]
        total = len(parts) // 2  # every second part is an added token
        for part in parts[::2]:
            for run in self._runs(part):
                total += sum(map(self._known.__getitem__, self._pieces(run)))
        return total

    def _runs(self, text: str) -> Iterator[str]:
        at = 0
        while len(text) > at + SEGMENT and (found := self._cut(text, at + SEGMENT)):
            yield text[at : found.start()]
            at = found.start()
        yield text[at:]


class _Pieces(dict):
    """Tokens of the first pieces met, which hold the frequent ones."""

    def __init__(self, library) -> None:
        super().__init__()
        self.library = library

    def __missing__(self, piece: str) -> int:
        n = len(self.library.encode(piece, add_special_tokens=False))
        if len(self) < CACHED_PIECES and len(piece) <= CACHED_LENGTH:
            self[piece] = n
        return n


_loaded: dict[str, Tokenizer] = cache()


def _tokenizer(name: str, kind: str, sent) -> Tokenizer:
    """The tokenizer of this worker, built once."""
    if name not in _loaded:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        _loaded.clear()
        _loaded[name] = Tokenizer(kind, sent.value)
    return _loaded[name]


class Version:
    """A tokenizer file with the digest that names it in the cache."""

    def __init__(self, path: str) -> None:
        self.kind = path.rsplit(".", 1)[-1]
        with open(path, "rb") as file:
            self.content = file.read(VOCABULARY_BYTES + 1)
        if len(self.content) > VOCABULARY_BYTES:
            raise ValueError(f"{path} exceeds {VOCABULARY_BYTES} bytes")
        library = __import__("tokenizers" if self.kind == "json" else "sentencepiece")
        named = f"{library.__name__} {library.__version__}\n".encode()
        self.name = hashlib.sha256(named + self.content).hexdigest()


def cached(spark: SparkSession, cache: str, tokenizer: str) -> DataFrame:
    """``digest, n_tokens`` of a tokenizer in the cache at ``cache``; none if nothing was written there yet."""
    path = spark._jvm.org.apache.hadoop.fs.Path(cache)
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return spark.createDataFrame([], CACHE).select("digest", "n_tokens")
    rows = spark.read.schema(CACHE).parquet(cache).where(F.col("tokenizer") == tokenizer)
    return rows.groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))


def _counted(texts: DataFrame, version: Version) -> DataFrame:
    """``digest, tokenizer, n_tokens`` of rows of ``digest, content``."""
    sent = texts.sparkSession.sparkContext.broadcast(version.content)
    name, kind = version.name, version.kind

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = _tokenizer(name, kind, sent)
        for batch in slices(batches, "content"):
            n = [tokenizer.count(t.as_py()) for t in batch.column("content")]
            columns = [batch.column("digest").cast(pa.binary()), pa.array([name] * len(n)), pa.array(n, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["digest", "tokenizer", "n_tokens"])

    return texts.select("digest", "content").mapInArrow(run, CACHE)


def fill(docs: DataFrame, cache: str, version: Version, content: Column, sent_digests: int = SENT_DIGESTS) -> int:
    """Encode each content of ``docs`` that the cache lacks once, append the counts, and return how many there were."""
    spark, digest = docs.sparkSession, F.unhex(F.sha2(content, 256)).alias("digest")
    needed = docs.select(digest).distinct()
    missing = written(needed.join(cached(spark, cache, version.name), "digest", "left_anti"), "missing")
    n = missing.count()
    if not n:
        return 0
    texts = docs.select(digest, content.alias("content"))
    one = lambda df: df.groupBy("digest").agg(F.any_value("content").alias("content"))
    if n <= sent_digests:
        texts = one(texts.join(F.broadcast(missing), "digest", "left_semi"))
    else:
        texts = one(texts).join(missing, "digest", "left_semi")
    _counted(texts, version).write.mode("append").option("compression", "zstd").parquet(cache)
    return n


def token_counts(
    docs: DataFrame,
    cache: str,
    path: str,
    text: str = "text",
    keep: Sequence[str] = ("doc_id",),
    limit: int = LIMIT,
    normalise: Callable[[Column], Column] = lambda text: text,
    sent_digests: int = SENT_DIGESTS,
) -> DataFrame:
    """The ``keep`` columns with ``n_bytes`` (of the text), ``n_tokens`` and ``over_limit``, one row per row.

    ``cache``: folder of the cache, shared by all executors; ``path``: a tokenizer file on the driver.
    """
    version = Version(path)
    body = text_of(docs, text)
    content = normalise(body)
    fill(docs, cache, version, content, sent_digests)
    kept = [docs[f"`{c}`"].alias(f"_{k}") for k, c in enumerate(keep)]
    rows = docs.select(*kept, F.octet_length(body).cast("long").alias("bytes"), F.unhex(F.sha2(content, 256)).alias("digest"))
    # equal texts lie together, so the table of counts is written first: a plain join, whose large keys can be split
    counts = written(cached(docs.sparkSession, cache, version.name).join(rows.select("digest").distinct(), "digest", "left_semi"), "counts")
    out = rows.join(counts, "digest")
    names = [F.col(f"_{k}").alias(c) for k, c in enumerate(keep)]
    return out.select(*names, F.col("bytes").alias("n_bytes"), "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))


@query()
def op12_token_counts(spark, sf_dir):
    """Starts from a cache of its own, so that every text of the table is encoded once."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return token_counts(docs, scratch_path(spark, "token-cache"), vocabulary_path())
