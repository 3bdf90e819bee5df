"""Byte-pair encoding by backtracking over longest matches, and decoding by an offset table.

A text is cut into pieces by the vocabulary's pattern. In a piece, an
Aho-Corasick automaton finds the longest token at every position; the encoder
takes the longest match that the last token is compatible with, tries the
token's next shorter prefix otherwise, and steps back where none is left.
Positions found hopeless are not tried again, so the work is linear in the piece.
Two tokens are compatible if the merges would not join pieces across their
border; answers are kept in a table. The result is that of applying the merges.

Token ids are packed as little-endian unsigned 32-bit integers. The bytes of all
tokens lie in one array with an offset per token, from which decoding gathers.

Cases: null counts as empty and gives no tokens; special tokens of the
vocabulary are recognised in the text; ids whose bytes are not UTF-8 decode with
replacement characters; pieces and texts of any length are encoded whole; an
empty table gives no rows; of other columns those named in ``keep`` pass through.
"""

from __future__ import annotations

import json
import struct
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from holdfast.llm.store import registry, text_of
from holdfast.llm.text import cache, slices

# fixed value: the piece pattern of byte-level vocabularies
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
VOCABULARY_BYTES = 64 << 20  # largest vocabulary file that is sent to the tasks
CACHED_PIECES = 120_000
CACHED_PAIRS = 150_000
CACHED_LENGTH = 48
SEGMENT = 1 << 20  # characters whose pieces are held at a time

QUERIES, ORACLE, query = registry()


def byte_characters() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for.

    Printable Latin-1 characters stand for themselves, the other bytes in order for the characters from 256 on.
    """
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(others)}


class Vocabulary:
    """Tokens of a byte-level BPE file, with what encoding and decoding look up."""

    def __init__(self, content: bytes) -> None:
        import ahocorasick
        import regex

        file = json.loads(content)
        model = file["model"]
        if model["type"] != "BPE" or file.get("normalizer") or (file.get("pre_tokenizer") or {}).get("type") != "ByteLevel":
            raise ValueError("a byte-level BPE vocabulary without normalizer is needed")
        byte = byte_characters()
        as_bytes = lambda token: bytes(byte[c] for c in token)
        ids = {as_bytes(token): i for token, i in model["vocab"].items()}
        size = 1 + max([*ids.values(), *(t["id"] for t in file["added_tokens"])])
        self.bytes: list[bytes] = [b""] * size
        for token, i in ids.items():
            self.bytes[i] = token
        self.length = [len(t) for t in self.bytes]
        self.rank_of_pair: dict[tuple[int, int], int] = {}
        # of a merged token: its rank and its two parts
        self.made: dict[int, tuple[int, int, int]] = {}
        for rank, pair in enumerate(model["merges"]):
            left, right = (as_bytes(t) for t in (pair if isinstance(pair, list) else pair.split(" ")))
            a, b, whole = ids[left], ids[right], ids[left + right]
            self.rank_of_pair[a, b] = rank
            self.made.setdefault(whole, (rank, a, b))
        self.shorter = [self._prefix(ids, t) for t in self.bytes]
        self.automaton = ahocorasick.Automaton()
        for token, i in ids.items():
            self.automaton.add_word(token.decode("latin-1"), i)
        self.automaton.make_automaton()
        self.special = {t["content"]: t["id"] for t in file["added_tokens"]}
        for token, i in self.special.items():
            self.bytes[i] = token.encode()
        names = sorted(self.special, key=len, reverse=True)
        self.special_pattern = regex.compile("(" + "|".join(map(regex.escape, names)) + ")") if names else None
        self.pieces = regex.compile(PATTERN).findall
        self.cut = regex.compile(r"(?<=\S)\s").search
        self.compatible: dict[int, bool] = {}
        self.packed = _Pieces(self)
        self.offsets = np.concatenate([[0], np.cumsum([len(t) for t in self.bytes])]).astype(np.int64)
        self.blob = np.frombuffer(b"".join(self.bytes), np.uint8)

    @staticmethod
    def _prefix(ids: dict[bytes, int], token: bytes) -> int:
        return next((ids[token[:n]] for n in range(len(token) - 1, 0, -1) if token[:n] in ids), -1)

    def _edge(self, token: int, part: int) -> list[tuple[int, float]]:
        """The pieces on one edge of a token as it is merged, each with the rank that consumes it."""
        chain, until = [(token, float("inf"))], token
        while (how := self.made.get(until)) is not None:
            until = how[part]
            chain.append((until, how[0]))
        return chain

    def fits(self, left: int, right: int) -> bool:
        """Whether ``left`` and ``right`` stay two tokens when their bytes are merged together.

        Merges run by rank, so a piece is on the edge until the merge that consumes it. A merge
        across the border happens if it comes before that of the left piece, and not after that
        of the right one (equal merges run from the left).
        """
        key = left << 32 | right
        known = self.compatible.get(key)
        if known is None:
            rank, rights = self.rank_of_pair, self._edge(right, 1)
            known = not any(
                (m := rank.get((a, b))) is not None and m < left_until and m <= right_until
                for a, left_until in self._edge(left, 2)
                for b, right_until in rights
            )
            if len(self.compatible) < CACHED_PAIRS:
                self.compatible[key] = known
        return known

    def encode_piece(self, piece: bytes) -> list[int]:
        n, length, shorter, known = len(piece), self.length, self.shorter, self.compatible
        longest = [-1] * n
        for end, token in self.automaton.iter(piece.decode("latin-1")):
            longest[end + 1 - length[token]] = token  # later ends are longer
        tokens: list[int] = []
        hopeless = bytearray(n + 1)
        at, token, last = 0, longest[0], -1
        while at < n:
            while token >= 0:
                if not hopeless[at + length[token]]:
                    if last < 0:
                        break
                    fits = known.get(last << 32 | token)
                    if self.fits(last, token) if fits is None else fits:
                        break
                token = shorter[token]
            if token >= 0:
                tokens.append(token)
                at += length[token]
                last, token = token, longest[at] if at < n else -1
            else:
                hopeless[at] = 1
                token = tokens.pop()
                at -= length[token]
                last, token = tokens[-1] if tokens else -1, shorter[token]
        return tokens

    def _segments(self, text: str) -> Iterator[str]:
        """The text in runs that begin at a piece: before white space after other characters."""
        at = 0
        while at < len(text):
            found = self.cut(text, at + SEGMENT) if len(text) > at + SEGMENT else None
            to = found.start() if found else len(text)
            yield text[at:to]
            at = to

    def encode(self, text: str) -> bytes:
        """Packed ids of a whole text."""
        parts = [text]
        if self.special_pattern is not None and any(t in text for t in self.special):
            parts = self.special_pattern.split(text)
        out = []
        for part in parts:
            if part in self.special:
                out.append(self.special[part].to_bytes(4, "little"))
            else:
                for segment in self._segments(part):
                    out.append(b"".join(map(self.packed.__getitem__, self.pieces(segment))))
        return b"".join(out)

    def decode(self, ids: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes of all ids, and the offsets of the rows that begin at ids ``first``."""
        starts, lengths = self.offsets[ids], self.offsets[ids + 1] - self.offsets[ids]
        ends = np.cumsum(lengths)
        place = np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - lengths), lengths)
        return self.blob[place], np.concatenate([[0], ends])[first]


    def texts(self, packed: list[bytes]) -> pa.Array:
        """The texts of rows of packed ids."""
        sizes = np.array([0, *map(len, packed)]) // 4
        data, offsets = self.decode(np.frombuffer(b"".join(packed), "<u4"), np.cumsum(sizes))
        raw = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(packed), [None, pa.py_buffer(offsets.astype(np.int64).tobytes()), pa.py_buffer(data.tobytes())]
        )
        try:
            found = raw.cast(pa.large_string())
        except pa.ArrowInvalid:
            found = pa.array([x.decode("utf-8", "replace") for x in raw.to_pylist()], pa.large_string())
        return found.cast(pa.string())


class _Pieces(dict):
    """Packed ids of the first pieces met, which hold the frequent ones."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        super().__init__()
        self.vocabulary = vocabulary

    def __missing__(self, piece: str) -> bytes:
        ids = self.vocabulary.encode_piece(piece.encode())
        packed = struct.pack(f"<{len(ids)}I", *ids)
        if len(self) < CACHED_PIECES and len(piece) <= CACHED_LENGTH:
            self[piece] = packed
        return packed


_loaded: dict[int, Vocabulary] = cache()


def _vocabulary(sent) -> Vocabulary:
    """The vocabulary of this worker, built once."""
    key = hash(sent.value)
    if key not in _loaded:
        _loaded.clear()
        _loaded[key] = Vocabulary(sent.value)
    return _loaded[key]


def _send(df: DataFrame, path: str):
    with open(path, "rb") as file:
        content = file.read(VOCABULARY_BYTES + 1)
    if len(content) > VOCABULARY_BYTES:
        raise ValueError(f"{path} exceeds {VOCABULARY_BYTES} bytes")
    return df.sparkSession.sparkContext.broadcast(content)


def encode(docs: DataFrame, path: str, text: str = "text", keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """The ``keep`` columns, ``ids`` (packed, binary) and ``n_tokens``. ``path``: a vocabulary file on the driver."""
    sent = _send(docs, path)
    kept = [docs[f"`{c}`"].alias(f"_{k}") for k, c in enumerate(keep)]
    source = docs.select(*kept, text_of(docs, text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = _vocabulary(sent)
        for batch in slices(batches):
            packed = pa.array([vocabulary.encode(t) for t in batch.column("text").to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], packed], names=[*batch.schema.names[:-1], "ids"])

    schema = T.StructType([*source.schema.fields[:-1], T.StructField("ids", T.BinaryType())])
    out = source.mapInArrow(run, schema)
    names = [F.col(f"_{k}").alias(c) for k, c in enumerate(keep)]
    return out.select(*names, "ids", (F.length("ids") / 4).cast("long").alias("n_tokens"))


def decode(tokens: DataFrame, path: str, ids: str = "ids", keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """The ``keep`` columns and ``decoded``, the text of packed ids (null ids: empty)."""
    sent = _send(tokens, path)
    kept = [tokens[f"`{c}`"].alias(f"_{k}") for k, c in enumerate(keep)]
    source = tokens.select(*kept, F.coalesce(tokens[ids], F.lit(b"")).alias("ids"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = _vocabulary(sent)
        for batch in slices(batches, "ids"):
            texts = vocabulary.texts(batch.column("ids").to_pylist())
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], texts], names=[*batch.schema.names[:-1], "decoded"])

    schema = T.StructType([*source.schema.fields[:-1], T.StructField("decoded", T.StringType())])
    names = [F.col(f"_{k}").alias(c) for k, c in enumerate(keep)]
    return source.mapInArrow(run, schema).select(*names, "decoded")


def round_trip(docs: DataFrame, path: str, text: str = "text", keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """The ``keep`` columns with ``ids``, ``n_tokens`` and ``decoded`` side by side; both ways in one pass over the rows."""
    sent = _send(docs, path)
    kept = [docs[f"`{c}`"].alias(f"_{k}") for k, c in enumerate(keep)]
    source = docs.select(*kept, text_of(docs, text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = _vocabulary(sent)
        for batch in slices(batches):
            packed = [vocabulary.encode(t) for t in batch.column("text").to_pylist()]
            columns = [*batch.columns[:-1], pa.array(packed, pa.binary()), vocabulary.texts(packed)]
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names[:-1], "ids", "decoded"])

    schema = T.StructType([*source.schema.fields[:-1], T.StructField("ids", T.BinaryType()), T.StructField("decoded", T.StringType())])
    names = [F.col(f"_{k}").alias(c) for k, c in enumerate(keep)]
    return source.mapInArrow(run, schema).select(*names, "ids", (F.length("ids") / 4).cast("long").alias("n_tokens"), "decoded")


def digests(docs: DataFrame, path: str, text: str = "text", id: str = "doc_id") -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` of every row."""
    return round_trip(docs, path, text, [id]).select(
        id, "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256")
    )


def vocabulary_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@query()
def op6_bpe_round_trip(spark, sf_dir):
    return digests(spark.read.parquet(f"{sf_dir}/documents.parquet"), vocabulary_path())
