"""Words of whole texts as numpy arrays, a few megabytes at a time.

A word is a run of bytes outside ``\\x20 \\x09-\\x0D``; in UTF-8 those bytes are
never part of another character. A word's identity is a 64-bit polynomial hash
of its bytes, finished by a mixer; two different words share one with a chance
of about 2**-64 per pair.
"""

from __future__ import annotations

import gc
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

PIECE = 1 << 20  # bytes of text whose arrays are held at a time
WORD = r"[^\x20\x09-\x0D]+"

_U = np.uint64
_BASE = _U(0x9E3779B97F4A7C15 | 1)
_INVERSE = _U(pow(int(_BASE), -1, 1 << 64))
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_powers = {}


def _table(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, at least ``n`` of each."""
    if "up" not in _powers or len(_powers["up"]) < n:
        size = max(n, PIECE + (PIECE >> 2))
        for name, base in (("up", _BASE), ("down", _INVERSE)):
            row = np.full(size, base, _U)
            row[0] = 1
            _powers[name] = np.multiply.accumulate(row)
    return _powers["up"], _powers["down"]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit mixer."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and the offsets of its rows; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    buffers = column.buffers()
    offsets = np.frombuffer(buffers[1], np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1]
    offsets = offsets.astype(np.int64) if len(offsets) else np.zeros(1, np.int64)
    data = np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(batches: Iterator[pa.RecordBatch], column: str = "text", size: int = PIECE) -> Iterator[pa.RecordBatch]:
    """The batches cut into runs of rows of about ``size`` bytes of text, one row at least."""
    for batch in batches:
        if not batch.num_rows:
            continue
        _, offsets = utf8(batch.column(column))
        at = 0
        while at < batch.num_rows:
            to = int(np.searchsorted(offsets, offsets[at] + size, side="right")) - 1
            to = min(max(to, at + 1), batch.num_rows)
            yield batch.slice(at, to - at)
            at = to
    release()


_caches: list[dict] = []


def cache() -> dict:
    """A dict for what an operator keeps in a worker from task to task."""
    _caches.append({})
    return _caches[-1]


def forget() -> None:
    """Drop what other operators keep in this worker, which may run their tasks no more."""
    if any(_caches):
        for kept in _caches:
            kept.clear()
        gc.collect()
        release()


def release() -> None:
    """Give back what Arrow keeps of freed memory, at the end of a task; its worker waits for another one."""
    pa.default_memory_pool().release_unused()


class Words:
    """Words of the rows of a column, row after row.

    ``hash``: of each word; ``start``, ``end``: its bytes in ``data``;
    ``first``: index of each row's first word, and the number of words at last.
    """

    def __init__(self, column: pa.Array, lower: bool = False) -> None:
        raw, offsets = utf8(column)
        self.data = _LOWER[raw] if lower else raw
        self.offsets = offsets
        hashes, starts, ends = [np.zeros(0, _U)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for lo, hi in self._pieces():
            h, s, e = self._words(lo, hi)
            hashes.append(h), starts.append(s), ends.append(e)
        self.hash, self.start, self.end = np.concatenate(hashes), np.concatenate(starts), np.concatenate(ends)
        self.first = np.searchsorted(self.start, offsets)

    def __len__(self) -> int:
        return len(self.hash)

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    @property
    def row(self) -> np.ndarray:
        """The row of each word."""
        return np.repeat(np.arange(len(self.offsets) - 1), self.counts)

    def _pieces(self) -> Iterator[tuple[int, int]]:
        """Runs of about a piece that begin and end at a row's border or at a space."""
        lo, total = 0, len(self.data)
        while lo < total:
            hi = min(lo + PIECE, total)
            if hi < total:
                border = int(self.offsets[np.searchsorted(self.offsets, hi, side="right") - 1])
                if border > lo:
                    hi = border
                else:
                    while hi < total:  # inside a long row: to the next space, or the row's end
                        seen = np.flatnonzero(_SPACE[self.data[hi : hi + PIECE]])
                        row_end = int(self.offsets[np.searchsorted(self.offsets, hi, side="right")])
                        if len(seen) and hi + seen[0] < row_end:
                            hi += int(seen[0])
                            break
                        if row_end <= hi + PIECE:
                            hi = row_end
                            break
                        hi += PIECE
            yield lo, hi
            lo = hi

    def _words(self, lo: int, hi: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        data = self.data[lo:hi]
        inside = ~_SPACE[data]
        opens = inside.copy()
        opens[1:] &= ~inside[:-1]
        shuts = inside.copy()
        shuts[:-1] &= ~inside[1:]
        borders = self.offsets[np.searchsorted(self.offsets, lo) : np.searchsorted(self.offsets, hi)] - lo
        borders = borders[borders > 0]
        opens[borders] |= inside[borders]
        shuts[borders - 1] |= inside[borders - 1]
        start, end = np.flatnonzero(opens), np.flatnonzero(shuts) + 1
        if not len(start):
            return np.zeros(0, _U), start, end
        up, down = _table(len(data))
        total = np.cumsum((data.astype(_U) + _U(1)) * up[: len(data)], dtype=_U)
        value = total[end - 1] - np.where(start > 0, total[start - 1], _U(0))
        return mix(value * down[start]), start + lo, end + lo


def windows(words: Words, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, index of the first word) of every run of ``n`` words within one row, in order."""
    total = len(words) - n + 1
    if total <= 0:
        return np.zeros(0, _U), np.zeros(0, np.int64)
    value = words.hash[:total].copy()
    for k in range(1, n):
        value = mix(value) * _U(0xD6E8FEB86659FD93) + words.hash[k : k + total]
    whole = np.ones(total, bool)
    for border in words.first[1:-1]:
        whole[max(0, border - n + 1) : border] = False
    at = np.flatnonzero(whole)
    return mix(value[at]), at
