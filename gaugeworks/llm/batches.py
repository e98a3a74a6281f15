"""Arrow batches of texts: slicing by bytes, and words as arrays of hashes.

A word is a longest run of bytes outside ASCII white space (space and 0x09-0x0D). UTF-8 never uses those
bytes inside a character, so working on bytes is exact. Words are hashed to 64 bits, all of a batch at
once: the hash of a run of bytes is a difference of running sums of ``value(byte) * base**position``.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U = np.uint64
_BASE, _BASE_INVERSE = 0x9E3779B97F4A7C15, pow(0x9E3779B97F4A7C15, -1, 1 << 64)
_LINK, _LINK_INVERSE = 0xD6E8FEB86659FD93, pow(0xD6E8FEB86659FD93, -1, 1 << 64)
_VALUES = np.random.default_rng(20).integers(1, 1 << 63, 256, dtype=U)
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

#: Bytes of text that are turned into arrays at once; arrays take about a hundred times as much memory.
PIECE = 1 << 18


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit (the finaliser of SplitMix64)."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, U)
    out[:1] = 1
    return np.multiply.accumulate(out)


_BYTE_POWERS, _BYTE_INVERSES = _powers(_BASE, PIECE + 1), _powers(_BASE_INVERSE, PIECE + 1)


def slices(batches: Iterable[pa.RecordBatch], column: str = "text", most: int = 2 << 20) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most ``most`` bytes of text, or of one row that is longer."""
    for batch in batches:
        text = batch.column(column)
        if not len(text):
            continue
        sizes = pc.binary_length(text).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
        ends = np.cumsum(sizes)
        start, base = 0, 0
        while start < len(sizes):
            stop = max(start + 1, int(np.searchsorted(ends, base + most, side="right")))
            yield batch.slice(start, stop - start)
            start, base = stop, int(ends[stop - 1])


def text_bytes(texts: pa.Array) -> list[bytes]:
    """UTF-8 bytes of each text; a null is empty."""
    return [b"" if x is None else x for x in texts.cast(pa.large_binary()).to_pylist()]


@dataclass
class Words:
    """Hashes of all words of a batch; words of row i are ``hashes[ptr[i]:ptr[i + 1]]``.

    Word k is ``data[start[k]:stop[k]]``.
    """

    hashes: np.ndarray
    ptr: np.ndarray
    data: np.ndarray
    start: np.ndarray
    stop: np.ndarray

    def rows(self) -> np.ndarray:
        """The row each word belongs to."""
        return np.repeat(np.arange(len(self.ptr) - 1), np.diff(self.ptr))


def _hash_piece(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and hashes of the words in bytes that begin and end outside any word."""
    space = _SPACE[data]
    edge = np.flatnonzero(np.diff(np.r_[True, space, True].view(np.int8)))
    start, end = edge[::2], edge[1::2]
    n = len(data) + 1
    power, inverse = (_BYTE_POWERS, _BYTE_INVERSES) if n <= PIECE + 1 else (_powers(_BASE, n), _powers(_BASE_INVERSE, n))
    sums = np.zeros(n, U)
    np.cumsum(_VALUES[data] * power[: n - 1], out=sums[1:])
    return start, end, mix((sums[end] - sums[start]) * inverse[start])


def words_of(texts: pa.Array, lower: bool = False) -> Words:
    """Hashes of the words of each text; ``lower`` turns A-Z into a-z first. A null has no words."""
    return words_in(text_bytes(texts), lower)


def words_in(rows: list[bytes], lower: bool = False) -> Words:
    """Like :func:`words_of`, of texts as bytes."""
    starts, ends, hashes = [np.empty(0, np.int64)], [np.empty(0, np.int64)], [np.empty(0, U)]
    bounds = np.zeros(len(rows) + 1, np.int64)
    np.cumsum([len(x) + 1 for x in rows], out=bounds[1:])
    data = np.frombuffer(b" ".join([*rows, b""]), np.uint8)
    if lower:
        data = _LOWER[data]
    at = 0
    while at < len(data):
        stop = min(at + PIECE, len(data))
        if stop < len(data) and not _SPACE[data[stop - 1]]:  # back to the last space, or on to the next
            near = np.flatnonzero(_SPACE[data[at:stop]])
            if len(near):
                stop = at + int(near[-1]) + 1
            else:
                step = stop
                while step < len(data) and not _SPACE[data[step : step + PIECE]].any():
                    step += PIECE
                more = np.flatnonzero(_SPACE[data[step : step + PIECE]])
                stop = step + int(more[0]) + 1 if len(more) else len(data)
        s, e, h = _hash_piece(data[at:stop])
        starts.append(s + at)
        ends.append(e + at)
        hashes.append(h)
        at = stop
    start = np.concatenate(starts)
    return Words(np.concatenate(hashes), np.searchsorted(start, bounds), data, start, np.concatenate(ends))


def runs_of(words: Words, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(start, hash) of each run of ``n`` consecutive words of one row; start counts the words of the batch."""
    total = len(words.hashes)
    if total < n:
        return np.empty(0, np.int64), np.empty(0, U)
    rows = words.rows()
    start = np.flatnonzero(rows[: total - n + 1] == rows[n - 1 :])
    if n <= 8:
        out = np.zeros(total - n + 1, U)
        for i, factor in enumerate(_powers(_LINK, n)):
            out += words.hashes[i : total - n + 1 + i] * factor
        return start, mix(out[start])
    sums = np.zeros(total + 1, U)
    np.cumsum(words.hashes * _powers(_LINK, total), out=sums[1:])
    return start, mix((sums[start + n] - sums[start]) * _powers(_LINK_INVERSE, total)[start])


def blob(values: np.ndarray) -> bytes:
    return np.ascontiguousarray(values).tobytes()
