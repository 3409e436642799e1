"""Words of whole Arrow text columns as 64-bit hashes, without a Python object per word."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

WS = np.zeros(256, bool)
WS[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
MUL = np.uint64(0x9E3779B97F4A7C15)
_T = np.random.default_rng(20240607).integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
#: Longer words are hashed one by one.
LONG = 48


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    h = h ^ (h >> np.uint64(31))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(32))


def pieces(batches: Iterator[pa.RecordBatch], column: str = "text", most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """The same rows in slices of about `most` bytes of text, so that memory doesn't follow the batch size."""
    for b in batches:
        if not b.num_rows:
            continue
        off = offsets(b.column(column))
        at = 0
        while at < b.num_rows:
            to = max(at + 1, int(np.searchsorted(off, off[at] + most, "right")) - 1)
            yield b.slice(at, to - at)
            at = to


def offsets(col: pa.Array) -> np.ndarray:
    kind = np.int64 if pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type) else np.int32
    return np.frombuffer(col.buffers()[1], kind)[col.offset : col.offset + len(col) + 1].astype(np.int64)


def raw(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all rows (null: none) and the row offsets into them."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if col.null_count:
        col = col.fill_null("")
    off = offsets(col)
    buf = col.buffers()[2]
    data = np.frombuffer(buf, np.uint8)[off[0] : off[-1]] if buf is not None and off[-1] > off[0] else np.zeros(0, np.uint8)
    return data, off - off[0]


def words(col: pa.Array, lower: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hash of each word, first word of each row and the end, byte starts, byte ends, bytes) of a text column."""
    data, off = raw(col)
    if lower:
        data = LOWER[data]
    n = len(data)
    if not n:
        z = np.zeros(0, np.int64)
        return np.zeros(0, np.uint64), np.zeros(len(off), np.int64), z, z, data
    solid = ~WS[data]
    s = solid.copy()
    s[1:] &= ~solid[:-1]
    edge = off[:-1][off[:-1] < off[1:]]
    s[edge] = solid[edge]
    e = solid.copy()
    e[:-1] &= ~solid[1:]
    e[edge[1:] - 1] = solid[edge[1:] - 1]
    start, end = np.flatnonzero(s), np.flatnonzero(e) + 1
    return hash_spans(data, start, end), np.searchsorted(start, off, "left"), start, end, data


def hash_spans(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    size = end - start
    h = np.zeros(len(start), np.uint64)
    long = np.flatnonzero(size > LONG)
    act = np.flatnonzero(size <= LONG) if len(long) else np.arange(len(start))
    j = 0
    while len(act):
        h[act] = h[act] * MUL + _T[data[start[act] + j]]
        j += 1
        act = act[size[act] > j]
    for i in long:
        h[i] = int.from_bytes(hashlib.blake2b(data[start[i] : end[i]].tobytes(), digest_size=8).digest(), "little")
    return mix(h + size.astype(np.uint64))


def grams(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of every k consecutive words, at its first word; rows aren't told apart (see inside())."""
    n = len(h) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    g = np.zeros(n, np.uint64)
    for j in range(k):
        g = g * MUL + h[j : j + n]
    return mix(g)


def inside(first: np.ndarray, total: int, k: int) -> np.ndarray:
    """Whether each of the grams() lies within one row."""
    n = total - k + 1
    if n <= 0:
        return np.zeros(0, bool)
    ok = np.ones(n + k, bool)
    for b in first[1:-1]:
        ok[max(0, b - k + 1) : b] = False
    return ok[:n]


def fold(h: np.ndarray) -> int:
    """One 64-bit value of a sequence of hashes."""
    return int.from_bytes(hashlib.blake2b(h.tobytes(), digest_size=8).digest(), "little", signed=True)
