"""Array kernels over the UTF-8 bytes of Arrow string columns.

All functions work on chunks of whole documents (a chunk is at most a few MB
unless one document alone is longer), so a worker's memory follows the longest
document and not the batch.
"""

from __future__ import annotations

import contextlib
import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 512 << 10
_MASK = (1 << 64) - 1
_P = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64
_P_INV = pow(_P, -1, 1 << 64)

_rng = np.random.default_rng(20240607)
BYTE_VALUE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
BYTE_VALUE_LOWER = BYTE_VALUE.copy()
BYTE_VALUE_LOWER[65:91] = BYTE_VALUE[97:123]
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True

_powers = {"n": 0, "p": np.empty(0, np.uint64), "q": np.empty(0, np.uint64)}


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """P**i and P**-i modulo 2**64 for i < n, kept for the longest chunk seen."""
    if _powers["n"] < n:
        size = max(n, CHUNK_BYTES + 65536)
        for key, base in (("p", _P), ("q", _P_INV)):
            table = np.full(size, base, np.uint64)
            table[0] = 1
            _powers[key] = np.multiply.accumulate(table)
        _powers["n"] = size
    return _powers["p"], _powers["q"]


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer: every input bit reaches every output bit."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(33)
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts and their offsets (n + 1); a null counts as empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if len(texts) == 0:
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    binary = pa.types.is_binary(texts.type) or pa.types.is_large_binary(texts.type)
    texts = texts.cast(pa.large_binary() if binary else pa.large_string())
    if texts.null_count:
        texts = pc.fill_null(texts, b"" if binary else "")
    _, off, data = texts.buffers()
    offsets = np.frombuffer(off, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    if data is None:
        return np.empty(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    raw = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]]
    return raw, offsets - offsets[0]


def chunks(texts: pa.Array, most: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of consecutive runs of whole texts."""
    raw, offsets = buffers(texts)
    n, first = len(offsets) - 1, 0
    while first < n:
        end = int(np.searchsorted(offsets, offsets[first] + most, "right")) - 1
        end = min(max(end, first + 1), n)
        base = offsets[first]
        yield first, end, raw[base : offsets[end]], offsets[first : end + 1] - base
        first = end


def prefix_hash(values: np.ndarray) -> np.ndarray:
    """Cumulative polynomial hash, one longer than values."""
    p, _ = _power_tables(len(values) + 1)
    out = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * p[: len(values)], out=out[1:])
    return out


def span_hash(prefix: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of each [start, end); equal content gives an equal hash anywhere."""
    _, q = _power_tables(len(prefix))
    return (prefix[ends] - prefix[starts]) * q[starts]


def words(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of runs of bytes other than 0x20 and 0x09-0x0D, and the
    position of each document's first word (n + 1)."""
    n = len(offsets) - 1
    if len(raw) == 0:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.zeros(n + 1, np.int64)
    ink = ~SPACE[raw]
    opens = ink.copy()
    opens[1:] &= ~ink[:-1]
    heads = offsets[:-1][offsets[:-1] < offsets[1:]]
    opens[heads] = ink[heads]
    closes = ink.copy()
    closes[:-1] &= ~ink[1:]
    tails = offsets[1:][offsets[:-1] < offsets[1:]] - 1
    closes[tails] = ink[tails]
    starts = np.flatnonzero(opens)
    return starts, np.flatnonzero(closes) + 1, np.searchsorted(starts, offsets)


def word_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = False) -> np.ndarray:
    prefix = prefix_hash((BYTE_VALUE_LOWER if lower else BYTE_VALUE)[raw])
    return mix(span_hash(prefix, starts, ends) + (ends - starts).astype(np.uint64))


_TURN = [np.uint64(x | 1) for x in _rng.integers(1 << 32, 1 << 63, 64)]


def window_hashes(h: np.ndarray, n: int) -> np.ndarray:
    """Hash of every n consecutive entries of h; len(h) - n + 1 of them."""
    m = len(h) - n + 1
    if m <= 0:
        return np.empty(0, np.uint64)
    out = np.zeros(m, np.uint64)
    for j in range(n):
        out += h[j : j + m] * _TURN[j]
    return mix(out)


def distinct(h: np.ndarray) -> np.ndarray:
    """Sorted distinct values (sorting beats np.unique's hashing here)."""
    h = np.sort(h)
    return h[np.concatenate(([True], h[1:] != h[:-1]))] if len(h) else h


def shingle_sets(raw: np.ndarray, offsets: np.ndarray, n: int, lower: bool = True) -> list[np.ndarray]:
    """Sorted distinct hashes of each document's n-word shingles. With fewer
    words the whole sequence is the only one; without words there is none."""
    starts, ends, first = words(raw, offsets)
    h = word_hashes(raw, starts, ends, lower)
    w = window_hashes(h, n)
    out = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        if b - a >= n:
            out.append(distinct(w[a : b - n + 1]))
        elif b > a:
            short = np.zeros(1, np.uint64)
            for j in range(b - a):
                short += h[a + j : a + j + 1] * _TURN[j]
            out.append(mix(short + np.uint64(b - a)))
        else:
            out.append(np.empty(0, np.uint64))
    return out


def to_system() -> None:
    """Memory that this worker has freed goes back to the system."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # only glibc has it
        ctypes.CDLL(None).malloc_trim(0)


def released(run: Callable) -> Callable:
    """run, a function of a task's batches, for mapInArrow: once the task is over, what
    it has freed goes back to the system. Workers stay for later tasks of any stage,
    several to an executor, and would keep the room of the largest one each."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            to_system()

    return task
