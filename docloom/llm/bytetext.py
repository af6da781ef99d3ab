"""Vectorised work on UTF-8 text: flat buffers, word spans and polynomial hashes (numpy, no Spark)."""

from __future__ import annotations

import ctypes
import functools

import numpy as np
import pyarrow as pa

BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)
U = np.uint64
#: Bytes of a stretch in which prefix hashes are summed; no table of powers is longer.
SEGMENT = 1 << 14


def _powers(base: int, n: int) -> np.ndarray:
    out = np.ones(n, np.uint64)
    np.cumprod(np.full(n - 1, base, np.uint64), out=out[1:])
    return out


_POWER, _INVERSE = _powers(BASE, SEGMENT + 1), _powers(INVERSE, SEGMENT)
_FAR = _powers(pow(BASE, SEGMENT, 1 << 64), 1 << 17)  # BASE ** (k * SEGMENT), up to 2 GB


def power_of(length: np.ndarray) -> np.ndarray:
    """BASE ** length modulo 2**64, from two small tables; a length is below 2 GB, as Spark's strings are."""
    near = _POWER[length & (SEGMENT - 1)]
    return near * _FAR[length >> (SEGMENT.bit_length() - 1)] if len(length) and length.max() >= SEGMENT else near


def prefix_hash(buf: np.ndarray) -> np.ndarray:
    """n+1 polynomial hashes of the prefixes: out[k+1] = out[k] * BASE + byte + 1, modulo 2**64."""
    out = np.zeros(len(buf) + 1, np.uint64)
    carry = U(0)
    for i in range(0, len(buf), SEGMENT):
        part = buf[i : i + SEGMENT].astype(np.uint64) + U(1)
        n = len(part)
        out[i + 1 : i + n + 1] = np.cumsum(part * _INVERSE[:n]) * _POWER[:n] + carry * _POWER[1 : n + 1]
        carry = out[i + n]
    return out


def give_back() -> None:
    """Return memory that was freed to the system: idle workers stay alive, and hold what their allocators keep."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # absent outside glibc
    if trim:
        trim(0)


def tidy(run):
    """Wrap a function of Arrow batches: ``give_back`` when its task ends."""

    @functools.wraps(run)
    def wrapped(batches):
        try:
            yield from run(batches)
        finally:
            give_back()

    return wrapped


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser of 64 bits."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def flat(column) -> tuple[np.ndarray, np.ndarray]:
    """A string or binary Arrow column (null: empty) as one byte buffer and its n+1 offsets."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
        if isinstance(column, pa.ChunkedArray):
            column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], column.type)
    if pa.types.is_null(column.type):
        column = column.cast(pa.string())
    if column.null_count:
        column = column.fill_null(b"" if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else "")
    n = len(column)
    if not n:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    bufs = column.buffers()
    offs = np.frombuffer(bufs[1], np.int64 if wide else np.int32)[column.offset : column.offset + n + 1].astype(np.int64)
    data = np.frombuffer(bufs[2], np.uint8) if bufs[2] is not None and bufs[2].size else np.zeros(0, np.uint8)
    return data[offs[0] : offs[-1]], offs - offs[0]


def pieces(offs: np.ndarray, limit: int = 1 << 20):
    """Ranges (i, j) of rows of at most about ``limit`` bytes; a longer row stands alone, whole."""
    n, i = len(offs) - 1, 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(offs, offs[i] + limit, "right")) - 1)
        yield i, min(j, n)
        i = min(j, n)


def word_table(allowed) -> np.ndarray:
    """A table of 256 booleans from a predicate over byte values."""
    return np.array([bool(allowed(b)) for b in range(256)])


#: [^\x20\x09-\x0D]+
NOT_SPACE = word_table(lambda b: not (b == 32 or 9 <= b <= 13))
#: Lower-cases A-Z only.
LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], np.uint8)


def word_spans(buf: np.ndarray, offs: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of maximal runs of word bytes that never cross rows, and each row's first word (n+1)."""
    inside = table[buf]
    n = len(buf)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offs), np.int64)
    edge = np.zeros(n + 1, bool)
    edge[offs] = True
    begins, closes = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1] | edge[1:n]
    closes[:-1] &= ~inside[1:] | edge[1:n]
    starts, ends = np.flatnonzero(begins), np.flatnonzero(closes) + 1
    return starts, ends, np.searchsorted(starts, offs)


def span_hash(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of byte spans from one prefix polynomial, equal for equal spans in any buffer."""
    prefix = prefix_hash(buf)
    return mix(prefix[ends] - prefix[starts] * power_of(ends - starts))
