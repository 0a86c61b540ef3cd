"""Vectorised text helpers shared by the operators: cut an Arrow column into
bounded blocks, find words, hash byte ranges.

Texts are handled as UTF-8 bytes.  Range hashes are prefix polynomial hashes
modulo the prime 2^61 - 1 with a base for each seed: with ``P[i]`` the running
sum of ``value * B^i``, the hash of ``[a, b)`` is ``(P[b] - P[a]) * B^-a``, so
every range costs two lookups whatever its length.  A power of two as modulus
would not do: words built by doubling (Thue-Morse) collide there under every
base.  Words have a hash of their own, mixed eight bytes at a time."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash

BLOCK_BYTES = 1 << 18
_PRIME = (1 << 61) - 1
_P = np.uint64(_PRIME)

# [^\x20\x09-\x0D]+
WORD_BYTES = np.ones(256, dtype=bool)
WORD_BYTES[[0x20, *range(0x09, 0x0E)]] = False

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def _splitmix(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over all output bits."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


mix64 = _splitmix


def byte_table(seed: int = 1) -> np.ndarray:
    with np.errstate(over="ignore"):
        return _splitmix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed)) | np.uint64(1)


def _reduce(x: np.ndarray) -> np.ndarray:
    """Any 64-bit value modulo 2^61 - 1."""
    x = (x & _P) + (x >> np.uint64(61))
    x -= _P * (x >= _P)
    return x


def mul_mod(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Products modulo 2^61 - 1 of values below it, from 31-bit halves."""
    half, low = np.uint64(31), np.uint64((1 << 31) - 1)
    a1, a0, b1, b0 = a >> half, a & low, b >> half, b & low
    mid = a1 * b0 + a0 * b1  # times 2^31; what lies above 2^61 comes back at the bottom
    return _reduce(((a1 * b1) << np.uint64(1)) + (mid >> np.uint64(30)) + ((mid & np.uint64((1 << 30) - 1)) << half) + a0 * b0)


def sub_mod(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return a - b + _P * (a < b)


def _shift_mod(x: np.ndarray, k: int) -> np.ndarray:
    """``x * 2^k`` modulo 2^61 - 1 for ``x`` below it: a rotation of 61 bits."""
    return _reduce(((x << np.uint64(k)) & _P) | (x >> np.uint64(61 - k)))


_CHUNK = 1 << 14


def _base(seed: int) -> int:
    with np.errstate(over="ignore"):
        return int(_splitmix(np.array([seed + 1], np.uint64) * np.uint64(0x9E3779B97F4A7C15))[0]) % (_PRIME - 1024) + 1000


@lru_cache(maxsize=6)
def _powers(n: int, base: int) -> np.ndarray:
    """``base^0 .. base^(n-1)`` modulo 2^61 - 1, by doubling."""
    out = np.ones(1, dtype=np.uint64)
    step = base
    while len(out) < n:
        out = np.concatenate([out, mul_mod(out, np.uint64(step))])
        step = step * step % _PRIME
    return out


def _size(n: int) -> int:
    return 1 << max(16, int(n).bit_length())


def prefix_hash(values: np.ndarray, seed: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """``(P, inverse powers)`` of a sequence of 64-bit values; see `range_hash`."""
    n = len(values)
    base, size = _base(seed), _size(n + 1)
    power = _powers(size, base)
    out = np.zeros(n + 1, dtype=np.uint64)
    half, low = np.uint64(31), np.uint64((1 << 31) - 1)
    for a in range(0, n, _CHUNK):  # pieces that stay in the cache
        b = min(a + _CHUNK, n)
        term = mul_mod(_reduce(values[a:b]), power[a:b])
        term[0] += out[a]
        # halves are summed apart: neither sum can overflow
        high = _shift_mod(_reduce(np.cumsum(term >> half)), 31)
        out[a + 1 : b + 1] = _reduce(high + _reduce(np.cumsum(term & low)))
    return out, _powers(size, pow(base, -1, _PRIME))[: n + 1]


def range_raw(prefix: np.ndarray, inv: np.ndarray, start: np.ndarray | slice, end: np.ndarray | slice) -> np.ndarray:
    """Unmixed hash of each ``[start, end)``; ranges of one length compare."""
    return mul_mod(sub_mod(prefix[end], prefix[start]), inv[start])


def range_hash(prefix: np.ndarray, inv: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Mixed hash of each ``[start, end)``; equal content and length give
    equal hashes wherever the range lies."""
    with np.errstate(over="ignore"):
        return _splitmix(range_raw(prefix, inv, start, end) + (end - start).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


ARROW_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"


def small_batches(spark, size: str = "8m") -> None:
    """Rows go to Python tasks in Arrow batches of about ``size``: long texts
    else make batches of 64 MB, held by the JVM and by Python at once."""
    spark.conf.set(ARROW_BATCH, size)


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """``(offsets, bytes)`` of a string or binary array; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not pa.types.is_large_string(column.type) and not pa.types.is_large_binary(column.type):
        column = column.cast(pa.large_binary() if pa.types.is_binary(column.type) else pa.large_string())
    if column.null_count:
        column = column.fill_null(b"" if pa.types.is_large_binary(column.type) else "")
    n = len(column)
    _, off, data = column.buffers()
    offsets = np.frombuffer(off, dtype=np.int64)[column.offset : column.offset + n + 1] if n else np.zeros(1, np.int64)
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return offsets, raw


def blocks(column: pa.Array, max_bytes: int = BLOCK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Cut a column into runs of whole texts of about ``max_bytes`` (a longer
    text stands alone): ``(first row, last row + 1, bytes, offsets)`` with the
    offsets starting at 0."""
    pa.default_memory_pool().release_unused()  # workers live on: give back what earlier batches took
    offsets, raw = text_buffers(column)
    n, i = len(offsets) - 1, 0
    while i < n:
        j = int(np.searchsorted(offsets, offsets[i] + max_bytes, side="right")) - 1
        j = min(n, max(j, i + 1))
        yield i, j, raw[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
        i = j


def mapped(data: np.ndarray, table: np.ndarray) -> np.ndarray:
    """``table[data]`` of bytes for a table of 256 one-byte values; read-only."""
    return np.frombuffer(data.tobytes().translate(table.tobytes()), table.dtype)


def find_words(data: np.ndarray, offsets: np.ndarray, table: np.ndarray = WORD_BYTES) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(start, end, first)``: byte ranges of all words in order, and per text
    the index of its first word (one entry more than texts)."""
    n = len(data)
    if n == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    inside = mapped(data, table)
    begin = inside.copy()
    begin[1:] &= ~inside[:-1]
    stop = inside.copy()  # last byte of a word
    stop[:-1] &= ~inside[1:]
    cut = offsets[1:-1]
    cut = cut[(cut > 0) & (cut < n)]
    begin[cut] = inside[cut]
    stop[cut - 1] = inside[cut - 1]
    start = np.flatnonzero(begin)
    end = np.flatnonzero(stop) + 1
    return start, end, np.searchsorted(start, offsets)


def eight_bytes(data: np.ndarray) -> np.ndarray:
    """The eight bytes from every place on, as a number; zeros after the end."""
    return np.ndarray((len(data) + 1,), "<u8", np.concatenate([data, np.zeros(8, np.uint8)]), strides=(1,))


_LONG = 64  # bytes; longer words go one by one through xxh3
_MASK = np.array([(1 << 8 * k) - 1 for k in range(9)], dtype=np.uint64)


def word_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray, lower: bool = False, seed: int = 1) -> np.ndarray:
    """Hash of each byte range: its length and its bytes, eight at a time, each
    mixed into what came before."""
    if lower:
        data = mapped(data, LOWER)
    at, size = eight_bytes(data), end - start
    salt = int(_splitmix(np.array([seed], np.uint64))[0])
    with np.errstate(over="ignore"):
        first = size.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93) + np.uint64(salt)
        h = _splitmix(first ^ (at[start] & _MASK[np.minimum(size, 8)]))
        h[size == 0] = first[size == 0]
        todo = np.flatnonzero((size > 8) & (size <= _LONG))
        pos, left = start[todo] + 8, size[todo] - 8
        while len(todo):
            h[todo] = _splitmix(h[todo] ^ (at[pos] & _MASK[np.minimum(left, 8)]))
            on = np.flatnonzero(left > 8)
            todo, pos, left = todo[on], pos[on] + 8, left[on] - 8
    for k in np.flatnonzero(size > _LONG).tolist():
        h[k] = xxhash.xxh3_64_intdigest(data[start[k] : end[k]].tobytes(), salt)
    return h


def per_text(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sum of per-word values over each text."""
    total = np.zeros(len(values) + 1, dtype=np.int64)
    np.cumsum(values, out=total[1:])
    return total[first[1:]] - total[first[:-1]]


def row_of(first: np.ndarray) -> np.ndarray:
    """Text number of every word."""
    return np.repeat(np.arange(len(first) - 1), np.diff(first))


def ragged(start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Concatenated ``arange(start_i, start_i + length_i)``."""
    total = int(length.sum())
    if not total:
        return np.zeros(0, np.int64)
    ends = np.cumsum(length)
    return np.arange(total, dtype=np.int64) + np.repeat(start - (ends - length), length)
