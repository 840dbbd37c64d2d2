"""Vectorised reading of UTF-8 texts inside Arrow batches.

A batch's text column is looked at as one byte array with row offsets.  Byte ranges get a
64-bit hash from prefix sums of polynomials modulo two primes, finished with a bit mixer; a
prime modulus has no pairs of texts that collide for every base, as a power of two has.  Runs
of words get theirs from the mixed word hashes.  Inside a slice, :func:`exact_ids` tells
ranges apart by their bytes.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa

U64 = np.uint64


def release() -> None:
    """Give freed memory back to the system.  Python workers outlive their tasks, and an idle
    one would otherwise keep the most that it ever used."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of the GNU C library
    if trim is not None:
        trim(0)


#: Bytes of text that are looked at together: bounds the working memory of a task.
SLICE_BYTES = 1 << 19
#: Primes below 2**31, and a base for each.
_PRIMES = ((2147483647, 1540483477), (2147483629, 1066037191))
_WORD_BASE = 0xD1342543DE82EF95


@lru_cache(maxsize=8)
def _powers(base: int, n: int) -> np.ndarray:
    steps = np.full(n, base, dtype=U64)
    steps[:1] = 1
    return np.multiply.accumulate(steps)


def powers(base: int, n: int, inverse: bool = False) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64, or their inverses."""
    size = 1 << max(10, (n - 1).bit_length())
    return _powers(pow(base, -1, 1 << 64) if inverse else base, size)[:n]


@lru_cache(maxsize=8)
def _prime_powers(base: int, prime: int, n: int) -> np.ndarray:
    out = np.ones(n, np.uint32)
    size = 1
    while size < n:
        out[size : 2 * size] = out[: min(size, n - size)].astype(U64) * U64(pow(base, size, prime)) % U64(prime)
        size *= 2
    return out


def prime_powers(base: int, prime: int, n: int, inverse: bool = False) -> np.ndarray:
    """base**0 .. base**(n-1) modulo ``prime``, or their inverses."""
    size = 1 << max(10, (n - 1).bit_length())
    return _prime_powers(pow(base, -1, prime) if inverse else base, prime, size)[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every input bit over all output bits."""
    x = x ^ (x >> U64(31))
    x = x * U64(0x7FB5D329728EA185)
    x = x ^ (x >> U64(27))
    x = x * U64(0x81DADEF4BC2DD44D)
    return x ^ (x >> U64(33))


def utf8(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and row offsets of a text column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks() if column.num_chunks != 1 else column.chunk(0)
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], pa.string())
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    if not len(column):
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.empty(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def slices(offsets: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``limit`` bytes; a longer row stands alone."""
    row, rows = 0, len(offsets) - 1
    while row < rows:
        end = int(np.searchsorted(offsets, offsets[row] + limit, "right")) - 1
        end = min(rows, max(end, row + 1))
        yield row, end
        row = end


def lower_ascii(data: np.ndarray) -> np.ndarray:
    return np.where((data >= 65) & (data <= 90), data + np.uint8(32), data)


def blank(data: np.ndarray) -> np.ndarray:
    """Bytes of the white space that parts words: \\x20 and \\x09-\\x0D."""
    return (data == 32) | ((data >= 9) & (data <= 13))


@dataclass
class Words:
    """Words of some rows: byte range, row and hash of each, and each row's first word."""

    start: np.ndarray
    end: np.ndarray
    row: np.ndarray
    hash: np.ndarray
    first: np.ndarray

    @property
    def count(self) -> np.ndarray:
        return np.diff(self.first)


def ranges(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of ``inside``, which never cross a row's end."""
    if not len(inside):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    begins, ends = inside.copy(), inside.copy()
    rows = offsets[(offsets > 0) & (offsets < len(inside))]
    joined = inside[1:] & inside[:-1]
    joined[rows - 1] = False
    begins[1:] &= ~joined
    ends[:-1] &= ~joined
    return np.flatnonzero(begins), np.flatnonzero(ends) + 1


#: So many terms below 2**39 add up to less than 2**63.
_PLAIN_TERMS = 1 << 24


def span_hash(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of each byte range."""
    if not len(data):
        return np.zeros(len(start), U64)
    found = np.zeros(len(start), U64)
    sums = np.zeros(len(data) + 1, U64)
    for base, prime in _PRIMES:
        terms = (data.astype(U64) + U64(1)) * prime_powers(base, prime, len(data))
        if len(data) > _PLAIN_TERMS:
            terms %= U64(prime)
        np.cumsum(terms, out=sums[1:])
        back = prime_powers(base, prime, len(data) + 1, inverse=True)
        found = (found << U64(32)) | ((sums[end] - sums[start]) % U64(prime) * back[start].astype(U64) % U64(prime))
    return mix(found)


#: Ranges of up to so many bytes are compared together, so many at a time.
_SHORT, _TOGETHER = 64, 1 << 14


def unequal(data: np.ndarray, start: np.ndarray, end: np.ndarray, start2: np.ndarray, end2: np.ndarray) -> np.ndarray:
    """Which byte ranges differ from their second ones."""
    size = end - start
    out = size != end2 - start2
    asked = ~out & (start != start2)
    short = np.flatnonzero(asked & (size <= _SHORT))
    for i in range(0, len(short), _TOGETHER):
        these = short[i : i + _TOGETHER]
        n = size[these]
        first = np.cumsum(n) - n
        step = np.arange(int(n.sum())) - np.repeat(first, n)
        differ = data[np.repeat(start[these], n) + step] != data[np.repeat(start2[these], n) + step]
        out[these] = np.logical_or.reduceat(differ, first)
    for i in np.flatnonzero(asked & (size > _SHORT)).tolist():
        out[i] = not np.array_equal(data[start[i] : end[i]], data[start2[i] : end2[i]])
    return out


def exact_ids(data: np.ndarray, start: np.ndarray, end: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """A number for each (non-empty) byte range: equal numbers mean equal bytes.  ``hashes`` are
    those of the ranges; ranges with one hash are compared."""
    _, first, ids = np.unique(hashes, return_index=True, return_inverse=True)
    of, ids = first[ids], ids.astype(np.int64)
    named: dict[bytes, int] = {}
    for i in np.flatnonzero(unequal(data, start, end, start[of], end[of])).tolist():  # another range has this hash
        ids[i] = named.setdefault(data[start[i] : end[i]].tobytes(), len(first) + len(named))
    return ids


def words_of(data: np.ndarray, offsets: np.ndarray, inside: np.ndarray | None = None) -> Words:
    """Words of the rows: runs of ``inside`` bytes (by default, of bytes that aren't blank)."""
    start, end = ranges(~blank(data) if inside is None else inside, offsets)
    first = np.searchsorted(start, offsets).astype(np.int64)
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
    return Words(start, end, row, span_hash(data, start, end), first)


def gram_hash(words: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of the word hashes ``words[start:end]`` of each range."""
    sums = np.zeros(len(words) + 1, U64)
    if not len(words):
        return np.zeros(len(start), U64)
    np.cumsum(words * powers(_WORD_BASE, len(words)), out=sums[1:])
    back = powers(_WORD_BASE, len(words) + 1, inverse=True)
    return mix((sums[end] - sums[start]) * back[start])


def grams(words: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """First word index and hash of every run of ``k`` words that stays in its row."""
    n = len(words.hash)
    if n < k:
        return np.empty(0, np.int64), np.empty(0, U64)
    at = np.flatnonzero(words.row[: n - k + 1] == words.row[k - 1 :])
    return at, gram_hash(words.hash, at, at + k)


def gram_ids(ids: np.ndarray, at: np.ndarray, k: int) -> np.ndarray:
    """A number for each run of ``k`` of ``ids`` (numbers from 0): equal runs have equal numbers."""
    found = ids[at]
    for j in range(1, k):
        found = np.unique(found * (int(ids.max(initial=0)) + 1) + ids[at + j], return_inverse=True)[1]
    return found
