"""Vectorised byte, word and hash helpers for Arrow batches of texts."""
from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U64 = np.uint64
#: White space of the word pattern [^\x20\x09-\x0D]+.
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_BASES = {"base": 0x9E3779B97F4A7C15, "check": 0xD1342543DE82EF95}
_BASES |= {f"{k} inverse": pow(b, -1, 1 << 64) for k, b in _BASES.items()}
_powers: dict[str, np.ndarray] = {}


def tidy(run: Callable) -> Callable:
    """A function over batches that, at its end, gives memory it no longer needs back to the system: workers live on between tasks."""

    def inner(*args):
        yield from run(*args)
        pa.default_memory_pool().release_unused()
        try:
            ctypes.CDLL(None).malloc_trim(0)
        except (OSError, AttributeError):  # another C library
            pass

    return inner


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser."""
    x = x ^ (x >> U64(33))
    x = x * U64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> U64(33))
    x = x * U64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> U64(33))


#: A 64-bit value for each byte, so that the polynomial hash has no low-order structure.
BYTE_VALUE = mix(np.arange(1, 257, dtype=np.uint64) * U64(0xD6E8FEB86659FD93)) | U64(1)
_VALUES = {"base": BYTE_VALUE, "check": mix(np.arange(1, 257, dtype=np.uint64) * U64(0xAEF17502108EF2D9)) | U64(1)}


def _power(kind: str, n: int) -> np.ndarray:
    have = _powers.get(kind)
    if have is None or len(have) < n:
        size = max(1 << 20, 1 << (n - 1).bit_length())
        steps = np.full(size, _BASES[kind], np.uint64)
        steps[0] = 1
        have = _powers[kind] = np.cumprod(steps)
    return have[:n]


class PrefixHash:
    """Prefix polynomial hashes modulo 2**64: any substring's hash in constant time. Two kinds are independent."""

    def __init__(self, data: np.ndarray, kind: str = "base") -> None:
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_VALUES[kind][data] * _power(kind, len(data)), out=self.sums[1:])
        self.inverse = _power(f"{kind} inverse", len(data) + 1)

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return (self.sums[end] - self.sums[start]) * self.inverse[start]


def columns(batch: pa.RecordBatch, name: str = "text") -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a text column and its offsets; a null counts as empty."""
    array = pc.fill_null(batch.column(name), "").cast(pa.large_binary())
    off = np.frombuffer(array.buffers()[1], np.int64)[array.offset : array.offset + len(array) + 1]
    data = np.frombuffer(array.buffers()[2] or b"", np.uint8)
    return data[off[0] : off[-1]] if len(off) else data, off - (off[0] if len(off) else 0)


def pieces(off: np.ndarray, most: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Ranges of rows of about `most` bytes; a longer text is a range of its own."""
    rows, i = len(off) - 1, 0
    while i < rows:
        j = max(i + 1, int(np.searchsorted(off, off[i] + most, side="right")) - 1)
        yield i, min(j, rows)
        i = min(j, rows)


def words(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and text index of each word; no word crosses two texts."""
    if not len(data):
        return (np.zeros(0, np.int64),) * 3
    space = SPACE[data]
    first = np.zeros(len(data) + 1, bool)
    first[off] = True
    starts, ends = ~space, ~space
    starts[1:] &= space[:-1] | first[1:-1]
    ends[:-1] &= space[1:] | first[1:-1]
    s, e = np.flatnonzero(starts), np.flatnonzero(ends) + 1
    return s, e, np.searchsorted(off, s, side="right") - 1


def word_hashes(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash of each word with A-Z in lower case, and the offsets of each text's words."""
    low = LOWER[data]
    s, e, doc = words(low, off)
    hashed = mix(PrefixHash(low).of(s, e) + (e - s).astype(np.uint64)) if len(s) else np.zeros(0, np.uint64)
    return hashed, np.searchsorted(doc, np.arange(len(off)))


def shingle_sets(data: np.ndarray, off: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The sorted distinct hashes of each text's k-word shingles, and their offsets.

    With fewer than k words the whole sequence is the one shingle; a text without words has none."""
    h, at = word_hashes(data, off)
    n = np.diff(at)
    out, sizes = [], np.zeros(len(n), np.int64)
    if len(h) >= k:
        full = np.zeros(len(h) - k + 1, np.uint64)
        for j in range(k):
            full = mix(full * U64(0x9FB21C651E98DF25) + h[j : len(h) - k + 1 + j])
    for i in range(len(n)):
        if n[i] >= k:
            own = np.sort(full[at[i] : at[i + 1] - k + 1])
            if len(own) > 1:
                own = own[np.concatenate(([True], own[1:] != own[:-1]))]
        elif n[i]:
            own = np.full(1, n[i], np.uint64)
            for x in h[at[i] : at[i + 1]]:
                own = mix(own * U64(0x9FB21C651E98DF25) + x)
        else:
            own = h[:0]
        out.append(own)
        sizes[i] = len(own)
    return (np.concatenate(out) if out else h[:0]), np.concatenate(([0], np.cumsum(sizes)))
