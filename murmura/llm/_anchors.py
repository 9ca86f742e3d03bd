"""Anchors: content-defined groups of the fixed-length windows of a text."""
from __future__ import annotations

import numpy as np

from murmura.llm._text import PrefixHash, mix

#: Bits of a position among the bytes at hand; callers hand over less than 2**_POS bytes.
_POS = 28
_MASK = np.uint64((1 << _POS) - 1)


def sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    """The minimum of each w neighbours, by doubling."""
    span = 1
    while 2 * span <= w:
        x = np.minimum(x[:-span], x[span:])
        span *= 2
    return np.minimum(x[: len(x) - (w - span)], x[w - span :]) if w > span else x


def anchors(data: np.ndarray, off: np.ndarray, window: int, k: int) -> tuple[np.ndarray, ...]:
    """Each window of `window` bytes belongs to the smallest hash of the k-grams in it, the leftmost of equals.

    Neighbouring windows with the same k-gram are one group. Returns for each group: text index, first and last
    window start (from the start of the text), hash of the k-gram, hash of all bytes under the group's windows.
    """
    if len(data) >> _POS:
        raise ValueError("too many bytes at once")
    empty = np.zeros(0, np.int64)
    if len(data) < window:
        return empty, empty, empty, empty, empty
    prefix = PrefixHash(data)
    at = np.arange(len(data) - k + 1)
    h = mix(prefix.of(at, at + k))
    least = sliding_min((h & ~_MASK) | at.astype(np.uint64), window - k + 1)
    least = (least & _MASK).astype(np.int64)
    lens = np.diff(off)
    ok = np.zeros(len(data) + 1, np.int32)
    some = lens >= window
    np.add.at(ok, off[:-1][some], 1)
    np.add.at(ok, off[1:][some] - window + 1, -1)
    p = np.flatnonzero(np.cumsum(ok)[: len(least)])
    if not len(p):
        return empty, empty, empty, empty, empty
    a = least[p]
    cut = np.flatnonzero((a[1:] != a[:-1]) | (p[1:] != p[:-1] + 1)) + 1
    lo, hi = p[np.concatenate(([0], cut))], p[np.concatenate((cut - 1, [len(p) - 1]))]
    pos = least[lo]
    whole = mix(prefix.of(lo, hi + window) ^ mix((((hi - lo) << 16) + (pos - lo)).astype(np.uint64)))
    doc = np.searchsorted(off, lo, side="right") - 1
    return doc, lo - off[doc], hi - off[doc], h[pos].view(np.int64), whole.view(np.int64)



def content_check(data: np.ndarray, at: np.ndarray, size: np.ndarray) -> np.ndarray:
    """A hash of the size bytes at each place that shares neither base nor byte values with the one of anchors()."""
    return mix(PrefixHash(data, "check").of(at, at + size) + size.astype(np.uint64)).view(np.int64) if len(at) else np.zeros(0, np.int64)
