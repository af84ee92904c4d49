"""Words of a batch of texts as 64-bit hashes, by array operations.

A polynomial hash over running sums gives the hash of every word of a batch
with a few passes over its bytes.  Arithmetic wraps at 64 bits; bytes first
go through a table of odd random numbers and the result is mixed, so equal
hashes of different words are as rare as for a random function.
"""

from __future__ import annotations

import numpy as np

_RNG = np.random.default_rng(20240131)
_VALUE = _RNG.integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_POWERS: dict[str, np.ndarray] = {}

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
SPACE = np.zeros(256, bool)
SPACE[[32, 9, 10, 11, 12, 13]] = True
#: letters and digits of ASCII and all bytes of longer characters
NOT_WORD = np.ones(256, bool)
NOT_WORD[48:58] = NOT_WORD[65:91] = NOT_WORD[97:123] = NOT_WORD[128:] = False


def _powers(base: int, n: int) -> np.ndarray:
    have = _POWERS.get(str(base))
    if have is None or len(have) < n:
        x = np.full(max(n, 1 << 20), base, np.uint64)
        x[0] = 1
        _POWERS[str(base)] = have = np.cumprod(x, dtype=np.uint64)
    return have[:n]


def mix(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(29))


def running(values: np.ndarray) -> np.ndarray:
    """Prefix sums (one longer than the bytes, or numbers) for ``span_hash``."""
    out = np.zeros(len(values) + 1, np.uint64)
    each = _VALUE[values] if values.dtype == np.uint8 else mix(values.astype(np.uint64) + np.uint64(1)) | np.uint64(1)
    np.cumsum(each * _powers(_BASE, len(values)), out=out[1:])
    return out


def span_hash(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of the bytes start..end of each span, wherever it stands."""
    return mix((sums[end] - sums[start]) * _powers(_INVERSE, len(sums))[start])


def spans(raw: np.ndarray, off: np.ndarray, gap: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of the words: runs of bytes that are not in ``gap``, cut
    at the ends of texts."""
    inside = ~gap[raw]
    edge = np.zeros(len(raw) + 1, bool)
    edge[off] = True
    first = inside & (edge[:-1] | np.r_[True, ~inside[:-1]][:len(raw)])
    last = inside & (edge[1:] | np.r_[~inside[1:], True][:len(raw)])
    return np.flatnonzero(first), np.flatnonzero(last) + 1


def word_hashes(raw: np.ndarray, off: np.ndarray, gap: np.ndarray = NOT_WORD,
                fold: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every word in order, n + 1 offsets of the texts in it); with
    ``fold`` A-Z count as a-z."""
    start, end = spans(raw, off, gap)
    h = span_hash(running(LOWER[raw] if fold else raw), start, end)
    return h, np.searchsorted(start, off)
