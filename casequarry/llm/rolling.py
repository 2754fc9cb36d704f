"""Rolling 64-bit hashes over bytes and words, vectorised.

A sequence v[0], v[1], ... has prefix sums of v[j] * P**j modulo 2**64; the hash
of a stretch is a difference of two sums, moved back by a power of 1/P. Hashes
only propose: whatever uses them compares the texts afterwards.
"""

from __future__ import annotations

import numpy as np

_P = 0x9E3779B97F4A7C15
_P_INVERSE = pow(_P, -1, 1 << 64)
_RANDOM = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_POWERS = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}
_BLOCK = 1 << 17

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
BLANK = np.zeros(256, bool)
BLANK[[32, 9, 10, 11, 12, 13]] = True
NOT_BLANK = ~BLANK


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS["up"]) < n:
        size = max(n, _BLOCK * 4)
        for name, base in (("up", _P), ("down", _P_INVERSE)):
            column = np.full(size, base, np.uint64)
            column[0] = 1
            _POWERS[name] = np.multiply.accumulate(column)
    return _POWERS["up"][:n], _POWERS["down"][:n]


def mix(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(31))
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(32)
    return h


def _sums(values: np.ndarray) -> np.ndarray:
    up, _ = _powers(len(values))
    out = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * up, out=out[1:])
    return out


def windows(values: np.ndarray, n: int) -> np.ndarray:
    """A hash for each stretch of ``n`` consecutive values."""
    count = len(values) - n + 1
    if count <= 0:
        return np.zeros(0, np.uint64)
    out = np.empty(count, np.uint64)
    for at in range(0, count, _BLOCK):
        here = min(_BLOCK, count - at)
        sums = _sums(values[at:at + here + n - 1])
        out[at:at + here] = (sums[n:n + here] - sums[:here]) * _powers(here)[1]
    return mix(out)


def byte_values(data: np.ndarray, fold: np.ndarray | None = None) -> np.ndarray:
    return (_RANDOM if fold is None else _RANDOM[fold])[data]


def words(data: np.ndarray, offsets: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begin, end and row of each maximal run of ``inside`` bytes; runs end with their row."""
    here = inside[data]
    before = np.empty(len(here), bool)
    after = np.empty(len(here), bool)
    if len(here):
        before[0] = after[-1] = False
        before[1:] = here[:-1]
        after[:-1] = here[1:]
        edges = offsets[(offsets > 0) & (offsets < len(here))]
        before[edges] = False
        after[edges - 1] = False
    begins = np.flatnonzero(here & ~before)
    ends = np.flatnonzero(here & ~after) + 1
    rows = np.searchsorted(offsets, begins, "right") - 1
    return begins, ends, rows


def word_hashes(data: np.ndarray, begins: np.ndarray, ends: np.ndarray, fold: np.ndarray | None = None) -> np.ndarray:
    """A hash for each word; works through the bytes in blocks that end between words."""
    out = np.empty(len(begins), np.uint64)
    at = 0
    while at < len(begins):
        base = begins[at]
        end = max(int(np.searchsorted(ends, base + _BLOCK * 4, "right")), at + 1)
        sums = _sums(byte_values(data[base:ends[end - 1]], fold))
        b, e = begins[at:end] - base, ends[at:end] - base
        out[at:end] = (sums[e] - sums[b]) * _powers(int(b[-1]) + 1)[1][b]
        at = end
    return mix(out)
