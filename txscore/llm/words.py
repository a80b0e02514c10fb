"""Words of many texts at once, as 64-bit hashes in numpy arrays."""

from __future__ import annotations

from typing import NamedTuple

import numpy as np

U64 = np.uint64
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_BYTE_VALUES = np.random.default_rng(7).integers(1, 1 << 63, 256, dtype=np.int64).view(U64) | U64(1)

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def _class(*ranges: tuple[int, int]) -> np.ndarray:
    table = np.ones(256, bool)
    for first, last in ranges:
        table[first:last + 1] = False
    return table


#: Which bytes belong to a word: not space and tab to carriage return.
SPACED = _class((0x20, 0x20), (0x09, 0x0D))
#: Which bytes belong to a word: ASCII letters and digits, and all bytes beyond ASCII.
ALNUM = _class((0x00, 0x2F), (0x3A, 0x40), (0x5B, 0x60), (0x7B, 0x7F))


class Words(NamedTuple):
    """Words of n texts: where each starts and ends in the bytes, its hash, and n + 1 positions
    of the texts' first words."""

    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    first: np.ndarray


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of the hash's base and of its inverse, modulo 2^64."""
    size = 1 << max(20, (n - 1).bit_length())
    if size not in _powers:
        if size > 1 << 20:
            _powers.pop(max(_powers), None) if len(_powers) > 1 else None
        with np.errstate(over="ignore"):
            both = []
            for base in (_BASE, _INVERSE):
                steps = np.full(size, base, U64)
                steps[0] = 1
                both.append(np.multiply.accumulate(steps))
        _powers[size] = (both[0], both[1])
    up, down = _powers[size]
    return up[:n], down[:n]


def prefix_hash(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums h with h[j] - h[i] hashing bytes i to j up to a factor, and that factor per i."""
    up, down = powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, U64)
    np.cumsum(_BYTE_VALUES[data] * up[:-1], out=sums[1:])
    return sums, down


def split_words(data: np.ndarray, offsets: np.ndarray, member: np.ndarray) -> Words:
    """Split lower-cased texts, laid end to end in `data`, into runs of `member` bytes."""
    n = len(data)
    if n == 0:
        none = np.zeros(0, np.int64)
        return Words(none, none, np.zeros(0, U64), np.zeros(len(offsets), np.int64))
    inside = member[data]
    begins, ends = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    ends[:-1] &= ~inside[1:]
    firsts = offsets[:-1][offsets[:-1] < n]
    begins[firsts] = inside[firsts]
    lasts = offsets[1:][offsets[1:] > 0] - 1
    ends[lasts] = inside[lasts]
    start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    sums, down = prefix_hash(LOWER[data])
    return Words(start, end, mix((sums[end] - sums[start]) * down[start]),
                 np.searchsorted(start, offsets))


def grams(words: np.ndarray, size: int) -> np.ndarray:
    """Hash of each `size` consecutive word hashes."""
    count = len(words) - size + 1
    if count <= 0:
        return np.zeros(0, U64)
    total = np.zeros(count, U64)
    for k in range(size):
        total *= U64(0x5851F42D4C957F2D)
        total += words[k:k + count]
    return mix(total)
