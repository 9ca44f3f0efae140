"""64-bit hashes of word shingles, for whole texts at a time in numpy.

Words are runs of bytes other than blank, tab, newline, vertical tab, form feed and carriage return, with
A-Z in lower case. A word's hash is a polynomial over random values of its bytes, taken from prefix sums; a
shingle's is a weighted sum of its words' hashes, mixed. Fixed seeds make hashes agree everywhere.
"""

from __future__ import annotations

import numpy as np

_random = np.random.default_rng(20_240_229)
_BYTES = _random.integers(1, 1 << 63, 256, dtype=np.uint64)
_PLACES = _random.integers(1, 1 << 63, 64, dtype=np.uint64) | np.uint64(1)
_BASE = int(_random.integers(1, 1 << 62)) * 2 + 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers = np.ones(1, dtype=np.uint64)
_inverses = np.ones(1, dtype=np.uint64)


def _grown(powers: np.ndarray, base: int, n: int) -> np.ndarray:
    """base^0 .. base^(n-1), by doubling."""
    while len(powers) < n:
        step = np.uint64(pow(base, len(powers), 1 << 64))
        powers = np.concatenate([powers, powers * step])
    return powers


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values; one to one."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def word_hashes(text: str) -> np.ndarray:
    global _powers, _inverses
    data = np.frombuffer(text.encode("utf-8", "surrogatepass").lower(), np.uint8)
    blank = (data == 32) | ((data >= 9) & (data <= 13))
    edge = np.flatnonzero(np.diff(np.concatenate([[True], blank, [True]]).astype(np.int8)))
    start, end = edge[::2], edge[1::2]
    if len(data) > len(_powers):
        _powers, _inverses = _grown(_powers, _BASE, len(data)), _grown(_inverses, _INVERSE, len(data))
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_BYTES[data] * _powers[: len(data)], dtype=np.uint64)])
    return mix((sums[end] - sums[start]) * _inverses[start])


def shingles(text: str, size: int) -> np.ndarray:
    """Hashes of all runs of ``size`` words, in place; of the whole sequence if shorter; none without words."""
    words = word_hashes(text)
    if not len(words):
        return words
    width = min(size, len(words))
    count = len(words) - width + 1
    total = np.full(count, width, dtype=np.uint64)
    for k in range(width):
        total += words[k : k + count] * _PLACES[k]
    return mix(total)
