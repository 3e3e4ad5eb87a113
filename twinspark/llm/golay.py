"""The perfect binary Golay code of length 23: nearest codewords of bit segments, in numpy."""

from __future__ import annotations

from functools import cache
from itertools import combinations

import numpy as np

GENERATOR = 0xC75  # x^11+x^10+x^6+x^5+x^4+x^2+1, a fixed value of the code
N, K, RADIUS = 23, 12, 3
BLOCK = 256  #: rows that are decoded at once


@cache
def codewords() -> np.ndarray:
    """All 4096 codewords, ascending."""
    words = np.zeros(1 << K, np.int64)
    for i in range(K):
        words ^= np.where(np.arange(1 << K) >> i & 1, GENERATOR << i, 0)
    return np.sort(words)


@cache
def signs() -> np.ndarray:
    """Codewords as rows of +1 and -1, for soft decoding."""
    return (((codewords()[:, None] >> np.arange(N)) & 1) * 2 - 1).astype(np.float32)


@cache
def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Index of the nearest codeword of every 23-bit vector; weight-3 errors, ascending; the five
    further codewords at distance 4 that each such error has, as offsets to the nearest."""
    errors = np.array([0] + [sum(1 << b for b in c) for w in range(1, RADIUS + 1) for c in combinations(range(N), w)], np.int32)
    nearest = np.zeros(1 << N, np.int16)
    for i, c in enumerate(codewords().astype(np.int32)):
        nearest[c ^ errors] = i
    weight = np.bitwise_count(codewords())
    heavy = codewords()[weight == 2 * RADIUS + 1]
    triples = np.sort(errors[np.bitwise_count(errors) == RADIUS])
    offsets = np.array([heavy[(heavy & t) == t] for t in triples])
    return nearest, triples, offsets


def near(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Codeword indices within distance 4 of each vector: the nearest, and up to six (-1: none).

    If x and y differ in at most one bit, the nearest codeword of either is among those of the other.
    """
    nearest, triples, offsets = _tables()
    first = nearest[x].astype(np.int64)
    error = x ^ codewords()[first]
    out = np.full((len(x), 6), -1, np.int64)
    out[:, 0] = first
    far = np.bitwise_count(error) == RADIUS
    at = np.searchsorted(triples, error[far])
    out[far, 1:] = np.searchsorted(codewords(), codewords()[first[far], None] ^ offsets[at])
    return first, out


def soft(margins: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Indices and scores of the ``most`` codewords nearest to each row of 23 signed margins."""
    at, best = np.zeros((len(margins), most), np.int64), np.zeros((len(margins), most), np.float32)
    for i in range(0, len(margins), BLOCK):
        score = margins[i : i + BLOCK].astype(np.float32) @ signs().T
        at[i : i + BLOCK] = np.argpartition(-score, most, axis=1)[:, :most]
        best[i : i + BLOCK] = np.take_along_axis(score, at[i : i + BLOCK], 1)
    return at, best
