"""Fingerprints of sequences that are composed from those of their parts, in numpy.

A symbol is a pair of numbers below ``P`` and a sequence's fingerprint the value of its polynomial at a secret pair of points: of ``s`` and ``t``
together it is ``value(s) * point ** len(t) + value(t)``. With a length beside it this is a monoid, so prefixes, heads and suffixes are exchanged without
looking at their symbols again.
"""

from __future__ import annotations

import numpy as np

#: A prime; products are taken in halves of 31 bits, so nothing exceeds 63 bits.
P = (1 << 61) - 1
_HALF = np.uint64((1 << 31) - 1)

#: Pairs of points to try, one after the other.
POINTS = [
    (0x0F3A6C51D94B27E1, 0x1B5E09C7A2F48D33),
    (0x12D7B94E60A3C58F, 0x07C1E5F2384D9AB6),
    (0x19A48F03E7D25C6B, 0x0D62B7193CF5E84A),
]


def reduce(x: np.ndarray) -> np.ndarray:
    """A number below 2^63 modulo ``P``."""
    x = (x & np.uint64(P)) + (x >> np.uint64(61))
    return x - np.where(x >= P, np.uint64(P), np.uint64(0))


def times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The product modulo ``P`` of numbers below it."""
    a, b = np.asarray(a, np.uint64), np.asarray(b, np.uint64)
    ah, al, bh, bl = a >> np.uint64(31), a & _HALF, b >> np.uint64(31), b & _HALF
    mid = ah * bl + al * bh  # of 2^31; below 2^62
    high = (ah * bh) * np.uint64(2) + (mid >> np.uint64(30))  # 2^62 is 2
    return reduce(reduce(high + ((mid & np.uint64((1 << 30) - 1)) << np.uint64(31))) + reduce(al * bl))


def plus(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return reduce(np.asarray(a, np.uint64) + np.asarray(b, np.uint64))


def minus(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return reduce(np.asarray(a, np.uint64) + (np.uint64(P) - np.asarray(b, np.uint64)))


def powers(point: int, exponents: np.ndarray) -> np.ndarray:
    """``point`` to each of the exponents."""
    left, out = np.asarray(exponents, np.uint64), np.ones(len(exponents), np.uint64)
    square = point % P
    while left.any():
        out = np.where(left & np.uint64(1), times(out, np.uint64(square)), out)
        square = square * square % P
        left = left >> np.uint64(1)
    return out


def inverse(point: int) -> int:
    return pow(point, P - 2, P)


def symbols(digests: list[bytes], lane: int, seed: int) -> np.ndarray:
    """Symbols from SHA-256 digests: two of their four words, mixed by the seed."""
    words = np.frombuffer(b"".join(digests), ">u8").reshape(-1, 4).astype(np.uint64)
    low = lambda k: reduce(words[:, k] >> np.uint64(3))
    return plus(low(lane), times(np.full(len(words), seed, np.uint64), low(2 + lane)))


def prefixes(symbol: np.ndarray, run_at: np.ndarray, point: int) -> np.ndarray:
    """Values of all prefixes of runs; ``run_at`` is a row's place in its run, from 1. Runs stand one after the other.

    A value is the running sum of ``symbol / point ** place``, times ``point ** place``; the sums are of 31-bit halves.
    """
    scaled = times(symbol, powers(inverse(point), run_at))
    first = np.flatnonzero(run_at == 1)
    run = np.cumsum(run_at == 1) - 1
    out = []
    for part in (scaled >> np.uint64(31), scaled & _HALF):
        total = np.cumsum(part, dtype=np.uint64)
        out.append(reduce(total - (total[first] - part[first])[run]))
    return times(plus(times(out[0], np.uint64(1 << 31)), out[1]), powers(point, run_at))
