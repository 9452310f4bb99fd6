"""Words as runs of other characters than \\x20 and \\x09-\\x0D, and 64-bit hashes of word sequences."""

from __future__ import annotations

import numpy as np
from xxhash import xxh3_64_intdigest

_A, _B, _C = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB), np.uint64(0x9E3779B97F4A7C15)


def words(text: str | None, lower: bool = False) -> list[bytes]:
    """bytes.split() and lower() know ASCII alone, as wanted."""
    if not text:
        return []
    b = text.encode("utf-8", "surrogatepass")
    return (b.lower() if lower else b).split()


def hashes(ws: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxh3_64_intdigest, ws), np.uint64, len(ws))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * _A
    x = (x ^ (x >> np.uint64(27))) * _B
    return x ^ (x >> np.uint64(31))


def joined(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Hashes of two sequences each, one after the other."""
    return mix(a * _C + (b ^ (b >> np.uint64(29))) * _B + np.uint64(1))


def grams(h: np.ndarray, n: int) -> np.ndarray:
    """Hashes of every n words in a row, built by doubling."""
    if len(h) < n:
        return np.zeros(0, np.uint64)
    out, have, piece, size = None, 0, h, 1
    while True:
        if n & size:
            if out is None:
                out, have = piece, size
            else:
                m = len(h) - have - size + 1
                out, have = joined(out[:m], piece[have : have + m]), have + size
        if size * 2 > n:
            return out[: len(h) - n + 1]
        m = len(piece) - size
        piece, size = joined(piece[:m], piece[size : size + m]), size * 2


def shingles(h: np.ndarray, n: int) -> np.ndarray:
    """The sorted set of n-word shingles; fewer words make one, of all of them; no words none."""
    if not len(h):
        return h
    if len(h) < n:
        return grams(h, len(h)) ^ mix(np.array([len(h)], np.uint64))
    return np.unique(grams(h, n))
