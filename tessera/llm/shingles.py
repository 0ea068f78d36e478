"""Word shingles of texts as hashed sets, and MinHash samples of them (numpy, one text at a time)."""
from __future__ import annotations

import numpy as np

from tessera.llm.common import ASCII_LOWER

_RNG = np.random.default_rng(20)
_BYTE = _RNG.integers(1, 2 ** 64, 256, np.uint64)        # a random value for each byte
_BASE = np.uint64(0x9E3779B97F4A7C15)                    # odd, so it has an inverse modulo 2**64
_BACK = np.uint64(pow(int(_BASE), -1, 2 ** 64))
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_F1, _F2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_S30, _S27, _S31 = np.uint64(30), np.uint64(27), np.uint64(31)
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]  # of _BASE and _BACK, grown on demand


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64 bits that spreads every input bit."""
    x = (x ^ (x >> _S30)) * _F1
    x = (x ^ (x >> _S27)) * _F2
    return x ^ (x >> _S31)


def _power_tables(n: int) -> list[np.ndarray]:
    if len(_powers[0]) < n:
        size = max(n, 2 * len(_powers[0]), 1 << 16)
        for k, base in enumerate((_BASE, _BACK)):
            factors = np.full(size, base, np.uint64)
            factors[0] = 1
            _powers[k] = np.cumprod(factors, dtype=np.uint64)
    return _powers


def word_hashes(text: bytes) -> np.ndarray:
    """64-bit hash of every word of a UTF-8 text, A-Z lower-cased: polynomial hashes of the words,
    cut out of one running sum over the whole text."""
    b = np.frombuffer(text.translate(ASCII_LOWER), np.uint8)
    inside = np.zeros(len(b) + 2, bool)
    np.logical_not(_SPACE[b], out=inside[1:-1])
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, stops = edges[::2], edges[1::2]
    up, down = _power_tables(len(b) + 1)
    sums = np.zeros(len(b) + 1, np.uint64)
    np.cumsum(_BYTE[b] * up[:len(b)], out=sums[1:])
    return mix((sums[stops] - sums[starts]) * down[starts] + (stops - starts).astype(np.uint64))


def windows(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of every window of k words (the words' order counts)."""
    n = len(h) - k + 1
    out = h[:n].copy()
    for i in range(1, k):
        out *= _BASE
        out += h[i:i + n]
    return mix(out)


def shingles(h: np.ndarray, k: int = 5) -> np.ndarray:
    """Hashes of a text's k-word shingles in order, given its word hashes; with fewer words, of the
    whole sequence; without a word, none."""
    if len(h) >= k:
        return windows(h, k)
    return mix(windows(h, len(h)) + np.uint64(len(h))) if len(h) else h


def shingle_set(text: bytes, k: int = 5) -> np.ndarray:
    """Sorted hashes of a text's distinct shingles."""
    s = np.sort(shingles(word_hashes(text), k))
    return s[np.concatenate(([True], s[1:] != s[:-1]))] if len(s) else s


class MinHash:
    """`size` samples of 32 bits: the least value of each of `size` permutations over a set."""

    def __init__(self, size: int, seed: int = 1):
        rng = np.random.default_rng(seed)
        self.flip = rng.integers(0, 2 ** 32, size, np.uint32)[:, None]
        self.by = (rng.integers(0, 2 ** 31, size, np.uint32) * np.uint32(2) + np.uint32(1))[:, None]

    def samples(self, shingles: np.ndarray) -> np.ndarray:
        low = (shingles >> np.uint64(32)).astype(np.uint32) ^ shingles.astype(np.uint32)
        out = np.full(len(self.by), 0xFFFFFFFF, np.uint32)
        for at in range(0, len(low), 512):
            x = low[None, at:at + 512] ^ self.flip
            x *= self.by
            np.minimum(out, x.min(1), out=out)
        return out
