"""64-bit hashes of words in text, vectorised over its bytes."""

from __future__ import annotations

import numpy as np

ODD = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values; the usual finalizer of xor-shifts and multiplications."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


#: Random 64-bit values of the bytes, and powers of an odd number and of its inverse.
BYTES = mix(np.arange(1, 257, dtype=np.uint64) * ODD)
SPACE = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
INVERSE = np.uint64(pow(int(ODD), -1, 2**64))


class Powers:
    """Powers of a number modulo 2**64, as many as the longest text needed."""

    def __init__(self, base: np.uint64):
        self.base, self.made = base, np.ones(1, np.uint64)

    def __getitem__(self, n: int) -> np.ndarray:
        if len(self.made) < n:
            self.made = np.full(2 * n, self.base)
            self.made[0] = 1
            self.made = np.multiply.accumulate(self.made)
        return self.made[:n]


UP, DOWN = Powers(ODD), Powers(INVERSE)


def spans(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of each span of bytes: a polynomial in them, the same wherever they stand.

    It is taken from the running sum over the text, shifted back to the span's start.
    """
    upto = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(BYTES[raw] * UP[len(raw)], out=upto[1:])
    return (upto[ends] - upto[starts]) * DOWN[len(raw) + 1][starts]
