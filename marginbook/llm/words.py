"""Words of a text and their 64-bit hashes, as numpy arrays."""

from __future__ import annotations

import numpy as np
import xxhash

#: The memory of known words is dropped at this many entries; they are then hashed again.
KNOWN_WORDS = 400_000
ODD = np.uint64(0x9E3779B97F4A7C15)


class WordHashes(dict):
    """64-bit hash of each word, kept for the words met lately."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= KNOWN_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of hashes that were combined by sums and products."""
    h = h ^ (h >> np.uint64(31))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xA0761D6478BD642F)
    return h ^ (h >> np.uint64(29))


def windows(hashes: np.ndarray, width: int, base: np.uint64 = ODD) -> np.ndarray:
    """Polynomial (Rabin-Karp) hash modulo 2**64 of every ``width`` consecutive values, by doubling.

    ``H(i, a + b) = H(i, a) * base**b + H(i + a, b)``, so a width costs about two passes per binary digit.
    """
    n = len(hashes) - width + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    span, part, power = 1, hashes, int(base)
    done, out = 0, None
    left = width
    while left:
        if left & 1:
            piece = part[done:]
            out = piece if out is None else out[:len(piece)] * np.uint64(power) + piece
            done += span
        left >>= 1
        if left:
            part = part[:-span] * np.uint64(power) + part[span:]
            span, power = 2 * span, power * power % 2**64
    return out[:n]
