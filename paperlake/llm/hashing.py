"""Vectorised 64-bit hashes of words, shingles and bytes."""

from __future__ import annotations

import re
from hashlib import blake2b

import numpy as np

WORD = re.compile(r"\w+")
U = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers whose output bits all depend on all input bits (two multiply-and-shift rounds)."""
    x = (x ^ (x >> U(32))) * U(0xD6E8FEB86659FD93)
    x = (x ^ (x >> U(32))) * U(0xD6E8FEB86659FD93)
    return x ^ (x >> U(32))


class Seen(dict):
    """Hashes of words; one that is asked for and isn't there is made and kept."""

    def __missing__(self, word: str) -> int:
        h = self[word] = int.from_bytes(blake2b(word.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little")
        return h


class WordHashes:
    """64-bit hashes of a text's words (lower case, runs of word characters); hashes of known words are remembered, up
    to a bound."""

    def __init__(self, most: int = 200_000):
        self.most, self.seen = most, Seen()

    def __call__(self, text: str | None) -> np.ndarray:
        if len(self.seen) > self.most:
            self.seen.clear()
        words = WORD.findall((text or "").lower())
        return np.fromiter(map(self.seen.__getitem__, words), U, len(words))


def shingles(words: np.ndarray, n: int = 5) -> np.ndarray:
    """Sorted distinct hashes of runs of n words; a shorter text has one run of all its words, an empty one none."""
    if not len(words):
        return words
    n = min(n, len(words))
    h = np.zeros(len(words) - n + 1, U)
    for j in range(n):
        h = mix(h + words[j : len(h) + j] + U(j + 1))
    return np.unique(h)
