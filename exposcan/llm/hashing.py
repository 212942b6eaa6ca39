"""Vectorised hashing of word runs, the same on every machine and in every process."""

from __future__ import annotations

import numpy as np
from xxhash import xxh3_64_intdigest

_STEP = np.uint64(0x9E3779B97F4A7C15)
_MIX_1 = np.uint64(0xBF58476D1CE4E5B9)
_MIX_2 = np.uint64(0x94D049BB133111EB)


def mixed(values: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every input bit (the splitmix finaliser)."""
    values = (values ^ (values >> np.uint64(30))) * _MIX_1
    values = (values ^ (values >> np.uint64(27))) * _MIX_2
    return values ^ (values >> np.uint64(31))


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxh3_64_intdigest, words), np.uint64, len(words))


def run_hashes(words: np.ndarray, length: int) -> np.ndarray:
    """Hash of every run of ``length`` consecutive words, in order of its first word."""
    count = len(words) - length + 1
    if count <= 0:
        return np.empty(0, np.uint64)
    total = np.full(count, length, np.uint64)
    for at in range(length):
        total = mixed(total * _STEP + words[at:at + count])
    return total
