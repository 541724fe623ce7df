"""Hashes of word shingles, vectorised."""

from __future__ import annotations

from zlib import crc32

import numpy as np

WORDS = 5
_MUL = np.uint64(0x9E3779B97F4A7C15)
_MIX1, _MIX2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)
_S33 = np.uint64(33)


def mixed(x: np.ndarray) -> np.ndarray:
    """Every bit of 64 moved by every other."""
    x = (x ^ (x >> _S33)) * _MIX1
    x = (x ^ (x >> _S33)) * _MIX2
    return x ^ (x >> _S33)


def shingle_hashes(text: str, words: int = WORDS) -> np.ndarray:
    """64-bit hashes of every ``words`` consecutive words, in order; of all words if they are fewer.

    Words are divided by ASCII white space. A text without words has no shingle.
    """
    split = text.encode("utf-8", "replace").split()
    if not split:
        return np.empty(0, np.uint64)
    one = np.fromiter(map(crc32, split), np.uint64, len(split))
    n = min(words, len(one))
    out = one[: len(one) - n + 1].copy()
    for k in range(1, n):
        out *= _MUL
        out += one[k : len(one) - n + 1 + k]
        out ^= out >> _S33
    return mixed(out + np.uint64(n))
