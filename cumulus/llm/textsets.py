"""Word and shingle fingerprints shared by the near-duplicate operators.

Runs inside Arrow tasks only; state is a bounded per-process word cache.
"""

from __future__ import annotations

import re

import numpy as np
import xxhash

#: Contract word: anything but space, tab, \n, \v, \f, \r.
WORD = re.compile(r"[^\x20\x09-\x0D]+")
ASCII_LOWER = str.maketrans({c: chr(c + 32) for c in range(65, 91)})

_CACHE_WORDS = 1 << 18
_M1 = np.uint64(0x9E3779B97F4A7C15)
_M2 = np.uint64(0xC2B2AE3D27D4EB4F)
_M3 = np.uint64(0x165667B19E3779F9)
_S = np.uint64(29)


class _WordHash(dict):
    """word -> 64-bit hash, emptied whenever it holds ``_CACHE_WORDS`` words."""

    def __missing__(self, word: str) -> int:
        if len(self) >= _CACHE_WORDS:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


_WORDS = _WordHash()


def words(text: str | None) -> list[str]:
    """Words of ``text`` with A-Z lower-cased; none for null."""
    return WORD.findall(text.translate(ASCII_LOWER)) if text else []


def word_hashes(ws: list[str]) -> np.ndarray:
    get = _WORDS.__getitem__
    return np.fromiter((get(w) for w in ws), dtype=np.uint64, count=len(ws))


def utf8_word_hashes(text: bytes) -> np.ndarray:
    """``word_hashes(words(text))`` of a text given as UTF-8: bytes are lower-cased and split in ASCII only."""
    return np.frombuffer(b"".join(map(xxhash.xxh3_64_digest, text.lower().split())), dtype=">u8").astype(np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _S)) * _M2
    return x ^ (x >> np.uint64(32))


def roll(h: np.ndarray, width: int) -> np.ndarray:
    """Hash of each ``width`` consecutive entries of ``h`` (order matters)."""
    n = len(h) - width + 1
    if n <= 0:
        return np.empty(0, dtype=np.uint64)
    acc = np.zeros(n, dtype=np.uint64)
    for k in range(width):
        acc = (acc ^ h[k : k + n]) * _M1 + _M3
        acc ^= acc >> _S
    return mix(acc)


def shingle_set(text: str | None, width: int) -> np.ndarray:
    """Sorted distinct shingle hashes; a shorter text is one whole shingle."""
    ws = words(text)
    if not ws:
        return np.empty(0, dtype=np.uint64)
    h = word_hashes(ws)
    return np.unique(roll(h, min(width, len(ws))) ^ np.uint64(min(width, len(ws))))


def overlap(a: np.ndarray, b: np.ndarray) -> int:
    """Size of the intersection of two sorted distinct arrays."""
    if len(a) > len(b):
        a, b = b, a
    if not len(a):
        return 0
    at = np.searchsorted(b, a)
    at[at == len(b)] = len(b) - 1
    return int(np.count_nonzero(b[at] == a))
