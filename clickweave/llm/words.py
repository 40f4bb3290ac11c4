"""Words, word hashes and window hashes, shared by the text operators.

A word is ``[^\\x20\\x09-\\x0D]+``. ``bytes.split()`` and ``bytes.lower()``
act on exactly those six separators and on A-Z, so both work on the UTF-8
bytes of a text.
"""

from __future__ import annotations

import numpy as np
import xxhash

#: Odd multiplier of the window polynomial, and its inverse modulo 2**64.
_R = 0x9E3779B97F4A7C15
_R_INV = pow(_R, -1, 1 << 64)

#: Words whose hashes one task keeps; the cache is emptied beyond it.
CACHE_WORDS = 500_000


class WordHashes(dict):
    """64-bit hash of a word, computed once per task and word."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def _powers(base: int, n: int) -> np.ndarray:
    steps = np.full(n, base, np.uint64)
    if n:
        steps[0] = 1
    return np.cumprod(steps, dtype=np.uint64)


class Powers:
    """Powers of the multiplier and its inverse, grown to the longest text."""

    def __init__(self) -> None:
        self.up = self.down = np.empty(0, np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, 2 * len(self.up), 4096)
            self.up, self.down = _powers(_R, size), _powers(_R_INV, size)
        return self.up, self.down


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over the whole hash."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def window_hashes(hashes: np.ndarray, k: int, powers: Powers) -> np.ndarray:
    """Hash of each window of ``k`` words; empty if there are fewer words."""
    n = len(hashes)
    if n < k:
        return np.empty(0, np.uint64)
    up, down = powers.upto(n + 1)
    prefix = np.zeros(n + 1, np.uint64)
    np.cumsum(hashes * up[:n], out=prefix[1:], dtype=np.uint64)
    return mix((prefix[k:] - prefix[:-k]) * down[: n - k + 1])


def shingles(words: list[bytes], hashes: np.ndarray, k: int, powers: Powers) -> np.ndarray:
    """Sorted distinct ``k``-word shingles; all words as one if there are fewer than ``k``."""
    if not words:
        return np.empty(0, np.uint64)
    return np.unique(window_hashes(hashes, min(k, len(words)), powers))


def as_list_array(parts: list[np.ndarray], kind):
    """Arrow list column of the given numpy arrays."""
    import pyarrow as pa

    offsets = np.zeros(len(parts) + 1, np.int32)
    np.cumsum([len(x) for x in parts], out=offsets[1:])
    flat = np.concatenate(parts) if parts else np.empty(0)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat, kind))
