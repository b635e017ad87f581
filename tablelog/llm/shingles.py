"""Word shingles as sorted 64-bit numbers, one numpy array per text."""

from __future__ import annotations

import numpy as np
import xxhash

_M1, _M2, _M3 = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xD6E8FEB86659FD93))

_ALL = (1 << 64) - 1


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * _M3
    h = (h ^ (h >> np.uint64(29))) * _M1
    return h ^ (h >> np.uint64(32))


class WordHash(dict):
    """word (bytes) -> 64-bit number; emptied when it holds 200,000 words."""

    def __missing__(self, w: bytes) -> int:
        if len(self) >= 200_000:
            self.clear()
        out = self[w] = xxhash.xxh64_intdigest(w)
        return out


def rolling(words: list[bytes], known: WordHash, k: int) -> np.ndarray:
    """The number of every run of k words, in order; of fewer words one number for all of them; none without words."""
    return rolled(np.fromiter(map(known.__getitem__, words), np.uint64, len(words)), k)


def rolled(w: np.ndarray, k: int) -> np.ndarray:
    """As rolling(), from the numbers of the words."""
    n = len(w)
    if not n:
        return np.zeros(0, np.uint64)
    size = min(k, n)
    h = w[: n - size + 1].copy()
    for i in range(1, size):
        h = (h ^ (h >> np.uint64(31))) * _M2 + w[i : n - size + 1 + i]
    return mix(h + np.uint64(size * int(_M1) & _ALL))


def shingle_set(text: str, known: WordHash, k: int = 5) -> np.ndarray:
    """Distinct shingles, sorted. Words are runs of other characters than ASCII blanks, A-Z in lower case."""
    return np.unique(rolling(text.encode().lower().split(), known, k))


def set_number(s: np.ndarray) -> int:
    """One signed 64-bit number for a whole set; equal sets have equal numbers."""
    h = mix(s ^ _M2)
    total = int(h.sum(dtype=np.uint64)) + len(s) * int(_M3) & _ALL
    return int(mix(np.array([total ^ int(np.bitwise_xor.reduce(h, initial=np.uint64(0)))], np.uint64))[0].astype(np.int64))
