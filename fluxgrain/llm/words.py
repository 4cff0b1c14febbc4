"""Words of a text and their 64-bit hashes, shared by the operators on shingles and windows."""

from __future__ import annotations

import numpy as np
import xxhash

#: Odd multiplier of the rolling hash (fixed value).
BASE = np.uint64(0x9E3779B97F4A7C15)


def words(text: str | None) -> list[bytes]:
    """UTF-8 words ``[^\\x20\\x09-\\x0D]+`` of a text; none for null. bytes.split() parts at exactly these six bytes."""
    return [] if text is None else text.encode("utf-8", "replace").split()


def word_hashes(ws: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, ws), dtype=np.uint64, count=len(ws))


def mix(h: np.ndarray) -> np.ndarray:
    """Finaliser (an invertible 64-bit mix), so that every bit of a hash depends on all."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def ngram_hashes(h: np.ndarray, n: int) -> np.ndarray:
    """Hash of every run of n consecutive word hashes; empty if there are fewer than n words."""
    if len(h) < n:
        return np.empty(0, dtype=np.uint64)
    out = h[: len(h) - n + 1].copy()
    for k in range(1, n):
        out *= BASE
        out += h[k : len(h) - n + 1 + k]
    return mix(out)
