"""Word shingles, their hashes and universal-hash minima (numpy, per document)."""

from __future__ import annotations

import numpy as np
import xxhash

from fleetspark.llm.common import WorkerCache

SHINGLE = 5
BANDS, ROWS = 32, 4
MASK = (1 << 64) - 1


class WordHashes(WorkerCache):
    """64-bit hashes of words; long words are not kept."""

    def __missing__(self, word: bytes) -> int:
        h = xxhash.xxh3_64_intdigest(word)
        if len(word) <= 64:
            self.spend(170 + len(word))
            self[word] = h
        return h


KNOWN = WordHashes(32 << 20)  # one per Python worker


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


_rng = np.random.default_rng(20240817)
PLACE = _rng.integers(1 << 62, size=SHINGLE, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
MUL = _rng.integers(1 << 62, size=(BANDS * ROWS, 1), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
ADD = _rng.integers(1 << 62, size=(BANDS * ROWS, 1), dtype=np.uint64)


def shingle_set(text: str | None) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct word shingles: lower-cased A-Z,
    words split at space and \\x09-\\x0D; fewer words than a shingle make one
    shingle of all; no words, none."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(KNOWN.__getitem__, words), np.uint64, len(words))
    n = max(1, len(h) - SHINGLE + 1)
    acc = np.full(n, min(len(h), SHINGLE), np.uint64)
    for j in range(min(SHINGLE, len(h))):
        acc += h[j:j + n] * PLACE[j]
    return np.unique(_mixed(acc))


def signature(hashes: np.ndarray) -> np.ndarray:
    """Minima of BANDS * ROWS multiply-add hashes over a non-empty set (upper
    32 bits of each)."""
    least = np.full(BANDS * ROWS, MASK, np.uint64)
    for i in range(0, len(hashes), 512):
        np.minimum(least, (MUL * hashes[i:i + 512] + ADD).min(axis=1), out=least)
    return (least >> np.uint64(32)).astype(np.uint32)


def band_keys(sig: np.ndarray) -> list[int]:
    """One signed 64-bit key per band, the band's number included."""
    rows = sig.reshape(BANDS, ROWS)
    return [xxhash.xxh3_64_intdigest(rows[i].tobytes(), seed=i) - (1 << 63) for i in range(BANDS)]


def similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """100 * intersection >= percent * union, for sorted distinct hashes."""
    small, large = min(len(a), len(b)), max(len(a), len(b))
    if 100 * small < percent * large:
        return False
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= percent * (len(a) + len(b) - both)
