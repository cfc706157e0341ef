"""Word shingles as sets of 64-bit hashes."""

from __future__ import annotations

import numpy as np
import xxhash

LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
BASE = np.uint64(0x9E3779B97F4A7C15)
MIX = np.uint64(0xD6E8FEB86659FD93)
#: Words that a task remembers; of long ones only the hash is taken each time.
MAX_WORDS, MAX_WORD_BYTES = 150_000, 48


class WordHashes(dict):
    """64-bit hashes of words, remembered up to a bound."""

    def __missing__(self, word: bytes) -> int:
        found = xxhash.xxh64_intdigest(word)
        if len(word) <= MAX_WORD_BYTES:
            if len(self) >= MAX_WORDS:
                self.clear()
            self[word] = found
        return found


_hashes = WordHashes()


def forget_words() -> None:
    _hashes.clear()


def shingle_set(text: str | None, width: int = 5) -> np.ndarray:
    """Distinct hashes, ascending, of all runs of ``width`` words; A-Z are lower-cased.

    Words are separated by the six ASCII white space characters, which are what
    ``bytes.split`` separates by. Fewer words than ``width`` are one shingle; none give none.
    """
    words = text.encode().translate(LOWER).split() if text else []
    if len(words) < width:
        return np.array([xxhash.xxh64_intdigest(b" ".join(words), seed=1)][: len(words)], dtype=np.uint64)
    hashes = np.fromiter(map(_hashes.__getitem__, words), dtype=np.uint64, count=len(words))
    rolled = hashes[: len(words) - width + 1].copy()
    for at in range(1, width):
        rolled *= BASE
        rolled += hashes[at : len(words) - width + 1 + at]
    rolled ^= rolled >> np.uint64(31)
    rolled *= MIX
    rolled ^= rolled >> np.uint64(29)
    return np.unique(rolled)


def similar(a: np.ndarray, b: np.ndarray, percent: int = 75) -> bool:
    """Whether 100 times the common part is at least ``percent`` times the union."""
    if not len(a) or not len(b) or 100 * min(len(a), len(b)) < percent * max(len(a), len(b)):
        return False
    common = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * common >= percent * (len(a) + len(b) - common)
