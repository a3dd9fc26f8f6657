"""Word and shingle hashes of whole texts, in numpy, for use inside tasks."""

from __future__ import annotations

import numpy as np
import xxhash


class WordHashes(dict):
    """64-bit hashes of words, kept while there are fewer than `most` of them."""

    def __init__(self, most: int = 200_000):
        super().__init__()
        self.most = most

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.most:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


def word_hashes(text: str | None, cache: WordHashes) -> np.ndarray:
    """The hashes of the words of a text, in order. Only A-Z are lower-cased; words are separated by spaces and by the
    control characters 9 to 13, which is what bytes.lower() and bytes.split() do."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    return np.fromiter(map(cache.__getitem__, words), np.uint64, len(words))


def shingle_set(words: np.ndarray, size: int) -> np.ndarray:
    """The sorted distinct hashes of runs of `size` words; of the whole sequence if it is shorter; none without words."""
    if not len(words):
        return words
    size = min(size, len(words))
    last = len(words) - size + 1
    mixed = np.full(last, np.uint64(size * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF))
    for i in range(size):
        mixed ^= words[i : i + last]
        mixed *= np.uint64(0xBF58476D1CE4E5B9)
        mixed ^= mixed >> np.uint64(29)
    return np.unique(mixed)
