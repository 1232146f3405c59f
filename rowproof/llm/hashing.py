"""Hashes of words and word shingles, in numpy."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash

CACHE_WORDS = 100_000
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


class WordHashes(dict):
    """64-bit hashes of words; what was hashed lately is kept, up to ``CACHE_WORDS`` words."""

    def __missing__(self, word: bytes) -> int:
        value = xxhash.xxh64_intdigest(word)
        if len(self) < CACHE_WORDS:
            self[word] = value
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def mix(x: np.ndarray) -> np.ndarray:
    """A finalizer that spreads every bit of 64-bit values."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_SPACE = np.isin(np.arange(256), [0x20, *range(9, 14)])
#: A random number for each byte, the same for A-Z and a-z, and 0 for white space.
_OF_BYTE = np.where(_SPACE, np.uint64(0), mix(np.arange(1, 257, dtype=np.uint64) * _BASE))
_OF_BYTE[65:91] = _OF_BYTE[97:123]


def _powers(n: int, base: np.uint64) -> np.ndarray:
    powers = np.full(n, base, np.uint64)
    powers[:1] = 1
    return np.cumprod(powers)


def of_texts(texts: pa.BinaryArray) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all words of ``texts``, in A-Z whatever their case, one text after the other; the number of words in each."""
    offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    n = int(offsets[-1] - offsets[0])
    if n == 0:
        return np.zeros(0, np.uint64), np.zeros(len(texts), np.int64)
    data = np.frombuffer(texts.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
    begins = offsets - offsets[0]
    word = ~_SPACE[data]
    new = np.zeros(n + 1, bool)
    new[begins] = True
    new[1:n] |= ~word[:-1]
    starts = np.flatnonzero(word & new[:n])
    if not len(starts):
        return np.zeros(0, np.uint64), np.zeros(len(texts), np.int64)
    # a word is the sum of its bytes' numbers, each times a power of its place in the word
    sizes = np.diff(np.append(starts, n))
    places = np.arange(starts[0], n) - np.repeat(starts, sizes)
    numbers = _OF_BYTE[data[starts[0] :]] * _powers(int(sizes.max()), _BASE)[places]
    sums = np.add.reduceat(numbers, starts - starts[0])
    return mix(sums), np.diff(np.searchsorted(starts, begins))


def runs_of(hashes: np.ndarray, k: int) -> np.ndarray:
    """A hash of each run of ``k`` words, whose own ``hashes`` are mixed, in a time that doesn't depend on ``k``."""
    n = len(hashes)
    if n < k:
        return np.zeros(0, np.uint64)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(hashes * _powers(n, _BASE))])
    return mix((sums[k:] - sums[:-k]) * _powers(n - k + 1, _INVERSE))


def windows(hashes: np.ndarray, k: int) -> np.ndarray:
    """A hash of each run of ``k`` words; of all words, if there are fewer; of none, if there are none."""
    n = len(hashes)
    if n == 0:
        return hashes
    k_used = min(k, n)
    total = np.full(n - k_used + 1, k_used, np.uint64)
    mixed = mix(hashes)
    for i in range(k_used):
        total *= _BASE
        total += mixed[i : n - k_used + 1 + i]
    return mix(total)
