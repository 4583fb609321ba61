"""Words of texts as 64-bit numbers, for operators on shingles and k-mers.

Words are runs of bytes other than ASCII white space.
"""

from dataclasses import dataclass

import numpy as np

from tillroll.llm.batches import offsets_of

_BASE = 0x9E3779B97F4A7C15
#: Words hashed, and values mixed, at a time, which a processor's cache holds.
_BLOCK = 1 << 13


def mix(values: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit over all others."""
    values = values ^ (values >> np.uint64(30))
    values = values * np.uint64(0xBF58476D1CE4E5B9)
    values ^= values >> np.uint64(27)
    values *= np.uint64(0x94D049BB133111EB)
    values ^= values >> np.uint64(31)
    return values


def _powers(count: int) -> np.ndarray:
    powers = np.full(max(count, 1), _BASE, np.uint64)
    powers[0] = 1
    return np.multiply.accumulate(powers)


_POWERS = _powers(1 << 12)


@dataclass
class HashedWords:
    """``hashes`` of all words end to end, ``offsets`` of each text, byte places of words in ``data``."""

    hashes: np.ndarray
    offsets: np.ndarray
    starts: np.ndarray
    stops: np.ndarray
    data: np.ndarray


def _laid_out(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """All bytes, which of them belong to words, where words start, and the first word of each text."""
    data = np.frombuffer(b" ".join([b"", *texts, b""]), np.uint8)
    word = (data - np.uint8(9) > 4) & (data != 32)
    starts = np.flatnonzero(word[1:] & ~word[:-1]) + 1
    return data, word, starts, np.searchsorted(starts, offsets_of([len(text) + 1 for text in texts]))


def word_counts(texts: list[bytes]) -> np.ndarray:
    return np.diff(_laid_out(texts)[3])


def hashed_words(texts: list[bytes]) -> HashedWords:
    data, word, starts, offsets = _laid_out(texts)
    stops = np.flatnonzero(word[:-1] & ~word[1:]) + 1
    sums = np.zeros(len(starts), np.uint64)
    if not len(starts):
        return HashedWords(sums, offsets, starts, stops, data)
    global _POWERS
    longest = int((stops - starts).max())
    if longest > len(_POWERS):
        _POWERS = _powers(2 * longest)
    for first in range(0, len(starts), _BLOCK):
        begin, end = starts[first : first + _BLOCK], stops[first : first + _BLOCK]
        # Bytes of words alone, each with its place in its word.
        sizes = end - begin
        begins = offsets_of(sizes)
        place = np.arange(begins[-1]) - np.repeat(begins[:-1], sizes)
        terms = _POWERS[place]
        terms *= data[begin[0] : end[-1]][word[begin[0] : end[-1]]].astype(np.uint64) + np.uint64(1)
        sums[first : first + _BLOCK] = mix(np.add.reduceat(terms, begins[:-1]))
    return HashedWords(sums, offsets, starts, stops, data)


def windows(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of ``size`` words from each word on, wherever so many follow."""
    count = len(hashes) - size + 1
    if count <= 0:
        return np.zeros(0, np.uint64)
    out = np.full(count, size, np.uint64)
    for begin in range(0, count, _BLOCK):
        end = min(begin + _BLOCK, count)
        for i in range(size):
            out[begin:end] = mix((out[begin:end] ^ hashes[begin + i : end + i]) * np.uint64(_BASE))
    return out
