"""Words and word shingles of many texts as arrays of 64-bit hashes."""

from __future__ import annotations

import numpy as np

SPAN = 1 << 20  # bytes of text that are hashed in one go
_rng = np.random.default_rng(20240607)
# a word byte is a digit, a letter in lower case, or any byte beyond ASCII; A-Z count as a-z
_LETTER = np.zeros(256, np.uint64)
_WORD = np.zeros(256, bool)
for _b in [*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]:
    _LETTER[_b], _WORD[_b] = _rng.integers(1 << 62, dtype=np.uint64) * 2 + 1, True
_LETTER[0x41:0x5B], _WORD[0x41:0x5B] = _LETTER[0x61:0x7B], True
_POWERS = np.cumprod(np.full(1 << 16, int(_rng.integers(1 << 62)) * 2 + 1, np.uint64))
_STEPS = _rng.integers(1 << 62, size=8, dtype=np.uint64) * 2 + 1


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads each bit over all."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The hash of each word, and how many words each text has; `bounds` as of common.utf8."""
    found, places, at = [], [], 0
    inner = bounds[1:-1]
    while at < len(data):
        end = min(len(data), at + SPAN)
        while end < len(data) and _WORD[data[end]] and _WORD[data[end - 1]]:
            gap = np.flatnonzero(~_WORD[data[end:end + SPAN]])
            end = end + int(gap[0]) if len(gap) else min(len(data), end + SPAN)
        part = data[at:end]
        word = _WORD[part]
        first = word.copy()
        first[1:] &= ~word[:-1]
        breaks = inner[(inner >= at) & (inner < end)] - at
        first[breaks] = word[breaks]
        begins = np.flatnonzero(first[word])  # among word bytes only
        if len(begins):
            letters = part[word]
            place = np.arange(len(letters)) - np.repeat(begins, np.diff(np.append(begins, len(letters))))
            found.append(mix(np.add.reduceat(_LETTER[letters] * _POWERS[place & 0xFFFF], begins)))
            places.append(np.flatnonzero(first) + at)
        at = end
    if not found:
        return np.zeros(0, np.uint64), np.zeros(len(bounds) - 1, np.int64)
    return np.concatenate(found), np.diff(np.searchsorted(np.concatenate(places), bounds))


def shingle_hashes(data: np.ndarray, bounds: np.ndarray, size: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of all runs of `size` words, repeats included, and how many each text has.

    A text of fewer words, but not none, has one shingle of all its words.
    """
    words, counts = word_hashes(data, bounds)
    if not len(words):
        return words, counts
    number = np.where(counts == 0, 0, np.maximum(counts - size + 1, 1))
    begin = np.cumsum(counts) - counts
    ends = np.cumsum(number)
    place = np.repeat(begin - (ends - number), number) + np.arange(ends[-1])
    last = np.repeat(begin + counts, number)
    total = np.zeros(len(place), np.uint64)
    for step in range(size):
        inside = place + step < last
        total += np.where(inside, words[np.minimum(place + step, len(words) - 1)] * _STEPS[step], np.uint64(0))
    return mix(total), number
