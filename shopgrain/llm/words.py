"""Words and shingles of a text as 64-bit numbers, a whole array at a time.

A word is a run of bytes other than 0x20 and 0x09-0x0D; A-Z count as a-z.
The hash of a word is a polynomial over random byte values modulo 2**64, taken
from one running sum over the text, and mixed afterwards.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from shopgrain.llm.arrow import texts_of

_RNG = np.random.default_rng(0x5EED)
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_VALUE = _RNG.integers(1, 1 << 63, 256, dtype=np.uint64)
_VALUE[65:91] = _VALUE[97:123]
SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
SHINGLE = 5
_PLACE = _RNG.integers(1, 1 << 63, SHINGLE, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every bit over all 64."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n:
        size = 1 << (n - 1).bit_length()
        for k, base in enumerate((_BASE, _INVERSE)):
            table = np.full(size, base, np.uint64)
            table[0] = 1
            _powers[k] = np.cumprod(table)
    return _powers[0], _powers[1]


def spans(data: np.ndarray, offsets: np.ndarray, outside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of each run of bytes that are not `outside`.

    `offsets` are the bounds of the texts in `data`; no run crosses them.
    """
    inside = np.zeros(len(data) + 2, bool)  # with a byte outside on either end
    np.logical_not(outside[data], out=inside[1:-1])
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edges[::2], edges[1::2]
    cut = np.unique(offsets)
    cut = cut[inside[cut] & inside[cut + 1]]  # bounds within a run
    if len(cut):
        starts, ends = np.sort(np.append(starts, cut)), np.sort(np.append(ends, cut))
    return starts, ends


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """One number for the bytes of each span, the same wherever it stands."""
    forth, back = _power(len(data) + 1)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(np.take(_VALUE, data, mode="clip") * forth[: len(data)], out=total[1:])
    return mix((total[ends] - total[starts]) * back[starts])


def prefix_hashes(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """For each byte of consecutive runs, a number for what stands before it in its run."""
    forth, back = _power(len(data) + 1)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(np.take(_VALUE, data, mode="clip") * forth[: len(data)], out=total[1:])
    first = np.repeat(starts, sizes)
    return mix((total[:-1] - total[first]) * back[first])


def rolling(data: np.ndarray, reach: int) -> np.ndarray:
    """For each byte, a number for it and up to `reach` - 1 bytes before it."""
    n = len(data)
    forth, back = _power(n + 1)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(np.take(_VALUE, data, mode="clip") * forth[:n], out=total[1:])
    window = total[1:].copy()
    if n > reach:
        window[reach:] -= total[1 : n - reach + 1]
        window[reach:] *= back[1 : n - reach + 1]
    return mix(window)


def word_hashes(text: str | None) -> np.ndarray:
    data = np.frombuffer((text or "").encode(), np.uint8)
    return span_hashes(data, *spans(data, np.array([0, len(data)]), SPACE))


def words_of(column: pa.Array) -> Iterator[np.ndarray]:
    """The word hashes of each text, in order."""
    for data, offsets in texts_of(column):
        starts, ends = spans(data, offsets, SPACE)
        hashes = span_hashes(data, starts, ends)
        cut = np.searchsorted(starts, offsets).tolist()
        for k in range(len(cut) - 1):
            yield hashes[cut[k] : cut[k + 1]]


def shingle_hashes(words: np.ndarray) -> np.ndarray:
    """The distinct runs of five words, sorted.

    Fewer words give their whole sequence as one; none gives nothing.
    """
    n = len(words)
    if n == 0:
        return words
    if n < SHINGLE:
        whole = (words * _PLACE[:n]).sum(dtype=np.uint64) + np.uint64(n)
        return mix(np.array([whole], np.uint64))
    return np.unique(runs_of_words(words))


def runs_of_words(words: np.ndarray, size: int = SHINGLE) -> np.ndarray:
    """One number for each run of `size` words (at most five), in order."""
    n = max(len(words) - size + 1, 0)
    run = words[:n] * _PLACE[0]
    for k in range(1, size):
        run = run + words[k : n + k] * _PLACE[k]
    return mix(run)


def set_id(shingles: np.ndarray) -> tuple[int, int]:
    """Two signed 64-bit numbers that name a set of shingles."""
    first = mix(shingles + np.uint64(1)).sum(dtype=np.uint64)
    second = mix(shingles ^ np.uint64(0xA5A5A5A5A5A5A5A5)).sum(dtype=np.uint64)
    return tuple(int(x) for x in np.array([first, second], np.uint64).view(np.int64))
