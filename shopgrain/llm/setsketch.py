"""SetSketch: registers of exponentially spaced, truncated minima.

Each element gets one exponentially distributed value per register; a register
holds 1 - log_b of the smallest, rounded down and cut to 0..LIMIT+1.  Taking
the larger value register by register merges two sketches.  Equal registers
are likelier the more two sets share, so runs of registers serve as bands, and
the share itself is estimated from how many registers are larger, smaller and
equal, given both set sizes.
"""

from __future__ import annotations

import numpy as np

REGISTERS = 64
ROWS = 4
BANDS = REGISTERS // ROWS
BASE = 1.02
RATE = 20.0
LIMIT = 2000
_RNG = np.random.default_rng(0xC0FFEE)
_MULTIPLY = (_RNG.integers(0, 1 << 31, REGISTERS, dtype=np.uint32) << np.uint32(1)) | np.uint32(1)
_ADD = _RNG.integers(0, 1 << 32, REGISTERS, dtype=np.uint32)
_BAND = _RNG.integers(1, 1 << 63, BANDS, dtype=np.uint64)
_BLOCK = 4096


def sketch(elements: np.ndarray) -> np.ndarray:
    """Registers of a set of well mixed 64-bit numbers."""
    least = np.full(REGISTERS, 0xFFFFFFFF, np.uint32)
    low = (elements >> np.uint64(32)).astype(np.uint32)
    for at in range(0, len(low), _BLOCK):
        part = low[at : at + _BLOCK]
        for k in range(REGISTERS):
            m = (part * _MULTIPLY[k] + _ADD[k]).min()
            if m < least[k]:
                least[k] = m
    smallest = -np.log1p(-(least + 0.5) / 2.0**32) / RATE
    return np.clip(np.floor(1 - np.log(smallest) / np.log(BASE)), 0, LIMIT + 1).astype(np.uint16)


def merge(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.maximum(a, b)


def band_keys(registers: np.ndarray) -> np.ndarray:
    """One number per band; equal only where all its registers are."""
    from shopgrain.llm.words import mix

    runs = np.ascontiguousarray(registers).view(np.uint64)
    return mix(mix(runs) ^ _BAND).view(np.int64)


def jaccard(a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> np.ndarray:
    """Likeliest similarity of each pair of sketches (one pair per row)."""
    larger = (a > b).sum(1)[:, None]
    smaller = (a < b).sum(1)[:, None]
    equal = a.shape[1] - larger - smaller
    u = (n_a / (n_a + n_b))[:, None]
    v = 1 - u
    grid = np.minimum(u / v, v / u) * np.linspace(0, 1, 101)[None, :]

    def chance(x: np.ndarray) -> np.ndarray:
        return -np.log1p(-np.clip(x, 0, 1) * (BASE - 1) / BASE) / np.log(BASE)

    up, down = chance(u - v * grid), chance(v - u * grid)
    tiny = 1e-12
    score = (
        larger * np.log(up + tiny)
        + smaller * np.log(down + tiny)
        + equal * np.log(np.clip(1 - up - down, tiny, 1))
    )
    return np.take_along_axis(grid, score.argmax(1)[:, None], 1)[:, 0]
