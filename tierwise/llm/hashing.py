"""Words of many texts at once, as numpy arrays of places and hashes."""

from __future__ import annotations

import numpy as np

GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def mix(h: np.ndarray) -> np.ndarray:
    """Every bit of the input changes every bit of the output."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def _multipliers(places: int) -> np.ndarray:
    return mix(np.arange(1, places + 1, dtype=np.uint64) * GOLDEN) | np.uint64(1)


_WEIGHTS = _multipliers(4096)


def words(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, length and 64-bit sum of the words of `raw`, bytes that ASCII white
    space divides: each byte times a random odd number for its place."""
    global _WEIGHTS
    inside = ~_SPACE[raw]
    edges = np.flatnonzero(np.diff(np.concatenate([[False], inside, [False]]).view(np.int8)))
    starts, lengths = edges[::2], edges[1::2] - edges[::2]
    if not len(starts):
        return starts, lengths, np.zeros(0, np.uint64)
    if lengths.max() > len(_WEIGHTS):
        _WEIGHTS = _multipliers(2 * int(lengths.max()))
    chars = raw[inside].astype(np.uint64) + np.uint64(1)
    first = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    place = np.arange(len(chars)) - np.repeat(first, lengths)
    return starts, lengths, np.add.reduceat(chars * _WEIGHTS[place], first) + lengths.astype(np.uint64)
