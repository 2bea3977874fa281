"""Word shingle sets of whole texts as sorted 64-bit hashes, in numpy batches."""

from __future__ import annotations

import numpy as np

SHINGLE = 5
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
#: A fixed random value per byte; A-Z share those of a-z, so case folds here.
_VALUE = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
_VALUE[65:91] = _VALUE[97:123]
_STEP = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(raws: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of all texts, and the number of words of each text."""
    data = np.frombuffer(b" ".join([b"", *raws, b""]), np.uint8)
    inside = ~_SPACE[data]
    edge = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edge[::2] + 1, edge[1::2] + 1
    size = ends - starts
    if not len(size):
        return np.zeros(0, np.uint64), np.zeros(len(raws), np.int64)
    letters = _VALUE[data[inside]]
    first = np.cumsum(size) - size
    place = np.arange(len(letters)) - np.repeat(first, size)
    powers = np.cumprod(np.full(int(size.max()), _STEP, np.uint64))
    words = mix(np.add.reduceat(letters * powers[place], first) + size.astype(np.uint64))
    bounds = np.cumsum(np.fromiter((len(r) + 1 for r in raws), np.int64, len(raws))) + 1
    upto = np.searchsorted(starts, bounds)
    return words, np.diff(np.concatenate(([0], upto)))


def shingle_sets(raws: list[bytes], size: int = SHINGLE) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text.

    A text of fewer words has one shingle, its whole sequence; without words, none.
    """
    words, counts = word_hashes(raws)
    out = []
    grams = words[: max(0, len(words) - size + 1)].copy()
    for k in range(1, size):
        grams = mix(grams * _STEP + words[k : k + len(grams)])
    at = 0
    for n in counts.tolist():
        if n >= size:
            out.append(np.unique(grams[at : at + n - size + 1]))
        elif n:
            one = words[at : at + 1].copy()
            for k in range(1, n):
                one = mix(one * _STEP + words[at + k : at + k + 1])
            out.append(mix(one + np.uint64(n)))
        else:
            out.append(grams[:0])
        at += n
    return out
