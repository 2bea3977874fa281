"""Operator 11: periodic runs of words, by multi-scale minimizers.

A run is a stretch of consecutive words with smallest period q and a length of
at least ``max(min_words, exponent * q)`` that no neighbouring word extends.

Periods from w/2 + 1 to w words (w = 16, 32, 64, ...) belong to the scale w:

1. every position gets the hash of its next w words, made from those of the
   scale below;
2. a position is a minimizer if its hash is the least of some window of w/2
   adjacent positions.  w words hold a whole period, so inside a run equal
   hashes lie whole periods apart; the run holds two periods of positions, so
   the least hash of a period and its repetition are both minimizers;
3. adjacent minimizers of equal hash at a distance of the scale are seeds; the
   seeds of one stretch are one, and it is extended word by word to both sides.

Periods up to ``DIRECT`` are too short for a scale: there words are compared with
those q places on.  Words are compared as themselves (numbered per slice), the
hashes only propose; with four periods in the shortest run, every run is seeded.

All texts of a slice are one array with a word of its own between them, which
no run can cross.  There is no shuffle: a task's memory is that of a slice or of
its longest text.

Defined cases: NULL and empty texts and those without words have no words, no
runs and the collapsed text ''; rows with a NULL id and repeated rows are
rows like others; an empty table gives no rows.  Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame

from .common import byte_slices
from .shingles import _STEP, mix

#: The longest period found by comparing directly; the first scale is twice that.
DIRECT = 8
#: The least exponent the seeds are proven for.
EXPONENT = 4
#: Bytes of text taken at a time.
SLICE = 2 << 20


def _windowed(x: np.ndarray, width: int, op) -> np.ndarray:
    """``op`` over every window of ``width`` (a power of two) adjacent values."""
    step = 1
    while step < width:
        x = op(x[:-step], x[step:])
        step *= 2
    return x


def minimizers(hashes: np.ndarray, width: int) -> np.ndarray:
    """Positions whose hash is the least of some window of ``width`` positions."""
    if len(hashes) < width:
        return np.zeros(0, np.int64)
    least = _windowed(hashes, width, np.minimum)
    # the greatest of the window minima around a position is its own hash, if it is one
    pad = np.zeros(width - 1, np.uint64)
    best = _windowed(np.concatenate((pad, least, pad)), width, np.maximum)
    return np.flatnonzero(best == hashes)


def _same(x: np.ndarray, a: int, b: int, step: int) -> int:
    """How far x agrees from a on with x from b on (b > a), going forwards or backwards."""
    done, size = 0, 64
    while True:
        if step > 0:
            room = min(size, len(x) - b - done)
            equal = x[a + done : a + done + room] == x[b + done : b + done + room]
        else:
            room = min(size, a - done + 1)
            equal = (x[a - done - room + 1 : a - done + 1] == x[b - done - room + 1 : b - done + 1])[::-1]
        if room <= 0:
            return done
        if not equal.all():
            return done + int(equal.argmin())
        done, size = done + room, min(2 * size, 1 << 16)


def _primitive(block: np.ndarray) -> bool:
    """Is the block no repetition of a shorter one?"""
    n = rest = len(block)
    p = 2
    while p * p <= rest or rest > 1:
        if p * p > rest:
            p = rest
        if rest % p == 0:
            while rest % p == 0:
                rest //= p
            d = n // p
            if np.array_equal(block[d:], block[:-d]):
                return False
        p += 1
    return True


def _direct(x: np.ndarray, q: int, need: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the stretches of at least ``need`` words with period q."""
    equal = np.concatenate(([False], x[:-q] == x[q:], [False]))
    edge = np.flatnonzero(equal[1:] != equal[:-1])
    starts, ends = edge[::2], edge[1::2] + q
    keep = ends - starts >= need
    return starts[keep], ends[keep]


def _seeds(hashes: np.ndarray, w: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and distances (w/2 < d <= w) of adjacent equal minimizers, one per stretch."""
    at = minimizers(hashes, w // 2)
    at = at[np.lexsort((at, hashes[at]))]
    gap = at[1:] - at[:-1]
    good = (hashes[at[1:]] == hashes[at[:-1]]) & (gap > w // 2) & (gap <= w)
    place, gap = at[:-1][good], gap[good]
    order = np.lexsort((place, gap))
    place, gap = place[order], gap[order]
    # a seed repeats w + d words: one that starts within w words of another's is of the same stretch
    new = np.ones(len(place), bool)
    new[1:] = (gap[1:] != gap[:-1]) | (place[1:] - place[:-1] > w)
    return place[new], gap[new]


def find_runs(x: np.ndarray, longest: int, min_words: int, exponent: int) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs of the numbered words ``x``, by start, then period.

    ``longest``: no run is longer than that.
    """
    out = []
    for q in range(1, min(DIRECT, longest // exponent) + 1):
        for a, b in zip(*(v.tolist() for v in _direct(x, q, max(min_words, exponent * q)))):
            if _primitive(x[a : a + q]):
                out.append((a, b - a, q))
    w = 2 * DIRECT
    hashes = None
    while longest >= exponent * (w // 2 + 1):
        if hashes is None:
            hashes, have = mix(x.astype(np.uint64) + np.uint64(1)), 1
        while have < w:
            hashes = mix(hashes[:-have] * _STEP + hashes[have:])
            have *= 2
        done: dict[int, int] = {}
        for p, q in zip(*(v.tolist() for v in _seeds(hashes, w))):
            if p + q < done.get(q, 0):
                continue  # inside the run found last
            back, on = _same(x, p - 1, p + q - 1, -1), _same(x, p, p + q, 1)
            a, length = p - back, back + on + q
            done[q] = a + length
            if on >= q and length >= max(min_words, exponent * q) and _primitive(x[a : a + q]):
                out.append((a, length, q))
        w *= 2
    return sorted(out, key=lambda r: (r[0], r[2]))


def _numbered(texts: list[list[bytes]]) -> np.ndarray:
    """The words of all texts as numbers, equal words alike, a number of its own after each text."""
    number: dict = {}
    codes = []
    for k, words in enumerate(texts):
        codes += [number.setdefault(w, len(number)) for w in words]
        codes.append(-1 - k)
    return np.array(codes, np.int64)


def text_runs(texts: list[list[bytes]], min_words: int, exponent: int) -> list[list[tuple[int, int, int]]]:
    """The runs of every text, given as lists of words."""
    sizes = [len(words) for words in texts]
    # longer texts need more scales: texts of about the same length go together
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    by_scale: dict[int, list[int]] = {}
    for k, n in enumerate(sizes):
        by_scale.setdefault(max(6, n.bit_length()), []).append(k)
    for group in by_scale.values():
        x = _numbered([texts[k] for k in group])
        starts = np.cumsum([0] + [sizes[k] + 1 for k in group])
        found = find_runs(x, max(sizes[k] for k in group), min_words, exponent)
        owner = np.searchsorted(starts, [r[0] for r in found], "right") - 1
        for r, k in zip(found, owner.tolist()):
            out[group[k]].append((r[0] - int(starts[k]), r[1], r[2]))
    return out


def collapse(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words no run repeats, joined by a space: each run keeps its first period."""
    if not runs:
        return b" ".join(words)
    keep = np.ones(len(words), bool)
    for start, length, period in runs:
        keep[start + period : start + length] = False
    return b" ".join([words[k] for k in np.flatnonzero(keep).tolist()])


def periodic_runs(docs: DataFrame, min_words: int = 6, exponent: int = EXPONENT) -> DataFrame:
    """doc_id, n_words, runs (start, length, period; by start, then period), collapsed.

    ``exponent`` may be raised above 4, not lowered: the seeds need four periods.
    """
    if exponent < EXPONENT:
        raise ValueError(f"runs of fewer than {EXPONENT} periods are not seeded")

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
        for part in byte_slices(batches, limit=SLICE):
            # bytes.split() cuts at the blank and the controls 9 to 13
            texts = [t.encode().split() if t else [] for t in part.column("text").to_pylist()]
            runs = text_runs(texts, min_words, exponent)
            rows = [[{"start": a, "length": n, "period": q} for a, n, q in r] for r in runs]
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("doc_id").cast(pa.int64()),
                    pa.array([len(words) for words in texts], pa.int64()),
                    pa.array(rows, kind),
                    pa.array([collapse(words, r).decode() for words, r in zip(texts, runs)], pa.string()),
                ],
                ["doc_id", "n_words", "runs", "collapsed"],
            )

    schema = "doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"
    return docs.select("doc_id", "text").mapInArrow(run, schema)
