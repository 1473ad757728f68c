"""Signatures by DartMinHash over weighted word shingles (numpy; no Spark).

The elements of a text are its shingles of five words, weighted by how often
each occurs.  Every unit of an element's weight is a region of its own, on
which darts arrive as a Poisson process that depends on the element and the
unit only: the next waiting time and the coordinate a dart falls on are
hashes.  A text keeps the earliest dart of each coordinate.  Two texts keep
the same dart at a coordinate with the probability of their weighted Jaccard
similarity.  Only darts before a time in proportion to 1 / weight are thrown,
about k (ln k + 3) whatever the text's length; if a coordinate stays empty,
the time is doubled.
"""

from __future__ import annotations

import math
import re

import numpy as np
import xxhash

WORDS = 5
ROWS, BANDS = 8, 32      # a pair of similarity 0.8 shares no band with probability 0.003
_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_MUL = (np.arange(1, WORDS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (splitmix64)."""
    x = x + np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(text: str | None) -> np.ndarray:
    """Hashes of all shingles in sorted order, repeats included; fewer than five words make one shingle."""
    digest = xxhash.xxh64_intdigest
    words = np.array([digest(w) for w in _WORD.findall(text or "")], dtype=np.uint64)
    if len(words) < WORDS:
        return mix(np.array([np.sum(words * _MUL[:len(words)])], dtype=np.uint64)) if len(words) else words
    n = len(words) - WORDS + 1
    total = words[:n] * _MUL[0]
    for j in range(1, WORDS):
        total = total + words[j:n + j] * _MUL[j]
    return np.sort(mix(total))


def regions(sorted_shingles: np.ndarray) -> np.ndarray:
    """One id for each unit of weight: the shingle's hash and which occurrence it is."""
    n = len(sorted_shingles)
    first = np.concatenate(([True], sorted_shingles[1:] != sorted_shingles[:-1]))
    unit = np.arange(n) - np.maximum.accumulate(np.where(first, np.arange(n), 0))
    return mix(sorted_shingles ^ (unit.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)))


def units(text: str | None) -> np.ndarray:
    """The regions of a text in sorted order."""
    found = shingles(text)
    return np.sort(regions(found)) if len(found) else found


def similarity(a: np.ndarray, b: np.ndarray) -> float:
    """Weighted Jaccard similarity of two texts from their sorted regions: the least weight of each element is the
    number of its units that both have."""
    if not len(a) or not len(b):
        return 0.0
    both = np.sort(np.concatenate((a, b)))
    common = int((both[1:] == both[:-1]).sum())
    return common / (len(a) + len(b) - common)


def signature(sorted_shingles: np.ndarray, k: int = ROWS * BANDS) -> np.ndarray:
    """The ids of the earliest darts of ``k`` coordinates."""
    units = regions(sorted_shingles)
    limit = k * (math.log(k) + 3) / len(units)
    while True:
        times, darts = _throw(units, limit)
        at = (darts % np.uint64(k)).astype(np.int64)
        late_first = np.argsort(-times, kind="stable")
        out, filled = np.zeros(k, dtype=np.uint64), np.zeros(k, dtype=bool)
        out[at[late_first]] = darts[late_first]
        filled[at] = True
        if filled.all():
            return out
        limit *= 2


def _throw(units: np.ndarray, limit: float) -> tuple[np.ndarray, np.ndarray]:
    """(times, ids) of all darts on ``units`` before ``limit``."""
    times, darts = [], []
    live, clock, turn = units, np.zeros(len(units)), 0
    # many darts a unit: several arrivals at once; few: one after another, for the units still before the limit
    width = int(limit + 3 * math.sqrt(limit) + 3) if limit > 1 else 1
    while len(live):
        turns = np.arange(turn, turn + width, dtype=np.uint64) * np.uint64(0xA24BAED4963EE407)
        ids = mix(live[:, None] + turns[None, :])
        wait = -np.log(((mix(ids ^ np.uint64(0x5851F42D4C957F2D)) >> np.uint64(11)).astype(np.float64) + 0.5)
                       / float(1 << 53))
        arrive = clock[:, None] + np.cumsum(wait, axis=1)
        early = arrive < limit
        times.append(arrive[early])
        darts.append(ids[early])
        on = early[:, -1]
        live, clock, turn = live[on], arrive[on, -1], turn + width
    return np.concatenate(times), np.concatenate(darts)


def bands(sig: np.ndarray, rows: int = ROWS) -> np.ndarray:
    """One number per band of ``rows`` coordinates; different bands never mean the same."""
    parts = sig.reshape(-1, rows)
    weights = mix(np.arange(rows, dtype=np.uint64)) | np.uint64(1)
    return mix((parts * weights).sum(axis=1, dtype=np.uint64) + np.arange(len(parts), dtype=np.uint64)).view(np.int64)
