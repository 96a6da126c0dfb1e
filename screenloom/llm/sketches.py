"""ProbMinHash sketches of weighted sets, and the hashes they are made of.

Elements are 64-bit hashes. Each element is a Poisson process whose rate is its weight: its arrivals fall on
the registers of the sketch, and a register keeps the earliest arrival. Two sets agree in a register with the
probability Jaccard likeness of their weights, which for equal weights is the Jaccard likeness of the sets.
"""

from __future__ import annotations

import re

import numpy as np
import xxhash

WORD = re.compile(r"[^\W_]+")
_GOLDEN = np.uint64(0x9E3779B97F4A7C15)
_M1 = np.uint64(0xBF58476D1CE4E5B9)
_M2 = np.uint64(0x94D049BB133111EB)
_CACHE: dict[str, int] = {}
_CACHE_WORDS = 200_000


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of the public splitmix64 generator, on arrays."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def word_hashes(text: str) -> np.ndarray:
    """Hashes of the words of a text: longest runs of letters and digits in lower case."""
    if len(_CACHE) > _CACHE_WORDS:
        _CACHE.clear()
    out = []
    for w in WORD.findall(text.lower()):
        h = _CACHE.get(w)
        if h is None:
            h = _CACHE[w] = xxhash.xxh64_intdigest(w)
        out.append(h)
    return np.array(out, dtype=np.uint64)


def shingles(text: str, size: int) -> np.ndarray:
    """Sorted distinct hashes of runs of ``size`` words; a text with fewer words has none."""
    words = word_hashes(text)
    n = len(words) - size + 1
    if n <= 0:
        return np.empty(0, dtype=np.uint64)
    code = np.zeros(n, dtype=np.uint64)
    for k in range(size):
        code = mix(code + words[k : k + n] + _GOLDEN)
    return np.unique(code)


def prob_min_hash(elements: np.ndarray, registers: int, weights: np.ndarray | None = None) -> np.ndarray:
    """The element that each register keeps; elements distinct, weights positive. An empty set has no sketch."""
    n = len(elements)
    if n == 0:
        return np.empty(0, dtype=np.uint64)
    rate = np.ones(n) if weights is None else np.asarray(weights, dtype=float)
    first = np.full(registers, np.inf)
    kept = np.zeros(registers, dtype=np.uint64)
    active = np.arange(n)
    clock = np.zeros(n)
    step = 0
    # so many arrivals fill all registers nearly always; the loop ends when no later arrival can change one
    burst = int(np.ceil(registers * np.log(20.0 * registers) / n)) + 2
    while len(active):
        own = elements[active]
        index = np.arange(step, step + burst, dtype=np.uint64)
        draw = mix(own[:, None] + (index[None, :] + np.uint64(1)) * _GOLDEN)
        unit = ((draw >> np.uint64(11)).astype(np.float64) + 0.5) / 9007199254740992.0
        times = clock[active][:, None] + np.cumsum(-np.log(unit), axis=1) / rate[active][:, None]
        place = (mix(draw ^ _M2) % np.uint64(registers)).astype(np.int64)
        spot, when = place.ravel(), times.ravel()
        np.minimum.at(first, spot, when)
        won = np.nonzero(when == first[spot])[0]
        kept[spot[won]] = np.repeat(own, burst)[won]
        clock[active] = times[:, -1]
        step += burst
        active = active[clock[active] < first.max()]
        burst = max(2, burst // 4)
    return kept


def bands(sketch: np.ndarray, rows: int) -> np.ndarray:
    """One hash per band of ``rows`` registers; the band's number is part of it."""
    if not len(sketch):
        return np.empty(0, dtype=np.uint64)
    grid = sketch.reshape(-1, rows)
    code = np.arange(len(grid), dtype=np.uint64) * _GOLDEN
    for k in range(rows):
        code = mix(code + grid[:, k])
    return code
