"""DartMinHash signatures of weighted sets.

Every element owns the plane of weight by rank. Darts hit it as a Poisson process that depends on the element alone,
drawn cell by cell (a unit of weight by a unit of rank) from hashes. A set sees the darts below its element weights; each
dart belongs to one coordinate of the signature, and the dart of least rank is kept there. Two sets agree in a
coordinate with the probability of their weighted Jaccard similarity. Ranks are opened only as far as about
K ln K + 2 K darts need, so large sets cost their size and small ones K ln K; sets left with an empty coordinate open
twice as many ranks.
"""

from __future__ import annotations

import math

import numpy as np

K = 128
#: Distribution of the darts in a cell: Poisson with mean 1.
POISSON = np.cumsum([math.exp(-1) / math.factorial(i) for i in range(16)])
_A, _B, _C = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every bit of the result depends on every bit of x."""
    x = x + _A
    x = (x ^ (x >> np.uint64(30))) * _B
    x = (x ^ (x >> np.uint64(27))) * _C
    return x ^ (x >> np.uint64(31))


def _unit(x: np.ndarray) -> np.ndarray:
    return (x >> np.uint64(11)).astype(np.float64) / float(1 << 53)


def _spread(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For items repeated counts times: which item, and the how-manieth of it."""
    owner = np.repeat(np.arange(len(counts)), counts)
    return owner, np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)


def signatures(elements: np.ndarray, weights: np.ndarray, sizes: np.ndarray, k: int = K) -> np.ndarray:
    """Signatures (sets, k) as unsigned 64-bit values. elements (64-bit hashes) and weights (above 0) of all sets lie
    one after the other, sizes tells how many belong to each set. A set without elements has a signature of zeros."""
    out = np.zeros((len(sizes), k), np.uint64)
    firsts = np.cumsum(sizes) - sizes
    total = np.add.reduceat(np.append(weights, 0.0), np.minimum(firsts, len(weights))) if len(sizes) else np.zeros(0)
    total = np.where(sizes > 0, total, 0.0)
    todo, factor = np.flatnonzero(total > 0), 1.0
    while len(todo):
        open_ranks = factor * (k * math.log(k) + 2 * k) / total[todo]
        which, nth = _spread(sizes[todo])
        at = firsts[todo][which] + nth
        done = _throw(out, todo, which, elements[at], weights[at], open_ranks, k)
        todo, factor = todo[~done], factor * 2
    return out


def _throw(out: np.ndarray, todo: np.ndarray, which: np.ndarray, elements: np.ndarray, weights: np.ndarray, open_ranks: np.ndarray, k: int) -> np.ndarray:
    """Fills the signatures of the sets todo whose coordinates all get a dart below their open ranks; tells which."""
    unit, level = _spread(np.ceil(weights).astype(np.int64))
    seed = mix(elements[unit] ^ mix(level.astype(np.uint64)))
    cell, rank = _spread(np.ceil(open_ranks).astype(np.int64)[which[unit]])
    seed = mix(seed[cell] + rank.astype(np.uint64) * _B)
    darts, nth = _spread(np.searchsorted(POISSON, _unit(seed), side="right"))
    dart = mix(seed[darts] ^ (nth.astype(np.uint64) + np.uint64(1)) * _C)
    owner, place = unit[cell[darts]], level[cell[darts]] + _unit(mix(dart ^ _A))
    height = rank[darts] + _unit(mix(dart ^ _B))
    belongs = which[owner]
    seen = (place < weights[owner]) & (height <= open_ranks[belongs])
    belongs, dart, height = belongs[seen], dart[seen], height[seen]
    slot = belongs * k + (mix(dart ^ _C) % np.uint64(k)).astype(np.int64)
    least = np.full(len(todo) * k, np.inf)
    np.minimum.at(least, slot, height)
    first = height == least[slot]
    values = np.zeros(len(todo) * k, np.uint64)
    values[slot[first]] = dart[first]
    done = np.isfinite(least.reshape(-1, k)).all(1)
    out[todo[done]] = values.reshape(-1, k)[done]
    return done


def band_keys(found: np.ndarray, bands: int) -> np.ndarray:
    """One signed 64-bit key for each set and band of equal numbers of coordinates."""
    keys = np.zeros((len(found), bands), np.uint64)
    rows = found.shape[1] // bands
    for r in range(rows):
        keys = mix(keys ^ found[:, r : bands * rows : rows])
    return mix(keys ^ np.arange(bands, dtype=np.uint64)).view(np.int64)
