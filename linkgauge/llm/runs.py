"""Periodic runs of words, by Kruskal's order over the classes of a suffix array.

The suffixes of a text are taken in order of decreasing common prefix (LCP) and neighbours in the suffix array are united
with union-find; each class is kept as an ordered set of positions. Two positions i < j that become neighbours in a class when
it is united at level `lcp` share exactly that many words, so the text repeats with period j - i from i to j + lcp. They
are the seed of a run if the distance fits into the level; the run's own first position is among the seeds, so a seed
that its left neighbour extends is passed over and nothing has to be united afterwards. The period of a seed is the
smallest one: a smaller one would have put a position between the two at a higher level.

Only suffixes that share the shortest run's prefix with another one take part (five words for runs of four periods and six
words), which a polynomial hash of word windows finds; most texts end there. All the work on a text is done by the task that
reads it: there is no exchange, and memory grows with the longest text.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Callable
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import map_batches, text_bytes

#: Periods and words that a run has at least.
EXPONENT, SHORTEST = 4, 6
_BASE = np.uint64(0x9E3779B97F4A7C15)

Run = tuple[int, int, int]


def least_level(exponent: int, shortest: int) -> int:
    """The least LCP that any seed of a run can have."""
    return min(max((exponent - 1) * d, shortest - d) for d in range(1, max(shortest, 2)))


def recurring(words: list[bytes], size: int) -> np.ndarray:
    """Positions whose window of `size` words occurs again, by hash: some others may be among them, none is missing."""
    n = len(words) - size + 1
    if n < 2:
        return np.zeros(0, np.int64)
    own = np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)
    window = np.zeros(n, np.uint64)
    for i in range(size):
        window = window * _BASE + own[i : i + n]
    order = np.argsort(window)
    same = window[order[1:]] == window[order[:-1]]
    return order[np.append(same, False) | np.append(False, same)]


def suffixes(words: list[bytes], starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The starts in the order of their suffixes, and the LCP of each with the next."""
    n, ids = len(words), {}
    rank = np.array([ids.setdefault(w, len(ids)) for w in words], np.int64)
    levels, width = [], 1
    while True:  # ranks by the first 1, 2, 4 ... words
        levels.append(np.append(rank, -1))
        if width >= n:
            break
        behind = np.append(rank[width:], np.full(min(width, n), -1)) + 1
        kinds, rank = np.unique(rank * (n + 1) + behind, return_inverse=True)
        width *= 2
        if len(kinds) == n:
            levels.append(np.append(rank, -1))
            break
    order = starts[np.argsort(rank[starts])]
    a, b = order[:-1], order[1:]
    lcp = np.zeros(len(a), np.int64)
    for k in reversed(range(len(levels))):
        lcp += (levels[k][np.minimum(a + lcp, n)] == levels[k][np.minimum(b + lcp, n)]) * (1 << k) * (np.maximum(a, b) + lcp < n)
    return order, lcp


def seeds(order: np.ndarray, lcp: np.ndarray, least: int) -> list[tuple[int, int, int]]:
    """(position, distance, level) of all positions that become neighbours in a class united at `least` or more."""
    owner, sets, found = list(range(len(order))), [[p] for p in order.tolist()], []

    def find(x: int) -> int:
        while owner[x] != x:
            owner[x] = owner[owner[x]]
            x = owner[x]
        return x

    levels = lcp.tolist()
    for edge in np.argsort(-lcp, kind="stable").tolist():
        level = levels[edge]
        if level < least:
            break
        a, b = find(edge), find(edge + 1)
        if len(sets[a]) < len(sets[b]):
            a, b = b, a
        big, small = sets[a], sets[b]
        owner[b], sets[b] = a, None
        for p in small:
            big.insert(bisect_left(big, p), p)
        came = set(small) if len(small) > 1 else small
        for p in small:
            at = bisect_left(big, p)
            if at and big[at - 1] not in came:
                found.append((big[at - 1], p - big[at - 1], level))
            if at + 1 < len(big) and big[at + 1] not in came:
                found.append((p, big[at + 1] - p, level))
    return found


def runs(words: list[bytes], exponent: int = EXPONENT, shortest: int = SHORTEST) -> list[Run]:
    """(start, length, period) of every run, by start and period: a stretch of at least `exponent` times its smallest period
    and of `shortest` words that no neighbouring word extends. exponent is 2 or more."""
    least = least_level(exponent, shortest)
    starts = recurring(words, least)
    if not len(starts):
        return []
    out = []
    for i, d, level in seeds(*suffixes(words, starts), least):
        if d * (exponent - 1) <= level and level + d >= shortest and (i == 0 or words[i - 1] != words[i + d - 1]):
            out.append((i, level + d, d))
    return sorted(out, key=lambda r: (r[0], r[2]))


def collapsed(words: list[bytes], found: list[Run]) -> bytes:
    """The words joined by a space, without those that a run holds after its first period."""
    gone = bytearray(len(words))
    for start, length, period in found:
        gone[start + period : start + length] = b"\1" * (length - period)
    return b" ".join([w for w, x in zip(words, gone, strict=True) if not x] if found else words)


def most_periodic(found: list[Run]) -> Run | None:
    """The run of the greatest length in periods; ties go to the smallest start and then period."""
    return min(found, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)


def periodic(docs: DataFrame, exponent: int = EXPONENT, shortest: int = SHORTEST, prepare: Callable[[object, list[bytes]], list[bytes]] | None = None) -> DataFrame:
    """(doc_id, n_words, runs, start, length, period, collapsed) of every row of docs, repeated rows each for itself.

    Words are parted by ASCII white space; prepare(doc_id, words) may change them before. runs holds (start, length,
    period); start, length and period are those of the most periodic run, null if there is none; collapsed is the text
    without repetitions, its words joined by single spaces. Null and empty texts have no words, no runs and an empty
    collapsed text. A null doc_id stays null. Other columns of docs, whatever their names, are left out."""
    run = pa.struct([(c, pa.int64()) for c in ("start", "length", "period")])

    def each(batches):
        for batch in batches:
            n, all_runs, best, short = [], [], [], []
            for i, text in zip(batch.column(0).to_pylist(), text_bytes(batch), strict=True):
                words = (text or b"").split()
                words = prepare(i, words) if prepare else words
                found = runs(words, exponent, shortest)
                n.append(len(words))
                all_runs.append([dict(zip(("start", "length", "period"), r, strict=True)) for r in found])
                best.append(most_periodic(found) or (None, None, None))
                short.append(collapsed(words, found))
            arrays = [pa.array(n, pa.int64()), pa.array(all_runs, pa.list_(run)), *[pa.array([b[k] for b in best], pa.int64()) for k in range(3)], pa.array(short, pa.binary()).cast(pa.string())]
            yield pa.RecordBatch.from_arrays([batch.column(0), *arrays], ["doc_id", "n_words", "runs", "start", "length", "period", "collapsed"])

    kind = dict(docs.dtypes)["doc_id"]
    return map_batches(docs.select("doc_id", "text"), each, f"doc_id {kind}, n_words long, runs array<struct<start:long,length:long,period:long>>, start long, length long, period long, collapsed string")
