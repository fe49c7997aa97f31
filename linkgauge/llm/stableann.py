"""Approximate nearest neighbours by cosine: low-dimensional stable projections, searched in order through kd-trees.

Vectors of unit length are projected on DIMENSIONS Gaussian directions (2-stable, so a squared projected distance is the
true one times a chi-square variable; for longer vectors the directions are made orthogonal, which narrows it). Rows are
dealt into blocks; each block is held once, by one task, which indexes its projections in a kd-tree and lets the queries
stream past. Leaves are opened in order of their distance to the query in the projection, and their vectors are compared
in order of their own projected distance, as far as no unopened leaf can come before. The search ends once a chi-square
test says that a vector not yet compared is as near as the worst of the best found with a chance below 1 - SURE.
"""

from __future__ import annotations

import math
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import cut_lineage, map_batches

#: Even number of directions, most points of a leaf, chance that ends a search.
DIMENSIONS, LEAF, SURE = 24, 64, 0.88
#: Vectors of an index block at the mean; leaves opened at first, twice as many each time; vectors compared at first.
ROWS, STEP, CHUNK = 8192, 8, 16


def chi_square(x: np.ndarray, degrees: int = DIMENSIONS) -> np.ndarray:
    """Distribution function for an even number of degrees."""
    half, term, total = x / 2, np.ones_like(x), np.ones_like(x)
    for i in range(1, degrees // 2):
        term = term * half / i
        total = total + term
    return 1 - np.exp(-half) * total


@cache
def quantile(sure: float, degrees: int = DIMENSIONS) -> float:
    """Where chi_square reaches sure."""
    low, high = 0.0, 100.0 * degrees
    while high - low > 1e-9:
        middle = (low + high) / 2
        low, high = (middle, high) if chi_square(np.array([middle]), degrees)[0] < sure else (low, middle)
    return high


def directions(size: int) -> np.ndarray:
    """The same for all blocks."""
    drawn = np.random.default_rng(size).normal(size=(size, DIMENSIONS))
    return np.linalg.qr(drawn)[0] * math.sqrt(size) if size > DIMENSIONS else drawn


class Tree:
    """A kd-tree with leaves of up to LEAF points: bounds of each leaf's box, and its points."""

    def __init__(self, points: np.ndarray) -> None:
        self.leaves: list[np.ndarray] = []
        stack = [np.arange(len(points))]
        while stack:
            own = stack.pop()
            if len(own) <= LEAF:
                self.leaves.append(own)
                continue
            axis = int(np.argmax(np.ptp(points[own], axis=0)))
            order = own[np.argpartition(points[own, axis], len(own) // 2)]
            stack += [order[: len(own) // 2], order[len(own) // 2 :]]
        self.low = np.array([points[x].min(0) for x in self.leaves])
        self.high = np.array([points[x].max(0) for x in self.leaves])

    def distances(self, query: np.ndarray) -> np.ndarray:
        """Squared distance of the query to each leaf's box."""
        outside = np.maximum(0, np.maximum(self.low - query, query - self.high))
        return (outside * outside).sum(1)


def search(tree: Tree, projected: np.ndarray, vectors: np.ndarray, ids: np.ndarray, q_projected: np.ndarray, q: np.ndarray, q_id: int, k: int, sure: float = SURE) -> tuple[list[tuple[float, int]], int]:
    """(cosine, id) of the k nearest found, ties to the smaller id, and the number of vectors compared.

    Products are summed in one order wherever a vector lies, so equal vectors have equal cosines; vectors whose projected
    distances are equal are compared together, so none of several equal ones is missed."""
    near, limit = tree.distances(q_projected), quantile(sure)
    order = np.argsort(near)
    best: list[tuple[float, int]] = []
    waiting, far = np.zeros(0, np.int64), np.zeros(0)
    at, step, compared = 0, STEP, 0
    while True:
        bound = near[order[at]] if at < len(order) else np.inf
        ready = int(np.searchsorted(far, bound, "right"))
        done = 0
        while done < ready:
            if len(best) == k and far[done] >= limit * max(2 - 2 * best[-1][0], 1e-12):
                return best, compared
            end = min(ready, done + max(CHUNK, compared // 8))
            end = max(end, int(np.searchsorted(far[:ready], far[end - 1] * (1 + 1e-9) + 1e-12, "right")))
            rows = waiting[done:end]
            done, compared = end, compared + len(rows)
            found = (vectors[rows] * q).sum(1)
            if len(best) == k:
                rows, found = rows[found >= best[-1][0]], found[found >= best[-1][0]]
            if len(rows):
                best = sorted([*best, *zip(found.tolist(), ids[rows].tolist(), strict=True)], key=lambda x: (-x[0], x[1]))[:k]
        if at == len(order):
            return best, compared
        rows = np.concatenate([tree.leaves[i] for i in order[at : at + step]])
        at, step = at + step, 2 * step
        at = min(at, len(order))
        rows = rows[ids[rows] != q_id]
        waiting = np.concatenate([waiting[done:], rows])
        far = np.concatenate([far[done:], ((projected[rows] - q_projected) ** 2).sum(1)])
        order_of = np.argsort(far, kind="stable")
        waiting, far = waiting[order_of], far[order_of]


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(vec_id, v): vectors as doubles, without null ids and vectors that are null, zero, or hold null or non-finite parts."""
    v = F.col(vector_col).cast("array<double>")
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), v.alias("v")).filter("vec_id is not null and v is not null and size(v) > 0")
    return rows.filter(F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0))


class Block:
    """The index of one block, built once."""

    def __init__(self, size: int, parts: list[tuple[np.ndarray, np.ndarray]]) -> None:
        self.directions = directions(size)
        self.ids = np.concatenate([p[0] for p in parts])
        self.vectors = np.concatenate([p[1] for p in parts])
        self.projected = self.vectors @ self.directions
        self.tree = Tree(self.projected)

    def answer(self, ids: np.ndarray, x: np.ndarray, k: int) -> list[tuple[int, int, float, int]]:
        """(query_id, vec_id, score, compared) rows; compared stands in a query's first row, others have 0."""
        out = []
        for q_id, q, projected in zip(ids.tolist(), x, x @ self.directions, strict=True):
            best, compared = search(self.tree, self.projected, self.vectors, self.ids, projected, q, q_id, k)
            out += [(q_id, vec_id, score, 0 if i else compared) for i, (score, vec_id) in enumerate(best)]
        return out


def _units(column: pa.ListArray) -> np.ndarray:
    x = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def nearest(vectors: DataFrame, is_query, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score, compared): the k nearest found of each query (a row for which is_query(id) holds),
    score being the cosine in double precision, and the number of vectors that the query was compared with; fewer rows
    if there are fewer candidates.

    Vectors of another length than the query's are no candidates; unusable vectors take no part (see usable). Of rows
    with the same id the greatest vector counts. Other columns are left out. The block of a row follows from its id alone,
    so no block grows with a hot value, and blocks multiply rather than grow with the data; a block's rows are moved once,
    and each query goes to every block."""
    rows = cut_lineage(usable(vectors, id_col, vector_col).groupBy("vec_id").agg(F.max("v").alias("v")).withColumn("size", F.size("v")))
    largest = rows.groupBy("size").agg(F.count("*").alias("n")).agg(F.max("n")).first()[0]
    blocks = max(1, math.ceil((largest or 0) / ROWS))
    stored = rows.select("size", F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int").alias("block"), F.lit(False).alias("asks"), "vec_id", "v")
    asked = rows.filter(is_query(F.col("vec_id"))).select("size", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), F.lit(True).alias("asks"), "vec_id", "v")

    def run(batches):
        key, parts, index = None, [], None
        for batch in batches:
            sizes, blocks_, asks, ids = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(4))
            edges = np.flatnonzero((np.diff(sizes) != 0) | (np.diff(blocks_) != 0) | (asks[1:] != asks[:-1])) + 1
            out = []
            for a, b in zip([0, *edges.tolist()], [*edges.tolist(), batch.num_rows], strict=True):
                if a == b:
                    continue
                if (sizes[a], blocks_[a]) != key:
                    key, parts, index = (sizes[a], blocks_[a]), [], None
                x = _units(batch.column(4).slice(a, b - a))
                if not asks[a]:
                    parts.append((ids[a:b], x))
                elif parts or index:
                    if index is None:
                        index, parts = Block(int(sizes[a]), parts), []
                    out += index.answer(ids[a:b], x, k)
            columns = [*zip(*out, strict=True)] or [(), (), (), ()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.float64(), pa.int64()), strict=True)], ["query_id", "vec_id", "score", "compared"])

    # a block's rows come first, then the queries that stream past them
    dealt = stored.union(asked).repartition(blocks, "size", "block").sortWithinPartitions("size", "block", "asks")
    found = map_batches(dealt, run, "query_id long, vec_id long, score double, compared long")
    query = Window.partitionBy("query_id")
    ranked = found.withColumns({"rank": F.row_number().over(query.orderBy(F.desc("score"), "vec_id")), "compared": F.sum("compared").over(query)})
    return ranked.filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score", "compared")
