import numpy as np
from pyspark.sql import functions as F

from linkgauge.llm import stableann
from linkgauge.llm.common import table
from linkgauge.llm.stableann import DIMENSIONS, Tree, chi_square, nearest


def exact(ids, x, queries, k=5):
    x = np.array(x, np.float64)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    out = {}
    for q in queries:
        s = x @ x[ids.index(q)]
        out[q] = [ids[i] for i in sorted((i for i in range(len(ids)) if ids[i] != q), key=lambda i: (-s[i], ids[i]))[:k]]
    return out


def test_recall_against_brute_force(spark):
    df = table(spark, "/root/testdata/sf0.1", "embeddings")
    got = nearest(df, lambda i: i % 50 == 0).collect()
    data = {r.vec_id: r.embedding for r in df.collect()}
    true = exact(list(data), list(data.values()), [i for i in data if i % 50 == 0])
    assert {(r.query_id, r["rank"]) for r in got} == {(q, n) for q in true for n in range(1, 6)}
    assert sum(r.vec_id in true[r.query_id] for r in got) >= 0.9 * len(got)
    for r in got[::17]:
        a, b = np.array(data[r.query_id], float), np.array(data[r.vec_id], float)
        assert abs(r.score - a @ b / np.linalg.norm(a) / np.linalg.norm(b)) < 1e-12


def test_odd_rows_and_ties(spark):
    rows = [(0, [1.0, 0.0]), (1, [2.0, 0.0]), (2, [3.0, 0.0]), (3, [0.0, 1.0]), (4, None), (5, [0.0, 0.0]), (6, [None, 1.0]), (7, [float("nan"), 1.0]), (8, [float("inf"), 1.0]), (None, [1.0, 1.0]), (9, []), (50, [1.0, 1.0, 1.0]), (100, [1e300, 1e300]), (3, [0.0, 1.0]), (10, [1e-200, 0.0])]
    df = spark.createDataFrame([(a, b, 7.0) for a, b in rows], "vec_id long, embedding array<double>, score double")
    got = [(r.query_id, r["rank"], r.vec_id) for r in nearest(df, lambda i: i % 50 == 0).orderBy("query_id", "rank").collect()]
    assert got == [(0, 1, 1), (0, 2, 2), (0, 3, 10), (0, 4, 100), (0, 5, 3), (100, 1, 0), (100, 2, 1), (100, 3, 2), (100, 4, 3), (100, 5, 10)]
    assert nearest(df.limit(0), lambda i: i % 50 == 0).count() == 0
    assert nearest(df, lambda i: i < F.lit(-5)).count() == 0


def test_tree_bounds_and_chi_square():
    rng = np.random.default_rng(1)
    p = rng.normal(size=(1000, DIMENSIONS))
    tree, q = Tree(p), rng.normal(size=DIMENSIONS)
    assert sorted(np.concatenate(tree.leaves)) == list(range(1000))
    assert all(d <= ((p[leaf] - q) ** 2).sum(1).min() + 1e-9 for d, leaf in zip(tree.distances(q), tree.leaves, strict=True))
    draws = (rng.normal(size=(200_000, DIMENSIONS)) ** 2).sum(1)
    assert np.allclose(chi_square(np.array([3.0, 8.0, 15.0])), [(draws <= x).mean() for x in (3, 8, 15)], atol=0.005)
    assert len(Tree(np.ones((500, DIMENSIONS))).leaves) > 1


def test_few_vectors_are_compared_over_many_blocks(spark, monkeypatch):
    df = table(spark, "/root/testdata/sf0.1", "embeddings")
    data = {r.vec_id: r.embedding for r in df.collect()}
    true = exact(list(data), list(data.values()), [i for i in data if i % 50 == 0])
    for rows, most in ((stableann.ROWS, 0.43), (1000, 0.5)):
        monkeypatch.setattr(stableann, "ROWS", rows)
        got = nearest(df, lambda i: i % 50 == 0).collect()
        compared = {r.query_id: r.compared for r in got}
        assert sum(compared.values()) < most * len(true) * len(data)
        assert sum(r.vec_id in true[r.query_id] for r in got) >= 0.9 * 5 * len(true)
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(60, 64))
    own = [(i, (centres[i % 60] + rng.normal(size=64) * 0.4).tolist()) for i in range(6000)]
    true = exact(list(range(6000)), [v for _, v in own], range(0, 6000, 50))
    monkeypatch.setattr(stableann, "ROWS", 400)
    got = nearest(spark.createDataFrame(own, "vec_id long, embedding array<double>"), lambda i: i % 50 == 0).collect()
    assert sum({r.query_id: r.compared for r in got}.values()) < 0.15 * len(true) * len(own)
    assert sum(r.vec_id in true[r.query_id] for r in got) >= 0.9 * 5 * len(true)


def test_equal_vectors_come_in_the_order_of_their_ids(spark, monkeypatch):
    rng = np.random.default_rng(5)
    monkeypatch.setattr(stableann, "ROWS", 40)
    v = rng.normal(size=64)
    near = v + rng.normal(size=64) * 0.01
    rows = [(i, (near * 2.0 ** (i % 3)).tolist()) for i in range(1, 31)] + [(0, v.tolist())] + [(i, rng.normal(size=64).tolist()) for i in range(100, 190)]
    for seed in (1, 2):
        df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").orderBy(F.rand(seed))
        got = [r for r in nearest(df, lambda i: (i == 0) | (i == 7)).collect()]
        assert [r.vec_id for r in sorted(got, key=lambda r: r["rank"]) if r.query_id == 0] == [1, 2, 3, 4, 5]
        assert [r.vec_id for r in sorted(got, key=lambda r: r["rank"]) if r.query_id == 7] == [1, 2, 3, 4, 5]
        assert len({r.score for r in got if r.query_id == 0}) == 1
