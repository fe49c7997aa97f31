import numpy as np
import pytest
from pyspark.sql import functions as F

from linkgauge.llm import langid
from linkgauge.llm.common import held_out, table
from linkgauge.llm.langid import CHUNK, Reader, fit, identify, keep_identified, train

SMALL = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def net(spark):
    return fit(table(spark, SMALL, "documents"))


def test_held_out_accuracy(spark, net):
    docs = table(spark, SMALL, "documents")
    rows = identify(docs, net).join(docs.select("doc_id", "lang"), "doc_id").filter(held_out(F.col("doc_id"))).collect()
    assert np.mean([r.lang == r.lang_pred for r in rows]) > 0.97
    assert all(0 <= r.score <= 1 for r in rows)


def test_odd_rows(spark, net):
    df = spark.createDataFrame([(1, None, 0.0), (2, "", 0.0), (3, "123 -- !", 0.0), (4, "the and of the ing " * 20_000, 0.0), (None, "the and", 0.0), (4, "x", 0.0)], "doc_id long, text string, score double")
    got = identify(df, net).collect()
    assert len(got) == 6
    assert all((r.lang_pred, r.score) == ("und", 0.0) for r in got if r.doc_id in (1, 2, 3))
    assert next(r for r in got if r.doc_id == 4 and r.score > 0.9).lang_pred == "en"
    assert {r.doc_id for r in keep_identified(df, net).collect()} >= {4} and keep_identified(df, net).columns == df.columns
    assert identify(df.limit(0), net).count() == 0
    assert {r.lang_pred for r in identify(df, fit(table(spark, SMALL, "documents").limit(0))).collect()} == {"und"}


def test_gradients_match_differences():
    rng = np.random.default_rng(1)
    net = langid._fresh(["a", "b"], rng)
    x, y = rng.integers(0, 256, (5, 3)), np.array([0, 1, 1])

    def loss():
        s = np.concatenate([langid._run(net.ahead, x), langid._run(net.back, x[::-1])[::-1]], 2)
        p = langid._softmax((s @ net.out + net.bias).astype(np.float64))
        return -np.log(p[:, np.arange(3), y]).sum()

    kept: list = []
    states = np.concatenate([langid._run(net.ahead, x, kept), langid._run(net.back, x[::-1])[::-1]], 2)
    d = langid._softmax(states @ net.out + net.bias)
    d[:, np.arange(3), y] -= 1
    grads = langid._through_time(net.ahead, kept, (d @ net.out.T)[:, :, : langid.UNITS])
    for w, g in ((net.ahead.recurrent, grads.recurrent), (net.ahead.table, grads.table)):
        for i, j in ((x[0, 0] % len(w), 3), (0, 0), (2, 20), (x[3, 1] % len(w), 10)):
            before, step = w[i, j], 3e-3
            w[i, j] = before + step
            up = loss()
            w[i, j] = before - step
            down = loss()
            w[i, j] = before
            assert abs((up - down) / (2 * step) - g[i, j]) < 0.02 * max(1, abs(g[i, j]))


def test_batches_do_not_matter(net):
    many = ["le la de " * 9, "und der die", "x" * CHUNK, "y" * (CHUNK + 1), "é" * 500]
    whole = Reader(net).read(many)
    assert [Reader(net).read([t])[0][0] for t in many] == [x[0] for x in whole]
    assert np.allclose([Reader(net).read([t])[0][1] for t in many], [x[1] for x in whole], atol=1e-5)
    assert train([], []) is None
