import itertools

import numpy as np
from pyspark.sql import functions as F

from linkgauge.llm import toxicity
from linkgauge.llm.common import held_out, table
from linkgauge.llm.toxicity import BUCKETS, Field, Tagger, fit, marginals, score

SMALL = "/root/testdata/sf0.01"


def test_marginals_match_enumeration():
    rng = np.random.default_rng(2)
    odds, change, first = rng.uniform(0.1, 5, 11), rng.uniform(0.1, 3, (2, 2)), rng.uniform(0.1, 3, 2)
    starts = np.zeros(11, bool)
    starts[[0, 4, 5]] = True
    got, at = marginals(odds, starts, change, first), 0
    for size in (4, 1, 6):
        total, toxic = 0.0, np.zeros(size)
        for tags in itertools.product((0, 1), repeat=size):
            p = first[tags[0]] * np.prod([change[a, b] for a, b in itertools.pairwise(tags)]) * np.prod([odds[at + i] for i, y in enumerate(tags) if y])
            total, toxic = total + p, toxic + p * np.array(tags)
        assert np.allclose(got[at : at + size], toxic / total)
        at += size
    long = marginals(rng.uniform(0.001, 2, 30_000), np.arange(30_000) == 0, change, first)
    assert np.isfinite(long).all() and (0 <= long).all() and (long <= 1).all()
    assert len(marginals(np.zeros(0), np.zeros(0, bool), change, first)) == 0


def test_gradients_match_differences():
    rng = np.random.default_rng(0)
    ids, y = rng.integers(0, 50, (3, 5, 6)), rng.integers(0, 2, (3, 5))
    valid = np.arange(5) < np.array([5, 3, 1])[:, None]
    y[~valid] = 0
    field = Field(rng.normal(0, 0.3, BUCKETS), rng.normal(0, 1, (2, 2)), rng.normal(0, 1, 2))

    def loss():
        total = 0.0
        for i in range(3):
            n, e = valid[i].sum(), field.weights[ids[i]].sum(1)
            value = {t: field.first[t[0]] + sum(field.change[a, b] for a, b in itertools.pairwise(t)) + sum(e[k] for k in range(n) if t[k]) for t in itertools.product((0, 1), repeat=int(n))}
            total += np.log(sum(np.exp(v) for v in value.values())) - value[tuple(y[i, :n])]
        return total / 3

    grads = toxicity._gradients(field, ids, y, valid)
    for x, g, k in ((field.weights, grads[0] - 1e-4 * field.weights * (grads[0] != 0), int(ids[0, 0, 0])), (field.change, grads[1], (0, 1)), (field.first, grads[2], 1)):
        before = x[k]
        x[k] = before + 1e-5
        up = loss()
        x[k] = before - 1e-5
        down = loss()
        x[k] = before
        assert abs((up - down) / 2e-5 - g[k]) < 2e-3


def test_held_out_accuracy_and_odd_rows(spark):
    docs, labels = table(spark, SMALL, "documents"), table(spark, SMALL, "labels")
    field = fit(docs, labels)
    rows = score(docs, field).join(labels, "doc_id").filter(held_out(F.col("doc_id"))).collect()
    assert np.mean([(r.score >= 0.3) == (r.toxic == 1) for r in rows]) > 0.93
    text = "The ÏDIOT idiot. " + "of the and " * 30_000
    df = spark.createDataFrame([(1, None, 5.0), (2, "", 5.0), (3, text, 5.0), (None, "12 34", 5.0), (3, text, 5.0)], "doc_id long, text string, score double")
    got = score(df, field).collect()
    assert [r.score for r in got if r.doc_id != 3] == [0.0, 0.0, 0.0]
    assert all(r.score > 0.3 and text[r.spans[-1].end - 5 : r.spans[-1].end] == "idiot" for r in got if r.doc_id == 3)
    assert score(df.limit(0), field).count() == 0
    assert {r.score for r in score(df, fit(docs, labels.limit(0))).collect()} == {0.0}
    assert Tagger(field).tag([]) == ([], [])
