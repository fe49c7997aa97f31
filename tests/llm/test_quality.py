import numpy as np
from pyspark.sql import functions as F

from linkgauge.llm import quality
from linkgauge.llm.common import held_out, table
from linkgauge.llm.quality import NEIGHBOURS, TERMS, Space, _dense, _Shapes, _units, fit, score, shape, term_counts, vote

SMALL = "/root/testdata/sf0.01"


def test_shapes():
    assert [shape(x) for x in ("Word", "WORD!!", "a-1234", "###", "Éé")] == ["Aa", "A!+", "a-9", "#+", "Aa"]


def test_blocked_votes_match_plain_products():
    rng = np.random.default_rng(0)
    docs = [(np.sort(rng.choice(TERMS, 9, False)), rng.random(9)) for _ in range(1100)]
    space = Space(np.ones(TERMS, np.float32), rng.normal(size=(TERMS, 8)).astype(np.float32), _units(rng.normal(size=(70, 8))).astype(np.float32), rng.integers(0, 2, 70).astype(np.float32))
    got = vote(space, docs)
    for i in range(0, 1100, 37):
        v = _dense([docs[i]])[0] @ space.factors
        sims = space.vectors @ v / np.linalg.norm(v)
        best = np.argsort(-sims)[:NEIGHBOURS]
        w = np.clip(sims[best], 1e-6, 1) ** 8
        assert abs(got[i] - (w * space.labels[best]).sum() / w.sum()) < 1e-3


def test_held_out_accuracy(spark):
    docs, labels = table(spark, SMALL, "documents"), table(spark, SMALL, "labels")
    rows = score(docs, fit(docs, labels)).join(labels, "doc_id").filter(held_out(F.col("doc_id"))).collect()
    assert np.mean([(r.score >= 0.7) == (r.quality == 1) for r in rows]) > 0.95


def test_odd_rows(spark):
    docs, labels = table(spark, SMALL, "documents"), table(spark, SMALL, "labels")
    space = fit(docs, labels)
    df = spark.createDataFrame([(1, None, 5.0), (2, "", 5.0), (3, "a b " * 50_000, 5.0), (None, "x", 5.0), (3, "x", 5.0)], "doc_id long, text string, score double")
    rows = score(df, space).collect()
    assert len(rows) == 5 and all(0 <= r.score <= 1 for r in rows) and rows[0].score == rows[1].score
    assert score(df.limit(0), space).count() == 0
    assert {r.score for r in score(df, fit(docs, labels.limit(0))).collect()} == {0.5}
    assert term_counts("", _Shapes())[0].tolist() == [TERMS - 1]


def test_ties_go_to_the_earlier_vectors():
    rows = [term_counts(t, _Shapes()) for t in ("one two three", "ONE! TWO! THREE!")]
    labels = np.array([1] * NEIGHBOURS + [0] * 40 + [1] * 5, np.float32)
    x = _dense([rows[0]] * len(labels))
    factors = np.random.default_rng(1).normal(size=(TERMS, 8)).astype(np.float32)
    space = Space(np.ones(TERMS, np.float32), factors, _units(x @ factors), labels)
    assert np.allclose(vote(space, [rows[0]] * 700 + [rows[1]]), 1.0)


def test_words_count():
    (a, x), (b, y) = term_counts("good words here", _Shapes()), term_counts("bad terms there", _Shapes())
    assert set(a.tolist()) != set(b.tolist()) and {t for t in a.tolist() if t < quality.WORDS_AT} == {t for t in b.tolist() if t < quality.WORDS_AT}
