import random
import re
from collections import Counter

import numpy as np

from linkgauge.llm.common import shelf, table
from linkgauge.llm.darts import band_keys, signatures
from linkgauge.llm.neardup import _Words, classes, components, keep_first, node_classes, shingles, weighted, words_of


def hashes(rng, n):
    return rng.integers(0, 1 << 63, n).astype(np.uint64)


def test_signatures_estimate_weighted_jaccard():
    rng = np.random.default_rng(0)
    x = hashes(rng, 60)
    for a, b in ((np.ones(60), np.r_[np.ones(30), np.zeros(30)]), (rng.uniform(0.1, 4, 60), rng.uniform(0.1, 4, 60)), (rng.uniform(0.01, 0.1, 60), np.full(60, 0.05))):
        i, j = a > 0, b > 0
        s = signatures(np.r_[x[i], x[j]], np.r_[a[i], b[j]], np.array([i.sum(), j.sum()]), 2048)
        assert abs((s[0] == s[1]).mean() - np.minimum(a, b).sum() / np.maximum(a, b).sum()) < 0.05
    s = signatures(hashes(rng, 3), np.ones(3), np.array([0, 3, 0]))
    assert (s[0] == 0).all() and (s[2] == 0).all() and (s[1] > 0).all()
    assert signatures(hashes(rng, 0), np.ones(0), np.zeros(0, int)).shape == (0, 128)
    assert band_keys(s, 32).shape == (3, 32)


def brute(rows, least=0.8):
    sets = []
    for _, t in rows:
        w = re.findall(r"[^\W_]+", (t or "").lower())
        sets.append({tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set())
    owner = list(range(len(rows)))

    def find(x):
        while owner[x] != x:
            x = owner[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and len(sets[a] & sets[b]) >= least * len(sets[a] | sets[b]):
                owner[find(a)] = find(b)
    groups = {}
    for i in range(len(rows)):
        groups.setdefault(find(i), []).append(rows[i][0])
    return [(rows[i][0], min((x for x in groups[find(i)] if x is not None), default=None)) for i in range(len(rows))]


def test_classes_match_brute_force(spark):
    random.seed(4)
    vocabulary = [f"w{i}" for i in range(500)]
    rows = []
    for _ in range(25):
        base = random.choices(vocabulary, k=random.choice([3, 6, 40, 150]))
        for _ in range(random.choice([1, 1, 2, 12])):
            own = base[:]
            for _ in range(random.randint(0, 4)):
                own[random.randrange(len(own))] = random.choice(vocabulary)
            rows.append((len(rows), " ".join(own)))
    chain = random.choices(vocabulary, k=200)
    for i in range(12):  # neighbours are alike, the ends are not
        rows.append((len(rows), " ".join([*(f"n{j}" for j in range(5 * i)), *chain[5 * i :]])))
    rows += [(len(rows) + i, t) for i, t in enumerate([None, "", " -- ", "one", "One!", "x " * 20_000, "x " * 20_001])]
    rows += [rows[0], (None, rows[3][1]), (None, "only here and nowhere else at all")]
    df = spark.createDataFrame([(a, b, 1, "k") for a, b in rows], "doc_id long, text string, class_id int, node string").repartition(5)
    got = sorted(classes(df).collect(), key=repr)
    assert [tuple(r) for r in got] == [tuple(r) for r in sorted((spark.createDataFrame(brute(rows), "doc_id long, class_id long").collect()), key=repr)]
    kept = keep_first(df)
    assert kept.columns == df.columns
    expected = sorted({c for (_, t), (_, c) in zip(rows, brute(rows), strict=True) if re.search(r"\w", t or "")} | {i for i, t in rows if not re.search(r"\w", t or "")}, key=repr)
    assert sorted((r.doc_id for r in kept.collect()), key=repr) == expected


def test_a_null_id_gives_way(spark):
    words = " ".join(f"w{i}" for i in range(100))
    df = spark.createDataFrame([(None, words), (None, words + " x"), (7, words + " y"), (8, words + " z")], "doc_id long, text string")
    assert [r.doc_id for r in keep_first(df).collect()] == [7]
    assert keep_first(df.limit(2)).count() == 1


def test_components_and_empty(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 101), (102, 101), (7, 7)]
    got = {r.node: r.label for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 101: 100, 102: 100}
    none = spark.createDataFrame([], "doc_id long, text string")
    assert classes(none).count() == 0 and keep_first(none).count() == 0


def test_weights_are_counts():
    words = _Words()
    elements, counts = shingles(["a"] * 9 + list("bcdef"), words)
    assert sorted(counts.tolist()) == [1, 1, 1, 1, 1, 5] and len(set(weighted(elements, counts).tolist())) == 10
    a, b = ["x"] * 12 + list("pqrstuvw"), ["x"] * 20 + list("pqrstuvw")
    (ea, ca), (eb, cb) = shingles(a, words), shingles(b, words)
    x, y = dict(zip(ea.tolist(), ca.tolist(), strict=True)), dict(zip(eb.tolist(), cb.tolist(), strict=True))
    true = sum(min(x.get(k, 0), y.get(k, 0)) for k in x | y) / sum(max(x.get(k, 0), y.get(k, 0)) for k in x | y)
    p, q = set(weighted(ea, ca).tolist()), set(weighted(eb, cb).tolist())
    assert len(p & q) / len(p | q) == true
    s = signatures(np.concatenate([ea, eb]), np.concatenate([ca, cb]).astype(float), np.array([len(ea), len(eb)]), 2048)
    assert abs((s[0] == s[1]).mean() - true) < 0.05


def test_all_links_among_documents_are_found(spark):
    rows = [(r.doc_id, r.text) for r in table(spark, "/root/testdata/sf0.01", "documents").select("doc_id", "text").collect()]
    words, holders, sets = _Words(), {}, []
    for i, (_, t) in enumerate(rows):
        sets.append(set(weighted(*shingles(words_of(t), words)).tolist()))
        for e in sets[-1]:
            holders.setdefault(e, []).append(i)
    shared = Counter((a, b) for own in holders.values() for k, a in enumerate(own) for b in own[k + 1 :])
    links = [(a, b) for (a, b), n in shared.items() if n >= 0.8 * (len(sets[a]) + len(sets[b]) - n)]
    got = {r.doc_id: r.class_id for r in classes(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()}
    assert len(links) > 20 and all(got[rows[a][0]] == got[rows[b][0]] for a, b in links)
    assert len(set(got.values())) >= len(rows) - len(links)


def test_crowded_buckets(spark):
    """A passage in most texts, with families of near copies that differ in it and beside it: with every bucket crowded, and with none."""
    rng = random.Random(9)
    words = [f"w{i}" for i in range(4000)]
    passage, rows = rng.choices(words, k=60), []
    for share in (20, 34, 8, 6, 10):
        for _ in range(30):
            rows.append([*rng.choices(words, k=rng.randint(share - 3, share)), *passage])
    for _ in range(6):
        base = [*rng.choices(words, k=40), *passage, *rng.choices(words, k=20)]
        for _ in range(8):
            own = base[:]
            for _ in range(rng.randint(0, 3)):
                own[rng.randrange(len(own))] = rng.choice(words)
            rows.append(own)
    rows = [(i, " ".join(w)) for i, w in enumerate(rows)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    expected = dict(brute(rows))
    assert 60 < len(set(expected.values())) < len(rows) - 20
    for crowd in (1, 64, 10_000):
        with shelf(spark) as put:
            of, nodes = node_classes(df, 0.8, put, crowd)
            assert {r.doc_id: r.class_id for r in of.join(nodes, "node").select("doc_id", "class_id").collect()} == expected


def test_a_common_passage_makes_no_pairs(spark):
    rng = random.Random(2)
    passage = " ".join(f"p{i}" for i in range(60))
    rows = [(i, passage + " " + " ".join(f"u{rng.randrange(10**9)}" for _ in range(34))) for i in range(3000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert classes(df).filter("class_id <> doc_id").count() == 0
