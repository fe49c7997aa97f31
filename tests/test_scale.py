"""Operators for lists, samples and statistics of any size, against plain ways on small rows."""

import random

from pyspark.sql import functions as F

from linkgauge.functions.urls import MODEL_INPUTS, model_features
from linkgauge.operators import enhance, keywords, ml, observations, scoring, sketches
from linkgauge.sources import readers


def test_keywords_of_all_lengths(spark):
    rng = random.Random(1)
    texts = ["".join(rng.choices("abcd/", k=rng.randint(0, 30))) for _ in range(400)] + [None, "", "abc", "100% .*"]
    words = ["".join(rng.choices("abcd/", k=rng.randint(1, 9))) for _ in range(60)] + ["", None, ".*", "zzzzzz", "dddddddddddddddddddddd"]
    for own in (words, words[:3], [], ["", None], ["a"]):
        table = spark.createDataFrame([(w,) for w in own], "entry string")
        rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, t string").repartition(3)
        got = {r.id: r.hit for r in keywords.flag(rows, F.col("t"), table, "hit").collect()}
        assert got == {i: t is not None and any(w and w in t for w in own) for i, t in enumerate(texts)}


def test_a_list_of_many_keywords(spark, tmp_path):
    many = [f"word{i}x" for i in range(200_000)] + ["casino"]
    (tmp_path / "many").write_text("\n".join(many))
    found = readers.read_keywords(spark, f"{tmp_path}/many")
    urls = ["http://a.com/word199999x/1", "http://a.com/word7/x", "http://b.com/casino", "http://b.com/?q=word12x", "http://c.com/"]
    rows = spark.createDataFrame([(u,) for u in urls], "url string").withColumn("timestamp", F.current_timestamp())
    got = {r.url: (r.is_nsfw_content, r.is_spam_content) for r in scoring.featured(rows, nsfw=found, spam=["casino"]).select("url", "is_nsfw_content", "is_spam_content").collect()}
    assert [got[u] for u in urls] == [(True, False), (False, False), (True, True), (True, False), (False, False)]


def test_several_picks_of_a_hot_domain(spark):
    rows = [(f"http://hot/{i % 3000}", "hot") for i in range(6000)] + [(f"http://d{i}/", f"d{i}") for i in range(5)] + [(None, "none"), (None, "hot")]
    df = spark.createDataFrame(rows, "url string, domain string")
    a, b = (sorted(map(tuple, enhance.sample(x, k=3).collect())) for x in (df, df.repartition(7)))
    assert a == b and sum(d == "hot" for d, _ in a) == 3 and len(a) == 8 and len({u for _, u in a}) == 8
    one = {tuple(r) for r in enhance.sample(df).collect()}
    assert one <= set(a) and len(one) == 6 and not any(d == "none" for d, _ in one)


def test_first_captures(spark):
    rows = [("u", f"2024{i % 12 + 1:02d}01000000", "200" if i % 2 else "404") for i in range(500)] + [("v", None, "200"), ("v", "20240101000000", "200"), ("w", None, None)]
    kept = observations.earliest(spark.createDataFrame(rows, "url string, ts string, status string").repartition(5), 50)
    got = sorted(((r.url, r.ts or "z", r.status or "z") for r in kept.collect()))
    assert [x for x in got if x[0] == "u"] == sorted((u, t, s) for u, t, s in rows if u == "u")[:50] and len(got) == 53


def test_sketches_merge_in_any_order(spark):
    rows = spark.createDataFrame([(f"d{i % 3}", f"u{i % 900}", f"a{i % 40}", None if i % 5 else f"b{i}", (i * 37 % 1000) / 100, i % 4 == 0) for i in range(6000)], "domain string, url string, segment1 string, segment2 string, score double, is_spam boolean").withColumn("batch", F.pmod(F.xxhash64("url"), F.lit(4)))
    parts = [sketches.partial(rows.filter(F.col("batch") == n)) for n in range(4)]
    step = sketches.merged(sketches.merged(parts[3].unionByName(parts[1])).unionByName(sketches.merged(parts[0].unionByName(parts[2]))))
    whole = {r.domain: r for r in sketches.read(sketches.partial(rows)).collect()}
    for r in sketches.read(step).collect():
        w = whole[r.domain]
        assert (r.total, r.spam) == (w.total, w.spam) == (2000, 500) and abs(r.mean_score - w.mean_score) < 1e-9 and abs(r.score_stddev - w.score_stddev) < 1e-9
        assert r.distinct_url == w.distinct_url and abs(r.distinct_url - 300) <= 15 and abs(r.distinct_segment1 - 40) <= 2 and abs(r.distinct_segment2 - 400) <= 20
        assert abs(r.p50 - 5) < 0.4 and abs(r.p95 - 9.5) < 0.4
    assert sketches.read(sketches.merged(parts[0].limit(0))).count() == 0


def test_keywords_exchange_no_texts(spark):
    """Texts stay where they are, runs that only share a hash's bits are told apart, and large lists take several maps."""
    words = spark.createDataFrame([(f"w{i}é",) for i in range(3000)], "entry string")
    texts = [f"/x/{'😀' * (i % 3)}w{i}é{i}" for i in range(0, 6000, 7)] + ["", None, "w1", "é"]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, t string").repartition(3)
    expected = {i: t is not None and any(f"w{n}é" in t for n in range(3000)) for i, t in enumerate(texts)}
    plan = keywords.flag(rows, F.col("t"), words, "hit")
    assert {r.id: r.hit for r in plan.collect()} == expected
    assert "hashpartitioning" not in plan._jdf.queryExecution().executedPlan().toString()
    bits = keywords.LEAST_BITS, keywords.MOST_BITS, keywords.BITS_A_KEY
    try:
        for own in ((1 << 15, 1 << 15, 4), (1 << 15, 1 << 15, 64)):  # a crowded map, and several maps
            keywords.LEAST_BITS, keywords.MOST_BITS, keywords.BITS_A_KEY = own
            assert {r.id: r.hit for r in keywords.flag(rows, F.col("t"), words, "hit").collect()} == expected
    finally:
        keywords.LEAST_BITS, keywords.MOST_BITS, keywords.BITS_A_KEY = bits


def test_training_exchanges_few_rows(spark, monkeypatch):
    """Rows whose url comes once stay where they are, the others have one label; trees are fitted to equal rows once, by their weight."""
    urls = [f"http://s{i % 9}.{['com', 'tk', 'gov'][i % 3]}/{['news', 'login'][i % 2]}/{i}" for i in range(500)]
    feed = spark.createDataFrame([(u, i >= 500) for i, u in enumerate([*urls, *urls[:20], *urls[:5], None])], "url string, good boolean").withColumn("timestamp", F.current_timestamp())
    scored = scoring.score_rules(feed).withColumn("data_source", F.when(F.col("good"), "good_data").otherwise("input_data"))
    rows = scored.select("url", "score", "data_source", *[c.alias(name) for name, c in model_features().items()]).localCheckpoint()
    seen, fitted, fit = [], ml._fitted, ml.GBTRegressor.fit
    monkeypatch.setattr(ml.GBTRegressor, "fit", lambda self, table: seen.append(table.agg(F.sum("weight"), F.count("*"), F.count_distinct(*MODEL_INPUTS, "label", "held_back")).first()) or fit(self, table))

    def spy(table, *settings):
        found = table.select("url", "label").collect()
        assert len(found) == 500 and dict(found) == {r.url: r.label for r in ml.targets(rows).collect() if r.url}
        lines = table._jdf.queryExecution().optimizedPlan().toString().splitlines()
        (anti,) = (i for i, x in enumerate(lines) if "LeftAnti" in x)
        assert not any("Aggregate" in x for x in lines[:anti])  # the rows of urls that come once
        return fitted(table, *settings)

    monkeypatch.setattr(ml, "_fitted", spy)
    model = ml.train_scored(rows, trees=10, depth=4)
    weight, n, distinct = seen[0]
    assert weight == 500 and n == distinct < 500
    found = ml.evaluate(ml.predict_features(rows, model), ml.targets(rows)).first()
    assert found.urls > 20 and found.correlation > 0.5
    seen.clear()
    monkeypatch.setattr(ml, "MOST_SEVERAL", 1)
    monkeypatch.setattr(ml, "_fitted", lambda table, *settings: seen.append(dict(table.select("url", "label").collect())))
    ml.train_scored(rows)
    assert seen[0] == {r.url: r.label for r in ml.targets(rows).collect() if r.url}


def test_small_reputations_move_no_urls(spark):
    rows = scoring.split_urls(spark.createDataFrame([("http://a.com/x",), ("http://b.com/",)], "url string"))
    known = spark.createDataFrame([("a.com", 0.5, 0.25)], "domain string, reputation_score double, content_diversity_score double")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
        found = scoring.with_reputation(rows, known)
        assert "SortMergeJoin" not in found._jdf.queryExecution().executedPlan().toString()
        assert {r.domain: (r.domain_reputation_score, r.domain_diversity) for r in found.collect()} == {"a.com": (0.5, 0.25), "b.com": (0.0, 0.0)}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
