import math
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from linkgauge.config import DEFAULT, PipelineConfig
from linkgauge.functions import html, urls
from linkgauge.operators import curated, domains, enhance, links, ml, observations, reports, scoring
from linkgauge.sources import readers, sinks
from linkgauge.streaming import batches


def feed_of(spark, *given):
    return spark.createDataFrame([(u, datetime(2024, 1, 1)) for u in given], "url string, timestamp timestamp")


def test_split(spark):
    cases = {
        "http://a.com": ("a.com", "", ""), "HTTP://A.com/x": (urls.UNKNOWN, "", ""), "h2://q.com": (urls.UNKNOWN, "", ""), "": (urls.UNKNOWN, "", ""), "/rel": (urls.UNKNOWN, "", ""),
        "a.com/x?y=1&z#f": ("a.com", "/x", "y=1&z"), "http://h:8080/p": ("h", ":8080/p", ""), "http://u:p@h.com/": ("u", ":p@h.com/", ""), "mailto:x@y": ("mailto", ":x@y", ""),
        "http://é.com/ü-ß": ("é.com", "/ü-ß", ""), "http://a.com?x#y": ("a.com", "", "x"), "http://a.com/p\nq": ("a.com", "/p\nq", ""), None: (urls.UNKNOWN, "", ""),
    }
    rows = scoring.split_urls(feed_of(spark, *cases)).collect()
    assert {r.url: (r.domain, r.path, r["query"]) for r in rows} == cases


@pytest.mark.parametrize(("url", "flag", "value"), [
    ("http://a.tk/", "suspicious_tld", True), ("http://a.gov/", "trustworthy_tld", True), ("http://10.0.0.1/login", "has_ip_address", True), ("http://10.0.0.1/login", "contains_phishing", True),
    ("http://a.com/LOGIN", "contains_phishing", False), ("http://bit.ly/x", "is_url_shortener", True), ("http://reddit.com/x", "is_url_shortener", False), ("http://p.com/?" + "a&" * 10, "excessive_params", True),
    ("http://p.com/?" + "a&" * 9, "excessive_params", False), ("http://e.com/" + "%20" * 6, "excessive_encoding", True), ("http://e.com/" + "%20" * 5, "excessive_encoding", False),
    ("http://s.com/a-b-c-long-title-12345/", "path_has_article_slug", True), ("http://d.com/2024/5/", "path_has_date", True), ("http://d.com/1999/5/", "path_has_date", False), ("localhost/x", "no_scheme", True),
    ("http://l.com/" + "a" * 1011, "very_long_url", False), ("http://l.com/" + "a" * 1012, "very_long_url", True), ("http://a.com/é!ß", "suspicious_chars_path", False), ("http://a.com/!!!!", "suspicious_chars_path", True),
])
def test_flags(spark, url, flag, value):
    assert scoring.featured(feed_of(spark, url)).first()[flag] is value


def test_score_parts_and_partitioning(spark):
    rows = feed_of(spark, *[f"http://shop{i % 5}.example.com/news/2024/1/item-{i}-{i}" for i in range(300)], "http://1.2.3.4/login?" + "&" * 30)
    got = {r.url: r for r in scoring.score_rules(rows).collect()}
    again = {r.url: r.score for r in scoring.score_rules(rows.repartition(7)).collect()}
    assert all(abs(again[u] - r.score) < 1e-12 for u, r in got.items())
    bad = got["http://1.2.3.4/login?" + "&" * 30]
    assert bad.is_spam and bad.param_anomaly and abs(bad.risk_score - (2.5 + 3 + 0.8 + 0.6)) < 1e-9 and bad.confidence == pytest.approx(0.9)
    assert all(0.1 <= r.confidence <= 1 for r in got.values())
    plan = scoring.score_rules(rows)._jdf.queryExecution().toString()
    assert "Python" not in plan and "MapInPandas" not in plan


def test_lists_and_keywords(spark):
    lists = {"news_domain": spark.createDataFrame([(" A.com ",)], "host string")}
    r = scoring.featured(feed_of(spark, "http://a.com/x"), DEFAULT, lists, nsfw=["x.*", "zz"]).first()
    assert r.is_news_domain and not r.is_nsfw_domain and not r.is_nsfw_content


def test_upsert_and_history(spark):
    kinds = "domain string, reputation_score double, total_urls_seen long, malicious_urls_count long, benign_urls_count long, content_diversity_score double"
    old = spark.createDataFrame([("a", 1.0, 10, 1, 9, 0.5), ("b", None, 1, 0, 1, 0.0)], kinds)
    new = spark.createDataFrame([("a", 0.0, 5, 5, 0, None), ("b", 0.4, 1, 0, 1, 0.2), ("c", -1.0, 2, 2, 0, 0.0)], kinds)
    got = {r.domain: r for r in domains.upsert(old, new).collect()}
    assert got["a"].reputation_score == pytest.approx(0.9) and got["a"].total_urls_seen == 15 and got["a"].content_diversity_score == 0.5
    assert got["b"].reputation_score == 0.4 and got["c"].reputation_score == -1.0
    values = [0.3, -1.0, 0.8, 0.1]
    fold = values[0]
    for v in values[1:]:
        fold = 0.9 * fold + 0.1 * v
    history = spark.createDataFrame([("d", i, v) for i, v in enumerate(values)], "domain string, batch int, value double")
    assert domains.history_ema(history).first().reputation_score == pytest.approx(fold)
    assert [r[0] for r in spark.createDataFrame([(0.0,), (1.0,), (2.0,), (9.0,)], "v double").select(domains.revisit_hours(F.col("v"))).collect()] == [720, 360, 1, 1]


def test_link_resolution(spark):
    page = "https://a.com/d/e/p.html?x#y"
    cases = {"//b.com/x": "https://b.com/x", "/r": "https://a.com/r", "q": "https://a.com/d/e/q", "../up": "https://a.com/d/up", "./s/../t": "https://a.com/d/e/t", "#f": "https://a.com/d/e/p.html?x#f", "?z": "https://a.com/d/e/p.html?z", "http://c.com": "http://c.com", "": page}
    df = spark.createDataFrame([(k,) for k in cases], "l string").select("l", links.resolve(F.lit(page), F.col("l")).alias("u"))
    assert {r.l: r.u for r in df.collect()} == cases


def test_link_classes(spark):
    cases = [("q.com", "fine words", "", "quality"), ("s.com", "fine", "", "suspicious"), ("z.com", "fine", "", "spam"), ("t.co", "fine", "", "spam"), ("reddit.com", "fine words", "", "neutral"), ("n.com", "FREE MONEY", "", "spam"), ("n.com", "fine", "act fast", "spam"), ("www.cnn.com", "fine", "", "news"), ("src.com", "fine", "", "internal"), ("x.edu", "fine", "", "quality"), ("x.tk", "fine", "", "suspicious"), ("n.com", "no", "", "low_quality"), ("n.com", "click", "", "low_quality"), ("n!.com", "fine", "", "suspicious"), ("e.com", "fine", "", "neutral")]
    df = spark.createDataFrame([("http://src.com/", f"http://{h}/", t, ti, i) for i, (h, t, ti, _) in enumerate(cases)], "page_url string, link_url string, text string, title string, i int")
    rep = spark.createDataFrame([("q.com", 0.3), ("s.com", -0.11), ("z.com", -0.51), ("e.com", -0.1)], "domain string, reputation_score double")
    assert [r.kind for r in links.classify(df, rep).orderBy("i").collect()] == [c[3] for c in cases]
    assert links.classify(df.filter("i = 4"), rep, substring_hosts=True).first().kind == "spam"


def test_archive_and_requests(spark):
    cdx = spark.createDataFrame([("u", '[["a","b","c"],["20240101000000","200","x"],["bad","404","x"],["20240102000000","301"]]'), ("v", "not json"), ("w", None)], "url string, body string")
    snaps = observations.captures(cdx)
    assert snaps.count() == 2
    m = observations.archive_trust(observations.archive_metrics(snaps, F.lit("2024-01-11").cast("timestamp"))).first()
    assert (m.archive_count, m.successful, m.failed, m.days_since_first, m.days_since_last, m.per_day) == (2, 1, 1, 10, 10, 0.1)
    odd = spark.createDataFrame([("u", 200, 1.0, 2, "Weird"), ("v", 200, 1.0, 2, "timeout"), ("w", 200, 1.0, 2, None)], "url string, status_code int, response_time double, redirect_count int, error_type string")
    assert [(r.status_code, r.response_time, r.error_class) for r in observations.outcome(odd).orderBy("url").collect()] == [(0, 0.0, "unknown"), (0, 10.0, "timeout"), (200, 1.0, None)]


def test_sample_is_one_a_domain_and_stable(spark):
    rows = spark.createDataFrame([(f"http://d{i % 7}/{i}", f"d{i % 7}") for i in range(300)], "url string, domain string")
    a = {tuple(r) for r in enhance.sample(rows).collect()}
    assert len(a) == 7 and a == {tuple(r) for r in enhance.sample(rows.repartition(9)).collect()} and enhance.sample(rows, limit=3).count() == 3


def test_union_prefers_curated(spark):
    feed = feed_of(spark, "http://a/", "http://b/").withColumn("data_source", F.lit("input_data"))
    good = curated.clean_curated(spark.createDataFrame([("http://a/", "2020-01-01"), ("http://a/", "2019-01-01"), (" ", "2020-01-01"), (None, None)], "url string, timestamp string"))
    got = {r.url: (r.data_source, r.timestamp.year) for r in curated.union_feeds(feed, good).collect()}
    assert got == {"http://a/": ("good_data", 2019), "http://b/": ("input_data", 2024)}


def test_sinks(spark, tmp_path):
    rows = scoring.score_rules(feed_of(spark, "http://a.com/", "http://b.com/")).withColumn("data_source", F.lit("input_data"))
    store = sinks.store_rows(rows, "2024-01-01")
    for _ in range(2):
        sinks.insert_absent(store.filter("url like '%a.com%'"), f"{tmp_path}/store", 0)
    sinks.insert_absent(store, f"{tmp_path}/store", 1)
    assert sorted((r.url, r.batch) for r in spark.read.parquet(f"{tmp_path}/store").collect()) == [("http://a.com/", 0), ("http://b.com/", 1)]
    sinks.write_tsv(store.select("url", "score"), f"{tmp_path}/tsv")
    assert spark.read.option("sep", "\t").option("header", True).csv(f"{tmp_path}/tsv").count() == 2
    sinks.write_report(store.select("url"), f"{tmp_path}/report")
    assert spark.read.text(f"{tmp_path}/report").first()[0].startswith("url: ")


def test_stream_restarts_where_it_stopped(spark, tmp_path):
    folder, out, check = (str(tmp_path / x) for x in ("in", "out", "check"))
    (tmp_path / "in").mkdir()
    for i in range(2):
        (tmp_path / "in" / f"{i}.tsv").write_text(f"{1700000000 + i}\thttp://a.com/{i}\n17\thttp://b{i}.com/\n")
    batches.start(spark, folder, out, check).awaitTermination()
    (tmp_path / "in" / "2.tsv").write_text("x\thttp://a.com/9\n17\thttp://a.com/0\n")
    batches.start(spark, folder, out, check).awaitTermination()
    last = {r.domain: r.total_urls_seen for r in sinks.latest_reputation(spark, f"{out}/reputation", 3).collect()}
    assert last == {"a.com": 4, "b0.com": 1, "b1.com": 1}
    assert spark.read.parquet(f"{out}/store").count() == 5 and spark.read.parquet(f"{out}/scored").count() == 6


def test_model_round_trip(spark, tmp_path):
    rows = feed_of(spark, *[f"http://s{i % 9}.{['com', 'tk', 'gov'][i % 3]}/{['news', 'login'][i % 2]}/{i}" for i in range(400)])
    scored = scoring.score_rules(rows).withColumn("data_source", F.lit("input_data"))
    model = ml.train(scoring.featured(rows), ml.targets(scored), trees=10, depth=4)
    ml.save(model, f"{tmp_path}/m")
    got = ml.predict(scoring.featured(rows), ml.load(f"{tmp_path}/m")).withColumnRenamed("score", "p").join(scored.select("url", "score"), "url")
    r = got.agg(F.corr("p", "score").alias("c"), F.min("p").alias("low"), F.max("p").alias("high")).first()
    assert r.c > 0.9 and r.low >= -5 and r.high <= 2
    assert list(urls.model_features()) == urls.MODEL_INPUTS and len(urls.MODEL_INPUTS) == 42


def test_batch_runs_every_part_that_its_settings_ask_for(spark, tmp_path):
    given = [f"http://s{i % 9}.{['com', 'tk', 'gov'][i % 3]}/{['news', 'login'][i % 2]}/{i}" for i in range(400)]
    rows = feed_of(spark, *given)
    model = ml.train(scoring.featured(rows), ml.targets(scoring.score_rules(rows).withColumn("data_source", F.lit("input_data"))), trees=2, depth=2)
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "0.tsv").write_text("".join(f"1700000000\t{u}\n" for u in given))
    landed = batches.Landed(
        curated=spark.createDataFrame([("http://good.org/a", "2020-01-01"), (given[0], "2020-01-01")], "url string, timestamp string"),
        pages=spark.createDataFrame([(u, 200, "<title>A title that is long enough</title><a href='http://x.com'>x</a>") for u in given], "url string, status_code int, html string"),
        requests=spark.createDataFrame([(u, 200, 1.0, 0, None, "e", u) for u in given], "url string, status_code int, response_time double, redirect_count int, error_type string, etag string, last_modified string"),
        captures=spark.createDataFrame([(u, "20240101000000", "200") for u in given], "url string, ts string, status string"),
        archived_at="2024-01-11 00:00:00", model=model,
    )
    out = str(tmp_path / "out")
    config = PipelineConfig(methods=("rules", "gbt"), use_curated=True, use_features=True, write_summary=True)
    batches.start(spark, str(tmp_path / "in"), out, str(tmp_path / "check"), config, landed).awaitTermination()
    plain = {r.url: r for r in batches.run_batch(batches.read_feed(spark, str(tmp_path / "in")), 0, str(tmp_path / "plain"), PipelineConfig(use_curated=True), landed).collect()}
    got = {r.url: r for r in spark.read.parquet(f"{out}/scored/batch=0").collect()}
    assert len(got) == len(plain) == 401 and {u for u, r in got.items() if r.data_source == "good_data"} == {"http://good.org/a", given[0]}
    changed = [u for u, r in got.items() if abs(r.score - plain[u].score) > 1e-9]
    assert len(changed) == len({got[u].domain for u in changed}) == 10
    assert all(got[u].confidence > plain[u].confidence for u in changed if u != "http://good.org/a" and plain[u].confidence < 1)
    trained = {r.url: r.score for r in spark.read.parquet(f"{out}/gbt/scored/batch=0").collect()}
    assert trained.keys() == got.keys() and any(abs(trained[u] - plain[u].score) > 1e-6 for u in trained)
    assert "total: 401 " in spark.read.text(f"{out}/summary/batch=0/overall").first()[0] and spark.read.text(f"{out}/gbt/summary/batch=0/best_urls").count() == 10
    assert spark.read.text(f"{out}/comparison/batch=0/agreement").count() >= 1
    assert spark.read.parquet(f"{out}/reputation/batch=0").agg(F.sum("total_urls_seen")).first()[0] == 401
    assert {(r[0], r[1]) for r in spark.read.parquet(f"{out}/reputation/batch=0").filter("domain <> 'good.org'").select("content_volatility_score", "predicted_revisit_interval_hours").collect()} == {(2.0, 1)}
    for bad in (PipelineConfig(methods=("gbt",)), PipelineConfig(use_features=True), PipelineConfig(use_curated=True), PipelineConfig(methods=("odd",))):
        with pytest.raises(ValueError):
            batches.run_batch(batches.read_feed(spark, str(tmp_path / "in")), 1, out, bad)


def test_volatility_counts_times_of_change_and_is_merged(spark):
    picked = spark.createDataFrame([(f"http://a.com/{i}", "a.com", 0.0, 0.5) for i in range(4)], "url string, domain string, score double, confidence double")
    asked = spark.createDataFrame([(f"http://a.com/{i}", True, 200, 1.0, 0, "e", f"t{i}") for i in range(4)], "url string, accessible boolean, status_code int, response_time double, redirect_count int, etag string, last_modified string")
    content = spark.createDataFrame([], "url string, has_content boolean, content_quality double, content_trust double, content_spam double")
    found = spark.createDataFrame([], "url string, total long, quality_ratio double, spam_ratio double")
    history = spark.createDataFrame([], "url string, archived boolean, archive_count long, days_since_last long")
    for exact in (True, False):
        r = enhance.volatility(enhance.enhance(picked, content, found, asked, history), exact).first()
        assert r.volatility == 1.25 and r.revisit_hours == 270
    assert enhance.volatility(enhance.enhance(picked, content, found, asked.drop("last_modified"), history)).first().volatility == 0.25
    kinds = "domain string, reputation_score double, total_urls_seen long, malicious_urls_count long, benign_urls_count long, content_diversity_score double"
    more = f"{kinds}, content_volatility_score double, predicted_revisit_interval_hours int"
    old = spark.createDataFrame([("a", 1.0, 1, 0, 1, 0.0, 1.0, 360), ("b", 1.0, 1, 0, 1, 0.0, 0.5, 540)], more)
    new = spark.createDataFrame([("a", 1.0, 1, 0, 1, 0.0, 2.0, 1), ("b", 1.0, 1, 0, 1, 0.0, None, None), ("c", 1.0, 1, 0, 1, 0.0, None, None)], more)
    got = {r.domain: (r.content_volatility_score, r.predicted_revisit_interval_hours) for r in domains.upsert(old, new).collect()}
    assert got["a"] == (pytest.approx(1.1), 1) and got["b"] == (0.5, 540) and got["c"] == (None, 168)
    plain = new.select(*[c.split(" ")[0] for c in kinds.split(", ")])
    assert {r.domain: r.predicted_revisit_interval_hours for r in domains.upsert(old, plain).collect()} == {"a": 360, "b": 540, "c": 168}


def test_lists_and_readers(spark, tmp_path):
    (tmp_path / "words").write_text(" Casino \n\nPILLS\ncasino\na.*b\n")
    (tmp_path / "none").write_text(" \n\n")
    assert readers.read_keywords(spark, f"{tmp_path}/words") == ("a.*b", "casino", "pills")
    assert sorted(r.host for r in readers.read_hosts(spark, f"{tmp_path}/words").collect()) == ["a.*b", "casino", "pills"]
    for missing in ("none", "nowhere"):
        assert readers.read_list(spark, f"{tmp_path}/{missing}", strict=False).count() == 0
        with pytest.raises(Exception):  # noqa: B017
            readers.read_list(spark, f"{tmp_path}/{missing}")
    (tmp_path / "curated.tsv").write_text('url\tsource_uri\ttimestamp\tuser_text\tsource_type\tmetadata\nhttp://a/\ts\t2024-01-01\t"two\twords"\trss\t"{""a"": 1}"\n\ts\t\t\t\t\n')
    rows = readers.read_curated(spark, f"{tmp_path}/curated.tsv").collect()
    assert [(r.url, r.user_text, r.metadata) for r in rows] == [("http://a/", "two\twords", '{"a": 1}')]


def test_database_round_trip(spark, tmp_path):
    url, driver = f"jdbc:derby:{tmp_path}/db;create=true", {"driver": "org.apache.derby.jdbc.EmbeddedDriver"}
    table = spark.createDataFrame([(d, float(i), i) for i, d in enumerate(("a.com", "m.org", "z.net", "1.com"))], "domain string, reputation_score double, total_urls_seen long")
    sinks.write_reputation_table(table, url, "reputation", createTableColumnTypes="domain VARCHAR(255)", **driver)
    assert sorted(map(tuple, readers.read_reputation(spark, url, "reputation", **driver).collect())) == sorted(map(tuple, table.collect()))
    some = readers.read_reputation(spark, url, "reputation", ["domain", "reputation_score"], readers=5, **driver)
    assert some.rdd.getNumPartitions() == 5 and sorted(r.domain for r in some.collect()) == ["1.com", "a.com", "m.org", "z.net"]
    assert "total_urls_seen" not in readers.read_reputation(spark, url, "reputation", ["domain"], **driver)._jdf.queryExecution().executedPlan().toString()
    rows = spark.createDataFrame([("http://a/", 0.5)], "url string, score double")
    for _ in range(2):
        sinks.write_jdbc(rows, url, "urls", writers=2, **driver)
    assert spark.read.format("jdbc").option("url", url).option("dbtable", "urls").options(**driver).load().count() == 2


def test_a_batch_keeps_null_urls_counts_and_uses_lists(spark, tmp_path):
    given = spark.createDataFrame([("1700000000", None), ("1700000000", "http://good.com/news/a"), ("1700000000", ""), ("x", "http://bad.com/casino")], "ts string, url string")
    lists = {"nsfw_domain": spark.createDataFrame([("bad.com",)], "host string"), "news_domain": spark.createDataFrame([("good.com",)], "host string")}
    landed = batches.Landed(lists=lists, keywords={"spam": ("casino",)})
    plain = {r.url: r for r in batches.run_batch(given, 0, str(tmp_path / "plain"), processed_at="2024-05-06 07:08:09").collect()}
    listed = {r.url: r for r in batches.run_batch(given, 0, str(tmp_path / "lists"), PipelineConfig(use_lists=True), landed).collect()}
    assert set(plain) == {"invalid_url", "", "http://good.com/news/a", "http://bad.com/casino"}
    assert (plain["invalid_url"].score, plain["invalid_url"].is_spam, plain["invalid_url"].domain) == (-2.0, True, "unknown.invalid")
    assert listed["http://good.com/news/a"].score > plain["http://good.com/news/a"].score + 1
    assert listed["http://bad.com/casino"].is_spam and listed["http://bad.com/casino"].score < plain["http://bad.com/casino"].score - 3.6
    counts = spark.read.parquet(f"{tmp_path}/plain/counts").first()
    assert (counts.urls, counts.without_url) == (4, 1) and 0 <= counts.spam <= 4
    assert {str(r.processed_at) for r in spark.read.parquet(f"{tmp_path}/plain/store").collect()} == {"2024-05-06 07:08:09"}
    assert spark.read.parquet(f"{tmp_path}/lists/store").first().processed_at.year >= 2024
    with pytest.raises(ValueError):
        batches.run_batch(given, 1, str(tmp_path / "lists"), PipelineConfig(use_lists=True))


def test_ranking_by_ranges(spark):
    rows = spark.createDataFrame([(f"d{i % 997:04d}x{i}", (i * 37 % 100) / 100, i % 7, i % 3) for i in range(3000)], "domain string, reputation_score double, total_urls_seen long, malicious_urls_count long")
    got = domains.ranked(rows.repartition(9)).orderBy("rank").collect()
    true = sorted(rows.collect(), key=lambda r: (-r.reputation_score, -r.total_urls_seen, r.domain))
    assert [r["rank"] for r in got] == [*range(1, 3001)] and [r.domain for r in got] == [r.domain for r in true]
    assert domains.ranked(rows.limit(0)).count() == 0


def test_domain_stats_ways_agree(spark):
    rows = spark.createDataFrame([(f"d{i % 3}", float(i % 5) if i % 11 else None, i % 2 == 0, f"a{i % 4}", f"b{i}" if i % 3 else None) for i in range(200)] + [("one", 1.0, True, None, None), ("same", 0.1, False, "x", "y"), ("same", 0.1, False, "x", "z")], "domain string, score double, is_spam boolean, segment1 string, segment2 string")
    exact, near = ({r.domain: r for r in scoring.domain_stats(rows, e).collect()} for e in (True, False))
    for d, r in exact.items():
        assert (r.total_urls, r.malicious, r.benign) == (near[d].total_urls, near[d].malicious, near[d].benign)
        assert r.mean_score == pytest.approx(near[d].mean_score) and (r.score_stddev is None) == (near[d].score_stddev is None)
        assert r.score_stddev is None or r.score_stddev == pytest.approx(near[d].score_stddev, abs=1e-7)
    assert exact["d0"].segments1 == 4 and exact["one"].segments1 == 0 and exact["same"].segments2 == 2


def test_entropy(spark):
    cases = ["", "a", "aa", "ab", "aab\n\n", "😀😀x", "hello world"]
    got = {r.t: r.e for r in spark.createDataFrame([(t,) for t in cases], "t string").select("t", urls.entropy(F.col("t")).alias("e")).collect()}
    for t in cases:
        shares = [t.count(c) / len(t) for c in set(t)]
        assert got[t] == pytest.approx(-sum(p * math.log2(p) for p in shares) if len(t) > 1 else 0.0)


def test_attributes_and_entities(spark):
    tags = {"<a href='x'>": "x", '<a class="href=y" href="a&amp;b&#33;">': "a&b!", "<a data-href=q href=bare>": "bare", "<a name=top>": "", '<a href="&lt;&#8364;&amp;amp;">': "<€&amp;", "<a\nHREF = '1>2'>": "1>2", '<a href="">': ""}
    got = {r.t: r.v for r in spark.createDataFrame([(t,) for t in tags], "t string").select("t", html.attribute(F.col("t"), "href").alias("v")).collect()}
    assert got == tags


def test_held_back_measure(spark):
    rows = feed_of(spark, *[f"http://s{i % 9}.{['com', 'tk', 'gov'][i % 3]}/{['news', 'login'][i % 2]}/{i}" for i in range(600)])
    labels = ml.targets(scoring.score_rules(rows).withColumn("data_source", F.lit("input_data")))
    table = ml.features(scoring.featured(rows))
    r = ml.evaluate(ml.predict_features(table, ml.train_features(table, labels, trees=10, depth=4)), labels).first()
    assert 20 < r.urls < 120 and r.correlation > 0.9 and r.mean_error < 0.5


def test_report_sections(spark):
    rows = spark.createDataFrame([(f"u{i}", f"d{i % 3}", i / 10, 0.5, i % 2 == 0, "good_data" if i % 4 == 0 else "input_data") for i in range(30)], "url string, domain string, score double, confidence double, is_spam boolean, data_source string")
    got = reports.summary(rows).collect()
    of = lambda s, r, m: next(x for x in got if (x.section, x["rank"], x.metric) == (s, r, m))
    assert of("overall", 1, "total").value == 30 and of("best_urls", 1, "url").text == "u29" and of("worst_urls", 2, "url").text == "u1"
    assert of("frequent_curated_domains", 1, "domain").text in {"d0", "d1", "d2"} and of("frequent_curated_domains", 3, "urls").value >= 2
    two = rows.withColumn("model_name", F.lit("a")).union(rows.limit(5).withColumn("model_name", F.lit("b")))
    assert {r.model_name: r.distinct_urls for r in reports.overall(two, "model_name").collect()} == {"a": 30, "b": 5}
