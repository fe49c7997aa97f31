"""Landed files of several days, ranges of a database table, and a query that goes on running."""

import gzip
import time

from linkgauge.operators import curated
from linkgauge.sources import readers, sinks
from linkgauge.streaming import batches


def test_days_of_rss_files(spark, tmp_path):
    item = "<item><link>http://{}.com/{}</link>{}</item>"
    for day in ("20250830", "20250901", "20250902", "20250905"):
        (tmp_path / f"mc-{day}.rss.gz").write_bytes(gzip.compress(("<rss>" + item.format("a", day, "") + item.format("b", day, "<pubDate>Sat, 02 Aug 2025 01:02:03 +0000</pubDate>") + "</rss>").encode()))
    (tmp_path / "readme").write_text("no day")
    got = sorted((r.url, str(r.timestamp), r.source_file) for r in curated.rss_days(spark, str(tmp_path), "2025-09-01", "2025-09-04").collect())
    assert got == [("http://a.com/20250901", "2025-09-01 00:00:00", "mc-20250901.rss.gz"), ("http://a.com/20250902", "2025-09-02 00:00:00", "mc-20250902.rss.gz"), ("http://b.com/20250901", "2025-08-02 01:02:03", "mc-20250901.rss.gz"), ("http://b.com/20250902", "2025-08-02 01:02:03", "mc-20250902.rss.gz")]
    none = curated.rss_days(spark, f"{tmp_path}/nowhere", "2025-09-01", "2025-09-04")
    assert none.count() == 0 and set(none.columns) >= {"url", "timestamp", "source_file"}


def test_days_of_wiki_files(spark, tmp_path):
    for n in (1, 2, 3):
        day = tmp_path / f"2025-09-0{n}"
        for part, text in (("changes", '{"query": {"recentchanges": [{"title": "T%d", "user": "u", "timestamp": "2025-09-01T00:00:00Z"}]}}'), ("links", '{"query": {"pages": {"1": {"title": "T%d", "extlinks": [{"*": "http://x%d.org/"}]}}}}')):
            (day / part).mkdir(parents=True)
            (day / part / "0.json").write_text(text % ((n,) * text.count("%d")))
    got = {r.url for r in curated.wiki_days(spark, str(tmp_path), "2025-09-02", "2025-09-09").collect()}
    assert got == {f"https://en.wikipedia.org/wiki/T{n}" for n in (2, 3)} | {f"http://x{n}.org/" for n in (2, 3)}
    assert curated.wiki_days(spark, str(tmp_path), "2024-01-01", "2024-01-02").count() == 0


def test_ranges_follow_the_names(spark, tmp_path):
    url, driver = f"jdbc:derby:{tmp_path}/db;create=true", {"driver": "org.apache.derby.jdbc.EmbeddedDriver"}
    names = [f"www.shop{i}.com" for i in range(3000)] + ["a.com", "o'neil.org", "zzz.net"]
    table = spark.createDataFrame([(d, float(i), i) for i, d in enumerate(names)], "domain string, reputation_score double, total_urls_seen long")
    sinks.write_reputation_table(table, url, "reputation", createTableColumnTypes="domain VARCHAR(255)", **driver)
    found = readers.read_reputation(spark, url, "reputation", readers=6, **driver)
    sizes = found.rdd.mapPartitions(lambda rows: [sum(1 for _ in rows)]).collect()
    assert sum(sizes) == 3003 and len(sizes) == 6 and max(sizes) <= 2 * min(sizes)
    some = readers.read_reputation(spark, url, "reputation", ["domain"], readers=3, where='"reputation_score" < 10', **driver)
    assert sorted(r.domain for r in some.collect()) == sorted(names[:10])
    assert readers.read_reputation(spark, url, "reputation", readers=4, where='"reputation_score" < 0', **driver).count() == 0


def test_a_query_that_goes_on(spark, tmp_path):
    (tmp_path / "in").mkdir()
    told = batches.Arrivals()
    spark.streams.addListener(told)
    query = batches.start(spark, f"{tmp_path}/in", f"{tmp_path}/out", f"{tmp_path}/check", every="1 second")
    try:
        for n in range(2):
            (tmp_path / "in" / f"{n}.tsv").write_text(f"17\thttp://a.com/{n}\n17\thttp://b{n}.com/\n")
            end = time.time() + 120
            while len(told.batches) <= n and time.time() < end:
                time.sleep(0.5)
        assert query.isActive
    finally:
        query.stop()
        spark.streams.removeListener(told)
    assert [(b["batch"], b["arrived"], b["without_url"], b["files"]) for b in told.batches] == [(0, 2, 0, 1), (1, 2, 0, 1)]
    rows = spark.read.parquet(f"{tmp_path}/out/scored").collect()
    assert {(r.url, r.source_file) for r in rows} == {(u, f"{n}.tsv") for n in range(2) for u in (f"http://a.com/{n}", f"http://b{n}.com/")}
    assert {r.domain: r.total_urls_seen for r in sinks.latest_reputation(spark, f"{tmp_path}/out/reputation", 2).collect()}["a.com"] == 2
