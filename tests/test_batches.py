"""Batches: results and their columns, keys of long urls, what is left in folders, the store's and the reputation's parts."""

import gc
import json
import time
from contextlib import contextmanager
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from linkgauge.config import PipelineConfig
from linkgauge.operators import domains, scoring
from linkgauge.plans import other_queries
from linkgauge.sources import sinks
from linkgauge.sources.shared import batches_in, cut_lineage
from linkgauge.streaming import batches

# fixed value: columns of a batch's result
RESULT = {"url", "timestamp", "domain", "score", "confidence", "meta", "domain_frequency", "domain_frequency_pct", "is_spam", "received_at", "domain_reputation_score", "data_source"}


def feed(spark, *urls):
    return spark.createDataFrame([("1700000000", u) for u in urls], "ts string, url string")


def test_the_result_holds_the_batch_reputation_and_all_columns(spark, tmp_path):
    urls = ["http://good.gov/news/2024/5/a-b-c-long-title", "http://good.gov/x", "http://bad.tk/login"]
    out = str(tmp_path)
    rows = {r.url: r for r in batches.run_batch(feed(spark, *urls), 0, out, processed_at="2024-05-06 07:08:09").collect()}
    first = {r.url: r.score for r in scoring.score_rules(scoring.normalise_feed(feed(spark, *urls))).collect()}
    mean = (first[urls[0]] + first[urls[1]]) / 2
    assert RESULT <= set(rows[urls[0]].asDict())
    assert rows[urls[0]].domain_reputation_score == pytest.approx(mean) and rows[urls[0]].score == pytest.approx(first[urls[0]] + 0.2 * mean)
    assert rows[urls[2]].domain_reputation_score == pytest.approx(first[urls[2]]) and rows[urls[1]].domain_frequency_pct == pytest.approx(2 / 3)
    assert str(rows[urls[0]].received_at) == "2024-05-06 07:08:09"
    store = spark.read.parquet(f"{out}/store").collect()
    assert all(set(json.loads(r.meta)) == set(sinks.META) for r in store) and len(store) == 3
    assert not list((tmp_path / "work").glob("*"))


def test_urls_that_are_cut_alike_stay_apart(spark, tmp_path):
    long = "http://a.com/" + "x" * 1100
    urls = [long + "1", long + "2", "http://a.com/1", "http://a.com/2"]
    rows = batches.run_batch(feed(spark, *urls), 0, str(tmp_path)).collect()
    assert len({r.url for r in rows}) == 3 and len({r.url_hash for r in rows}) == 4
    assert spark.read.parquet(f"{tmp_path}/store").count() == 4


def test_the_store_is_read_in_its_buckets(spark, tmp_path):
    rows = sinks.store_rows(scoring.score_rules(scoring.normalise_feed(feed(spark, *[f"http://a.com/{i}" for i in range(50)]))), "2024-01-01")
    for n, part in enumerate((rows.limit(30), rows, rows, rows.filter("false"))):
        sinks.insert_absent(part, f"{tmp_path}/store", n, buckets=8)
    sinks.insert_absent(rows.limit(30), f"{tmp_path}/store", 0, buckets=8)
    found = spark.read.parquet(f"{tmp_path}/store")
    assert found.count() == 50 == found.select("url_hash").distinct().count() and {r.batch for r in found.select("batch").collect()} == {0, 1}
    name = sinks.store_table(spark, f"{tmp_path}/store", "", buckets=8)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
        plan = sinks.absent(sinks.with_entry(rows), spark.table(name).filter("batch < 2"), ("entry",))._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "Bucketed: true" in plan and plan.count("Exchange hashpartitioning") == 1 and "LeftAnti" in plan
    spark.sql(f"drop table {name}")  # another session finds the parts that are there
    sinks.insert_absent(rows, f"{tmp_path}/store", 5, buckets=8)
    assert spark.read.parquet(f"{tmp_path}/store").count() == 50


def table(spark, *rows):
    return spark.createDataFrame([(d, float(v), n, 0, n, 0.0) for d, v, n in rows], "domain string, reputation_score double, total_urls_seen long, malicious_urls_count long, benign_urls_count long, content_diversity_score double")


def test_reputation_is_written_by_changes(spark, tmp_path):
    path, whole = f"{tmp_path}/reputation", None
    parts = [table(spark, *[(f"d{k}", k + n, 1) for k in range(n % 3, 12, 3)]) for n in range(9)]
    for n, part in enumerate(parts):
        stored = sinks.latest_reputation(spark, path, n)
        assert (stored is None) == (n == 0)
        old = stored if stored is not None else part.limit(0)
        sinks.write_reputation(domains.changed(old, part), path, n, base_every=2, kept=2)
        assert spark.read.parquet(f"{path}/batch={n}").count() == 4
        whole = domains.upsert(whole if whole is not None else part.limit(0), part)
        assert sorted(map(tuple, sinks.latest_reputation(spark, path, n + 1).select(*whole.columns).collect())) == sorted(map(tuple, whole.collect()))
    assert batches_in(spark, f"{path}_base") == [5, 7] and batches_in(spark, path) == [6, 7, 8]
    before = sorted(map(tuple, sinks.latest_reputation(spark, path, 9).collect()))
    sinks.write_reputation(domains.changed(sinks.latest_reputation(spark, path, 8), parts[8]), path, 8, base_every=2, kept=2)  # a replay
    assert sorted(map(tuple, sinks.latest_reputation(spark, path, 9).collect())) == before
    assert sinks.latest_reputation(spark, f"{tmp_path}/none", 3) is None


def test_a_batch_writes_to_a_database_and_trains(spark, tmp_path):
    url, driver = f"jdbc:derby:{tmp_path}/db;create=true", {"driver": "org.apache.derby.jdbc.EmbeddedDriver"}
    urls = [f"http://s{i % 9}.{['com', 'tk', 'gov'][i % 3]}/{['news', 'login'][i % 2]}/{i}" for i in range(120)]
    landed = batches.Landed(database={"url": url, "table": "urls", "createTableColumnTypes": "url VARCHAR(2000)", **driver})
    config = PipelineConfig(write_db=True, train_model=True, store_buckets=8)
    for n in range(2):
        batches.run_batch(feed(spark, *urls, f"http://new{n}.com/"), n, f"{tmp_path}/out", config, landed)
    stored = spark.read.format("jdbc").option("url", url).option("dbtable", "urls").options(**driver).load()
    assert stored.count() == 122 == stored.select("url").distinct().count()
    assert (tmp_path / "out" / "model" / "batch=1" / "stages").exists()
    with pytest.raises(ValueError):
        batches.run_batch(feed(spark, *urls), 2, f"{tmp_path}/out", config)


def test_counts_of_domains_that_come_again(spark, tmp_path):
    out = str(tmp_path)
    for n in range(3):
        batches.run_batch(feed(spark, "http://a.com/1", f"http://b{n}.com/"), n, out, PipelineConfig(base_every=2))
    got = {r.domain: r.total_urls_seen for r in sinks.latest_reputation(spark, f"{out}/reputation", 3).collect()}
    assert got == {"a.com": 3, "b0.com": 1, "b1.com": 1, "b2.com": 1} and batches_in(spark, f"{out}/reputation_base") == [1]
    assert spark.read.parquet(f"{out}/reputation/batch=2").agg(F.count("*")).first()[0] == 2


def test_checkpoints_go_when_nothing_refers_to_them(spark):
    rows = cut_lineage(spark.range(100).repartition(3))
    folder = Path(spark.sparkContext.getCheckpointDir().removeprefix("file:"))
    kept = {p.name for p in folder.glob("rdd-*")}
    assert kept and rows.count() == 100
    del rows
    end = time.time() + 60
    while time.time() < end and kept <= {p.name for p in folder.glob("rdd-*")}:
        gc.collect()
        spark._jvm.System.gc()
        time.sleep(0.5)
    assert not kept <= {p.name for p in folder.glob("rdd-*")}


def test_a_batch_keeps_little_and_not_for_long(spark, tmp_path, monkeypatch):
    """Between its steps a batch writes the columns that its result needs, and they are gone before the store is written; so are the
    files that a registered stream has landed."""
    urls = [f"http://s{i % 9}.{['com', 'tk', 'gov'][i % 3]}/{['news', 'login'][i % 2]}/{i}" for i in range(60)]
    columns, left, insert, steps = [], [], sinks.insert_absent, batches.workspace

    @contextmanager
    def watched(session, path):
        with steps(session, path) as keep:
            yield lambda df: (columns.append(set(df.columns)), keep(df))[1]

    def inserted(rows, path, *settings, **more):
        left.append(list(Path(path).parent.glob("work/*")))
        insert(rows, path, *settings, **more)

    monkeypatch.setattr(batches, "workspace", watched)
    monkeypatch.setattr(sinks, "insert_absent", inserted)
    when = "2024-05-06 07:08:09"
    plain = batches.run_batch(feed(spark, *urls), 0, f"{tmp_path}/plain", processed_at=when)
    assert left == [[]] and not any({"path", "path_entropy", "url_hash"} & own for own in columns)
    columns.clear()
    trained = batches.run_batch(feed(spark, *urls), 0, f"{tmp_path}/trained", PipelineConfig(train_model=True), processed_at=when)
    assert any("path_entropy" in own for own in columns) and left == [[], []]
    assert sorted(map(tuple, plain.collect())) == sorted(map(tuple, trained.collect()))
    monkeypatch.undo()
    folder = Path(str(tmp_path / "streams"))
    monkeypatch.setattr(other_queries, "shared_folder", lambda session, name: str(folder))
    assert other_queries.stream_batches(spark, "/root/testdata/sf0.001").count() > 0
    assert not (folder / "landed").exists() and len(list((folder / "out" / "scored").glob("batch=*"))) == 3
