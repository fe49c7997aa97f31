"""Splitting, letter counts and pattern flags by cheap ways, against the patterns themselves."""

import math
import random
import re

import pytest
from pyspark.sql import functions as F

from linkgauge.functions import urls
from linkgauge.operators import scoring


def test_split_is_that_of_the_pattern(spark):
    rng = random.Random(3)
    odd = [None, "", "//", "a.com", "http://", "http:///x", "HTTP://A.com/x", "http://A.Com:80/p?q=1?r#f", "//é.com/ü?ß#x", "a.com?x#y", "a.com#f\n", "a.com#f\nx", "a.com/x\ny?z\n#\u2028", "h2://q.com", "x:y://z", "http://a.com//b//c", "😀.com/😀?😀"]
    odd += ["".join(rng.choices(["a", "B", "://", "/", "//", "?", "#", ":", ".", "\n", "é", "http://"], k=rng.randint(0, 9))) for _ in range(600)]
    rows = spark.createDataFrame([(u,) for u in odd], "url string")
    full = F.when(F.col("url").contains("://"), F.col("url")).otherwise(F.concat(F.lit("//"), "url"))
    group = lambda n: F.coalesce(F.regexp_extract(full, urls.URL, n), F.lit(""))
    found = urls.split(rows).select("url", "domain", "path", "query", urls.host(F.col("url")).alias("host"), F.lower(group(1)).alias("d"), group(2).alias("p"), group(3).alias("q"))
    for r in found.collect():
        assert (r.domain, r.path, r.query) == (r.d or urls.UNKNOWN, r.p, r.q), r.url
        assert r.host == r.domain


def test_letters_of_a_batch(spark):
    cases = ["", "a", "shop1.example.tk", "aaa", None, "éé1a", "😀x9bcd", "ab" * 3000] + [f"h{i % 7}.com" for i in range(50)]
    rows = spark.createDataFrame([(t,) for t in cases], "t string").coalesce(1).withColumn("of", urls.letters(F.col("t"))).withColumn("e", urls.entropy(F.col("t")))
    for r in rows.collect():
        t = r.t or ""
        entropy = -sum(t.count(c) / len(t) * math.log2(t.count(c) / len(t)) for c in set(t)) if len(t) > 1 else 0.0
        assert r.e == pytest.approx(entropy, abs=1e-12) and r.of.entropy == pytest.approx(entropy, abs=1e-12)
        assert (r.of.vowels, r.of.consonants, r.of.digits) == tuple(len(re.findall(p, t)) for p in ("[aeiou]", "[b-df-hj-np-tv-z]", "[0-9]"))


def test_patterns_are_searched_only_where_a_word_is(spark):
    patterns = {**urls.CONTENT, "short": urls.SHORTENER}
    texts = ["", "/x", "/LOGIN", "/login", "/xlogin", "/v3/", "/v0/", "a /media/ b", "x/media/y", "bit.ly", "bitXly", "/api.json", "/Act Now", "/act now!", "/wp-admin", "/\u212aeygen"]
    texts += [f"{a}{w}{b}" for p in patterns.values() for w in urls._words(p) for a, b in (("/", "/"), ("x", ""), ("", "_"))]
    rows = spark.createDataFrame([(t,) for t in texts + [None]], "t string")
    t = F.col("t")
    same = [urls.holds(t, p, any_case).eqNullSafe(t.rlike(f"(?i){p}" if any_case else p)) for p in patterns.values() for any_case in (False, True)]
    assert rows.select(F.array_contains(F.array(*same), False).alias("differs")).filter("differs").isEmpty()


def test_paths_are_searched_in_batches(spark):
    """Marks and patterns of paths that are counted in Arrow batches, against the patterns; and what the plans do not do any more."""
    texts = ["", "/", "/a/b/", "/A-b-c_d/x.y", "/a b~!@$%^()", "/\x1c\x1d\x1e\x1f", "/\t\x0b\x0c\r", "/\u00fc!!", "/\u00fc!!!!", "/\u65e5\u672c~~~~", "/user/x", "/c/", "/a-12345", "/a-1234/", "/2024/5/", "/1924/5/", "/LOGIN", "/login", "/\u00fclogin", "/v3/", "a /media/ b", "/Act Now", "/act now!", None]
    rows = spark.createDataFrame([(t, q) for t in texts for q in ("", "exe=1", "x=\u00e9&Login", None)], "path string, query string")
    path, content = F.coalesce("path", F.lit("")), F.concat_ws("?", F.coalesce("path", F.lit("")), F.coalesce("query", F.lit("")))
    got = rows.withColumn("p", urls.profiled(F.col("path"), F.col("query"))).withColumn("any", F.arrow_udf(urls._any_case, "int")(F.col("path"), F.col("query")))
    bit = lambda c, i: F.col(c).bitwiseAND(F.lit(1 << i)) > 0
    same = [F.col("p.slashes") == urls.occurrences(path, "/"), F.col("p.hyphens") == urls.occurrences(path, "-"), F.when(F.col("p.odd") < 0, F.length(path) < F.octet_length(path)).otherwise(F.col("p.odd") == urls.counted(path, r"(?U)[^\w\s/.-]"))]
    same += [bit("p.found", len(urls.CONTENT) + i) == path.rlike(p) for i, p in enumerate(urls.IN_PATH.values())]
    ascii_only = F.length(content) == F.octet_length(content)  # word boundaries beside other letters are those of the comparison SQL
    same += [~ascii_only | (bit("p.found", i) == content.rlike(p)) for i, p in enumerate(urls.CONTENT.values())]
    same += [~ascii_only | (bit("any", i) == content.rlike(f"(?i){p}")) for i, p in enumerate(urls.CONTENT.values())]
    told = got.select("path", "query", F.array(*same).alias("same")).collect()
    assert len(told) == len(texts) * 4 and [(r.path, r.query, r.same) for r in told if not all(r.same)] == []
    one = spark.createDataFrame([("http://a.com/b/c",)], "url string")
    lists = {n: spark.createDataFrame([("A.com ",), ("a.com",), (None,)] if n != "news_domain" else [("b.com",)], "host string") for n in scoring.LISTS}
    flagged = scoring.list_flags(scoring.split_urls(one), lists)
    assert [tuple(r) for r in flagged.select("is_nsfw_domain", "is_quality_domain", "is_news_domain", "segment1", "segment2").collect()] == [(True, True, False, "b", "c")]
    assert flagged._jdf.queryExecution().optimizedPlan().toString().count("Join") == 1
    spark.conf.unset("spark.sql.codegen.hugeMethodLimit")
    scoring.featured(one.withColumn("timestamp", F.current_timestamp()))
    assert spark.conf.get("spark.sql.codegen.hugeMethodLimit") == "8000"


def test_frequencies_of_counts_taken_before(spark):
    rows = spark.createDataFrame([("a",), ("a",), ("b",), ("a",)], "domain string")
    counts = scoring.domain_counts(rows)
    got = [sorted(map(tuple, scoring.frequencies(rows, c).collect())) for c in (None, counts)]
    assert got[0] == got[1] == [("a", 3, 0.75)] * 3 + [("b", 1, 0.25)]
