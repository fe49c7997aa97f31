from pyspark.sql import functions as F

from linkgauge.llm.reputation import Rule, host_posteriors, judge, registered_domain, split_url

RULES = [Rule("net/", "block"), Rule("example.net/en/", "allow"), Rule("org/fr/", "allow")]


def test_split_rules_and_method(spark):
    urls = ["HTTP://WWW.Example.NET/en/x?q#f", "http://example.net/EN/", "http://net", "http://x.net?/en/", "http://É.org/fr/", "no scheme", None, "", "http://good.com/a", "http://bad.com/a", "http://notnet/x", "http://good.com/a", "x://y://z/fr/"]
    pages = spark.createDataFrame([(i, u, "z", 1.0) for i, u in enumerate(urls)], "page_id long, url string, verdict string, lower double")
    many = spark.createDataFrame([(100 + i, "http://good.com/") for i in range(60)] + [(200 + i, "http://bad.com/") for i in range(60)], "page_id long, url string")
    labels = spark.createDataFrame([(100 + i, True) for i in range(60)] + [(200 + i, i % 9 == 0) for i in range(60)] + [(None, True), (5, None), (9999, False)], "page_id long, good boolean")
    rows = {r.page_id: r for r in judge(pages.select("page_id", "url", "verdict").unionByName(many, True), labels, RULES).collect()}
    assert len(rows) == len(urls) + 120
    assert (rows[0].host, rows[0].path, rows[0].rule, rows[0].verdict) == ("www.example.net", "/en/x", "example.net/en/", "allow")
    assert (rows[1].rule, rows[1].verdict) == ("net/", "block")
    assert (rows[2].host, rows[2].path, rows[2].rule) == ("net", "", None)
    assert (rows[3].host, rows[3].path, rows[3].rule) == ("x.net", "", None)
    assert (rows[4].host, rows[4].rule, rows[4].verdict) == ("É.org", "org/fr/", "allow")
    assert {(rows[i].host, rows[i].path, rows[i].verdict) for i in (5, 6, 7)} == {("", "", "block")}
    assert (rows[8].verdict, rows[9].verdict, rows[11].verdict) == ("allow", "block", "allow")
    assert rows[10].rule is None and rows[12].host == "y:"


def test_shrinkage(spark):
    pages = [(i, "http://big.a.com/") for i in range(100)] + [(1000, "http://small.a.com/"), (1001, "http://new.a.com/"), (1002, "http://only.b.org/")] + [(i, "http://big.b.org/") for i in range(2000, 2100)]
    good = [(i, i % 10 != 0) for i in range(100)] + [(1000, False)] + [(i, i % 10 == 0) for i in range(2000, 2100)]
    got = {r.host: r for r in host_posteriors(spark.createDataFrame(pages, "page_id long, url string"), spark.createDataFrame(good, "page_id long, good boolean")).collect()}
    assert abs(got["big.a.com"].posterior - 0.9) < 0.05 and got["small.a.com"].posterior < got["new.a.com"].posterior
    assert abs(got["new.a.com"].posterior - got["new.a.com"].prior) < 1e-9 and got["new.a.com"].prior > got["only.b.org"].prior
    assert all(r.lower < r.posterior for r in got.values())


def test_empty_and_unlabelled(spark):
    pages = spark.createDataFrame([(1, "http://a.com/")], "page_id long, url string")
    none = spark.createDataFrame([], "page_id long, good boolean")
    assert judge(pages, none, []).first().verdict == "block"
    assert judge(pages.limit(0), none, []).count() == 0


def test_domains(spark):
    hosts = ["a.b.co.uk", "b.co.uk:80", "x.y.com", "localhost", "10.0.0.1", "co.uk"]
    df = spark.createDataFrame([(h,) for h in hosts], "h string").select(*registered_domain(F.col("h")))
    assert [tuple(r) for r in df.collect()] == [("b.co.uk", "co.uk"), ("b.co.uk", "co.uk"), ("y.com", "com"), ("localhost", "localhost"), ("10.0.0.1", "10.0.0.1"), ("co.uk", "uk")]
    assert spark.range(1).select(split_url(F.lit("a://b"))[0]).first()[0] == "b"
