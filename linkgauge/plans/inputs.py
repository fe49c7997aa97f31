"""Views that the registered queries run on: URLs, reputations, archive captures and HTTP observations derived from the
star-schema tables, with one text for Spark and for the comparison SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..sources.shared import spread

TABLES = ("lineitem", "supplier", "orders", "customer")
TLD = "case {} % 4 when 0 then 'tk' when 1 then 'gov' when 2 then 'com' else 'xyz' end"
URLS = f"""select concat('https://', case when l_linenumber = 1 then 'www.' else '' end, 'shop', cast(l_suppkey as {{S}}), '.example.', {TLD.format('l_suppkey')},
  '/', case when l_returnflag = 'R' then 'login' else 'news' end, '/', cast(year(l_shipdate) as {{S}}), '/', cast(month(l_shipdate) as {{S}}),
  '/item-', cast(l_partkey as {{S}}), '-', cast(l_orderkey as {{S}})) url, cast(l_shipdate as timestamp) ts, l_returnflag flag from lineitem"""
REPUTATION = f"""select concat('shop', cast(s_suppkey as {{S}}), '.example.', {TLD.format('s_suppkey')}) domain, round((s_acctbal - 4500) / 5500, 6) reputation_score,
  cast(s_suppkey % 50 as bigint) total_urls_seen, cast(s_suppkey % 7 as bigint) malicious_urls_count, cast(s_suppkey % 43 as bigint) benign_urls_count,
  cast(s_suppkey % 11 as double) / 10 content_diversity_score from supplier"""
CAPTURES = """select concat('https://shop', cast(l_suppkey as {S}), '.example.com/item-', cast(l_partkey % 50 as {S})) url, {TS} ts,
  case l_returnflag when 'R' then '404' when 'A' then '301' else '200' end status from lineitem"""
OBSERVED = """select concat('https://shop', cast(o_custkey % 100 + 1 as {S}), '.example.com/o/', cast(o_orderkey as {S})) url,
  case o_orderstatus when 'F' then 200 when 'O' then 404 else 302 end status_code, round(o_totalprice / 50000, 6) response_time, cast(o_orderkey % 5 as int) redirect_count,
  case when o_orderkey % 17 = 0 then 'timeout' end error_type, md5(o_orderpriority) etag, case when o_orderkey % 3 > 0 then cast(o_orderdate as {S}) end last_modified, o_orderkey % 2 = 0 has_hsts from orders"""
EDGES = """select * from (values (1, '1756684800', 'http://a.com'), (2, '2025-09-01T00:00:00Z', 'HTTP://A.com/x'), (3, 'x', 'h2://q.com'), (4, cast(null as {S}), ''),
  (5, '0', '/rel/path'), (6, '1', 'a.com/x?y=1&z#f'), (7, '2', 'http://h:8080/p'), (8, '3', 'http://u:p@h.com/'), (9, '4', 'mailto:x@y'), (10, '5', 'http://é.com/ü-ß'),
  (11, '6', 'http://a.com?x#y'), (12, '7', cast(null as {S})), (13, '8', '"http://a.com/x"" target=_blank"'), (14, '9', 'http://10.0.0.1/login'), (15, '10', 'localhost/x'),
  (16, '11', concat('http://long.com/', repeat('a', 2040))), (17, '12', 'http://p.com/?a&b&c&d&e&f&g&h&i&j&k'), (18, '13', 'http://e.com/%20%20%20%20%20%20'),
  (19, '14', 'http://s.com/a-b-c-long-title-12345/'), (20, '15', 'http://d.com/2024/5/')) e(id, ts, url)"""

#: The edge rows and the whole url view as a raw feed of texts.
FEED = f"select ts, url from ({EDGES}) union all select {{EPOCH}} ts, url from ({URLS})"
HOST_LIST = "select concat('shop', cast(s_suppkey as {{S}}), '.example.', {tld}) host from supplier where s_suppkey % {every} = 0"
#: Host lists by name, and keywords; regular expressions in keywords are plain text.
HOSTS = {name: HOST_LIST.format(tld=TLD.format("s_suppkey"), every=every) for name, every in (("nsfw_domain", 17), ("quality_domain", 5), ("news_domain", 7))}
KEYWORDS = {"nsfw": ("item-13", "1994/7", "a.*c"), "spam": ("item-7", "long-title")}


#: A keyword a customer, of which some occur in paths, and a few short ones.
KEYWORD_TABLE = """select concat('item-', cast(c_custkey as {S}), '-') entry from customer union all select concat('-', cast(c_nationkey as {S}), '-') from customer
  union all select * from (values ('/7/'), ('zq'), (''), (cast(null as {S})), ('1994/7/item-1'), ('ogin/1995')) v(entry)"""


def view(spark: SparkSession, sf_dir: str, text: str) -> DataFrame:
    """A view's rows over the tables in sf_dir."""
    for name in TABLES:
        if f"from {name}" in text:
            text = text.replace(f"from {name}", f"from {{{name}}}")
    text = text.replace("{S}", "string").replace("{TS}", "date_format(l_shipdate, 'yyyyMMddHHmmss')").replace("{EPOCH}", "cast(unix_timestamp(ts) as string)")
    tables = {n: spread(spark.read.parquet(f"{sf_dir}/{n}.parquet")) for n in TABLES if f"{{{n}}}" in text}
    return spark.sql(text, **tables)


def sql(text: str) -> str:
    return text.replace("{S}", "varchar").replace("{TS}", "strftime(l_shipdate, '%Y%m%d%H%M%S')").replace("{EPOCH}", "cast(cast(epoch(ts) as bigint) as varchar)")
