"""Registered queries over reports, pages, links, observations, samples and stores, with their comparison SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import AS_PUBLISHED
from ..functions import urls
from ..operators import curated, enhance, links, observations, pages, reports, scoring
from ..sources import sinks
from ..sources.shared import shared_folder, stored
from . import url_queries as U
from .inputs import CAPTURES, OBSERVED, sql, view
from .url_queries import R, SCORED, feed, r6, reputation, rounded, scores, split_sql

NOW = "1998-12-31 00:00:00"
EDGE_PAGES = """select * from (values
 ('https://a.org/1', 200, concat('<title>A title that is long enough</title><meta name="description" content="', repeat('d', 60), '"><h1>x</h1><h2>y</h2><h3>z</h3><p>', repeat('word ', 120), '</p><img src="a" alt="b"><img src="c">')),
 ('https://a.org/2', 200, concat('<title>short</title><p>', repeat('CLICK HERE!!! ', 12), '</p><meta http-equiv="refresh" content="1"><form><input type="password"><input type="password"></form><script>alert(1)</script>')),
 ('http://a.org/3', 404, repeat('x', 200)), ('http://a.org/4', 200, 'tiny'), ('http://a.org/5', 200, cast(null as {S})),
 ('https://a.org/6', 200, concat('<meta name="robots" content="all"><link rel="canonical" href="/"><script type="application/ld+json">{}</script><meta property="og:title" content="t"><meta name="twitter:card" content="s"><a href="/c">Contact</a><a href="/p">Privacy</a><p>Copyright us</p>', repeat('<i style="display: none">h</i>', 6))),
 ('https://a.org/dir/7', 200, concat('<a href="//b.gov/x" title="t" rel="nofollow">read this page</a><a href="../up">up there now</a><a href="?q=1">query</a><a href="#f">frag</a><a href="https://bit.ly/x">fine words</a><a href="https://shop1.example.gov/y">shop one</a><a href="http://nytimes.com/n">paper</a><a href="http://c.tk/">see</a><a href="mailto:a@b">m</a><a href="http://d.com/">free money</a>', repeat(' ', 60)))
, ('https://a.org/dir/8', 200, concat('<meta content=''', repeat('e', 70), ''' name=''description''><META NAME=robots CONTENT=all><link href=/c rel=canonical><title>Tom &amp; Jerry &#39;n co</title><img src=a alt=b><img alt='''' src=c>',
  '<a href=''x.html?a=1&amp;b=2'' title=''t &lt; u''>single quoted</a><a class=z href=/bare>bare link here</a><a href="">blank one</a><a rel="me" href=''https://m.org/a>b''>odd &quot;mark&quot;</a><a name=top>no link</a><a href = "/spaced">spaced out</a>',
  '<form><input type=''password''><input name=p type=password></form>', repeat('<i style=''visibility: hidden''>h</i>', 6), repeat('x', 100)))
, ('https://a.org/dir/9', 200, concat('<TITLE>Un&#x63;losed &eacute;&#233; &#128512; &unknown; &amp;lt; &#x96;</TITLE><p>', repeat('one ', 60), '<p>', repeat('two&nbsp;', 45), '<div><p>three<b>four</div>five</p><img alt="a > b" src=x><img src="y"/><a href="/o">outer <a href="/i" title="x > y">inner</a> tail</a>',
  '<a href="/open" rel=nofollow>never closed <p/>', '<script>document.write("<a href=''/no''>no</a> contact about")</script><!-- <a href="/c">c</a> terms --><p>Contact</p>&copy; us</p></q> 1 < 2 <form action="?a>b"><input type=password></form><form><p><input type="PASSWORD"><div><input type=password></form> <i>Terms'))
, ('https://a.org/dir/10', 200, concat('<h1>a</h1><h2 class="x>y">b</h2><H3>c</H3><p>', repeat('w ', 100), '</p><style>p{}</style><a name=x>no</a><a href>none</a>', repeat('<a href=z>z</a>', 4), '<meta name="a" content="og:x"><meta content=">" property="og:y"><span style="color: red">', repeat('y', 40)))
) e(url, status_code, html)"""


def observed_pages(spark, sf_dir) -> DataFrame:
    own = spark.read.parquet(f"{sf_dir}/pages.parquet").select("url", F.lit(200).alias("status_code"), "html")
    return own.union(view(spark, sf_dir, EDGE_PAGES))


def requests(spark, sf_dir) -> DataFrame:
    return view(spark, sf_dir, OBSERVED)


def archive(spark, sf_dir) -> DataFrame:
    return observations.archive_metrics(view(spark, sf_dir, CAPTURES), F.lit(NOW).cast("timestamp"))


def summary_overall(spark, sf_dir):
    return rounded(reports.overall(scores(spark, sf_dir)))


def summary_by_source(spark, sf_dir):
    return rounded(reports.by_source(scores(spark, sf_dir)))


def curated_benchmark(spark, sf_dir):
    return rounded(reports.curated_benchmark(scores(spark, sf_dir)))


def score_lift(spark, sf_dir):
    rows = scores(spark, sf_dir).select("url", "domain", F.round("score", 9).alias("score"), "confidence", "data_source")
    return rounded(reports.lift(stored(rows)))


def summary_report(spark, sf_dir):
    """All report sections as one table."""
    rows = stored(scores(spark, sf_dir).select("url", "domain", F.round("score", 9).alias("score"), "confidence", "is_spam", "data_source"))
    return rounded(reports.summary(rows))


def summary_by_model(spark, sf_dir):
    """The scores of two profiles, written as one tree with a folder a model, read back and summed up by model."""
    path = shared_folder(spark, "models")
    both = _both(spark, sf_dir)
    named = lambda x, name: F.struct("url", F.col(f"score_{x}").alias("score"), F.col(f"confidence_{x}").alias("confidence"), F.col(f"spam_{x}").alias("is_spam"), F.lit(name).alias("model_name"))
    sinks.write_parquet(both.select(F.inline(F.array(named("a", "documented"), named("b", "as_published")))), path, by_model=True)
    return rounded(reports.overall(spark.read.parquet(path), "model_name"))


def top_curated_domains(spark, sf_dir):
    return rounded(reports.frequent_domains(scores(spark, sf_dir), curated=True))


def top_frequent_domains(spark, sf_dir):
    return rounded(reports.frequent_domains(scores(spark, sf_dir)))


def best_urls(spark, sf_dir):
    return rounded(reports.extreme_urls(scores(spark, sf_dir).withColumn("score", F.round("score", 9))))


def worst_urls(spark, sf_dir):
    return rounded(reports.extreme_urls(scores(spark, sf_dir).withColumn("score", F.round("score", 9)), best=False))


def _both(spark, sf_dir) -> DataFrame:
    """The verdicts of both profiles, of features that are derived once."""
    names = {"score": "score_{}", "is_spam": "spam_{}", "confidence": "confidence_{}"}
    rows = scoring.with_reputation(scoring.anomalies(scoring.featured(feed(spark, sf_dir))), reputation(spark, sf_dir))
    both = scoring.scored(rows).withColumnsRenamed({k: v.format("a") for k, v in names.items()})
    both = scoring.scored(both.withColumns(urls.tld_flags(F.col("domain"), AS_PUBLISHED)), AS_PUBLISHED)
    return both.withColumnsRenamed({k: v.format("b") for k, v in names.items()})


def _pairs(spark, sf_dir) -> DataFrame:
    return _both(spark, sf_dir).groupBy("url").agg(*[F.max(c).alias(c) for c in ("score_a", "score_b", "spam_a", "spam_b")])


def model_agreement(spark, sf_dir):
    return rounded(reports.agreement(stored(_pairs(spark, sf_dir).select("score_a", "score_b", "spam_a", "spam_b"))))


def model_score_diff(spark, sf_dir):
    return rounded(reports.differences(_pairs(spark, sf_dir)))


def union_dedupe_feeds(spark, sf_dir):
    own = feed(spark, sf_dir).withColumn("data_source", F.lit("input_data"))
    good = curated.clean_curated(own.filter("flag = 'A'").select("url", (F.col("timestamp") + F.expr("interval 1 day")).alias("timestamp")).union(spark.read.parquet(f"{sf_dir}/pages.parquet").select("url", F.lit("2020-01-01").cast("timestamp"))))
    return curated.union_feeds(own, good).select("url", F.unix_timestamp("timestamp").alias("epoch"), "data_source")


def _page(spark, sf_dir, *columns):
    return rounded(pages.page_features(observed_pages(spark, sf_dir)).select("url", *columns))


def content_quality(spark, sf_dir):
    return _page(spark, sf_dir, "content_quality")


def trust_signals(spark, sf_dir):
    return _page(spark, sf_dir, "content_trust")


def spam_indicators(spark, sf_dir):
    return _page(spark, sf_dir, "content_spam")


def page_facts(spark, sf_dir):
    return _page(spark, sf_dir, "has_content", "word_count", "title", "has_images", "has_forms", "content_length")


def link_extract(spark, sf_dir):
    return links.extract(observed_pages(spark, sf_dir))


def _classified(spark, sf_dir) -> DataFrame:
    return links.classify(links.extract(observed_pages(spark, sf_dir)), reputation(spark, sf_dir))


def link_classes(spark, sf_dir):
    return _classified(spark, sf_dir).select("page_url", "link_url", "text", "link_host", "source_host", "kind")


def outlink_scores(spark, sf_dir):
    return rounded(links.outlink_scores(observed_pages(spark, sf_dir), _classified(spark, sf_dir)))


def security_score(spark, sf_dir):
    headers = F.when(F.col("has_hsts"), F.create_map(F.lit("Strict-Transport-Security"), F.lit("1"), F.lit("X-Frame-Options"), F.lit("DENY"))).otherwise(F.create_map(F.lit("CONTENT-SECURITY-POLICY"), F.lit("x")))
    return rounded(requests(spark, sf_dir).select("url", observations.security_score(F.col("url"), headers).alias("security_score")))


def request_outcome(spark, sf_dir):
    return rounded(observations.outcome(requests(spark, sf_dir)).select("url", "accessible", "status_code", "response_time", "redirect_count", "error_class"))


def host_heuristic(spark, sf_dir):
    hosts = scoring.split_urls(spark.read.parquet(f"{sf_dir}/pages.parquet").select("url").union(feed(spark, sf_dir).select("url"))).select("domain").distinct()
    return rounded(hosts.select("domain", observations.host_heuristic(F.col("domain")).alias("host_score")))


def archive_metrics(spark, sf_dir):
    return rounded(archive(spark, sf_dir))


def archive_trust(spark, sf_dir):
    return rounded(observations.archive_trust(archive(spark, sf_dir)).select("url", "archive_trust"))


def sample_per_domain(spark, sf_dir):
    return enhance.sample(scores(spark, sf_dir))


def sample_three_per_domain(spark, sf_dir):
    """Up to three urls a domain, and of one more domain that holds all urls once more."""
    rows = scoring.split_urls(feed(spark, sf_dir)).select("url", "domain")
    return enhance.sample(rows.union(rows.select("url", F.lit("hot.example"))), k=3)


def captures_read(spark, sf_dir):
    """The captures of each url as an index answer, a JSON array with a header, read back; a row that is too short is in each."""
    rows = view(spark, sf_dir, CAPTURES)
    listed = F.concat(F.array(F.array(F.lit("timestamp"), F.lit("status"), F.lit("original"))), F.collect_list(F.array("ts", "status", "url")), F.array(F.array(F.lit("20200101000000"))))
    return observations.captures(rows.groupBy("url").agg(F.to_json(listed).alias("body")))


def archive_first_captures(spark, sf_dir):
    """Archive metrics of the first five captures of each url."""
    rows = view(spark, sf_dir, CAPTURES)
    return rounded(observations.archive_metrics(rows, F.lit(NOW).cast("timestamp"), max_snapshots=5))


def _enhanced(spark, sf_dir) -> DataFrame:
    """Every observed request's url, scored; its page is the page of the same number, its captures those of its shop's items."""
    asked = requests(spark, sf_dir)
    rows = scoring.score_rules(asked.select("url", F.lit(NOW).cast("timestamp").alias("timestamp")), reputation(spark, sf_dir)).select("url", "domain", "score", "confidence")
    number = F.substring_index("url", "/", -1).cast("long")
    own = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", F.lit(200).alias("status_code"), "html")
    page = asked.select("url", number.alias("page_id")).join(own, "page_id").select("url", "status_code", "html")
    history = observations.archive_metrics(view(spark, sf_dir, CAPTURES).select(F.concat(F.substring_index("url", "/item-", 1), F.lit("/o/"), F.substring_index("url", "-", -1)).alias("url"), "ts", "status"), F.lit(NOW).cast("timestamp"))
    found = links.outlink_scores(page, links.classify(links.extract(page), reputation(spark, sf_dir)))
    return enhance.enhance(rows, pages.page_features(page), found, observations.outcome(asked), history)


def enhanced_scores(spark, sf_dir):
    return rounded(_enhanced(spark, sf_dir).select("url", "score", "enhanced_score", "score_delta", "enhanced_confidence"))


def enhanced_batch(spark, sf_dir):
    """Scored urls, of which one a domain has its enhanced score and confidence in place of the plain ones."""
    found = stored(_enhanced(spark, sf_dir))
    rows = found.select("url", "domain", "score", "confidence", urls.fingerprint(F.col("url")).alias("url_hash"))
    better = found.join(enhance.sample(rows).select("url"), "url", "left_semi")
    return rounded(enhance.merge_enhanced(rows, better).select("url", "domain", "score", "confidence"))


def domain_volatility(spark, sf_dir):
    """Etags and times of change count."""
    return rounded(enhance.volatility(_enhanced(spark, sf_dir)))


def store_rows(spark, sf_dir):
    out = sinks.store_rows(scores(spark, sf_dir), "2024-01-01 00:00:00")
    return out.select("url", "source", "status", F.round("score", 6).alias("score"), F.get_json_object("meta", "$.domain").alias("meta_domain"), F.get_json_object("meta", "$.is_spam").alias("meta_spam"))


def insert_if_absent(spark, sf_dir):
    rows = sinks.store_rows(scores(spark, sf_dir), "2024-01-01 00:00:00").select("url", *sinks.KEY, "score")
    return sinks.absent(rows, rows.filter("source = 'good_data'")).select("url", "source")


NAMES = ["summary_overall", "summary_by_source", "curated_benchmark", "score_lift", "summary_report", "summary_by_model", "top_curated_domains", "top_frequent_domains", "best_urls", "worst_urls", "model_agreement", "model_score_diff", "union_dedupe_feeds", "content_quality", "trust_signals", "spam_indicators", "page_facts", "link_extract", "link_classes", "outlink_scores", "security_score", "request_outcome", "host_heuristic", "archive_metrics", "archive_trust", "sample_per_domain", "sample_three_per_domain", "archive_first_captures", "captures_read", "enhanced_scores", "enhanced_batch", "domain_volatility", "store_rows", "insert_if_absent"]
QUERIES = {name: globals()[name] for name in NAMES}

# ---- the same in SQL ----

#: Patterns of the comparison, written apart from the library's, for an engine with another kind of expressions.
QUOTE = """["'']"""
VALUE = r"""("[^"]*"|''[^'']*''|[^\s"''>]+)"""
INSIDE = """(?:[^>"'']|"[^"]*"|''[^'']*'')*"""
TOKEN = rf"(?is)<!--.*?-->|<script\b{INSIDE}>.*?</script\s*>|<style\b{INSIDE}>.*?</style\s*>|</?[a-z]{INSIDE}>|<[!?][^>]*>|[^<]+|<"
HEAD = rf"(?is)^<[a-z][^\s/>]*{INSIDE}>"


def decoded(text: str) -> str:
    """Entities decoded: those that the pages hold."""
    for name, char in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&apos;", "''"), ("&nbsp;", "\u00a0"), ("&copy;", "©"), ("&#39;", "''"), ("&#x63;", "c"), ("&eacute;", "é"), ("&#233;", "é"), ("&#128512;", "\U0001f600"), ("&#x96;", "–"), ("&amp;", "&")):
        text = f"replace({text}, '{name}', '{char}')"
    return text


def attr_sql(tag: str, name: str) -> str:
    """An attribute of a tag, looked for outside the values of others: these are blanked unless they belong to it."""
    own = rf"""regexp_extract({tag}, '(?is)^<(?:[^>"'']|"[^"]*"|''[^'']*'')*?\s{name}\s*=\s*{VALUE}', 1)"""
    return decoded(f"(case when regexp_matches({own}, '^{QUOTE}') then substr({own}, 2, length({own}) - 2) else {own} end)")


def count(text: str, pattern: str) -> str:
    return f"len(regexp_extract_all({text}, '{pattern}'))"


def words_sql(text: str) -> str:
    return count(text, r"[^\s\x{00a0}]+")


def markup_sql(source: str) -> str:
    """CTEs of the pages of source (url, status_code, html): pg with their tokens, tg with their tags, sp with the extents of titles,
    paragraphs, anchors and forms. Tags are taken one by one by recursion, with the open elements as a list."""
    return rf"""pg as materialized (select row_number() over () k, url, status_code, coalesce(html, '') html, html is not null and status_code = 200 there, regexp_extract_all(coalesce(html, ''), '{TOKEN}') t from {source}),
tg as materialized (select *, row_number() over (partition by k order by i) j from (select k, i, t[i] tag, lower(regexp_extract(t[i], '^</?([a-zA-Z][^\s/>]*)', 1)) tname, starts_with(t[i], '</') ends from (select k, t, unnest(range(1, len(t) + 1)) i from pg)) where starts_with(tag, '<') and tname <> ''),
fo as materialized (select *, row_number() over (partition by k order by i) n from tg where tname not in ('area', 'base', 'br', 'col', 'embed', 'hr', 'img', 'input', 'link', 'meta', 'param', 'source', 'track', 'wbr', 'script', 'style')),
fold(k, n, stack, done) as (select k, cast(0 as bigint), cast([] as struct(nm varchar, a bigint)[]), cast([] as struct(nm varchar, a bigint, e bigint)[]) from pg union all
  select k, n, case when not ends and not single then list_append(stack, {{'nm': tname, 'a': i}}) when ends then stack[1 : keep] else stack end,
    case when ends then list_concat(done, list_transform(stack[keep + 1 :], lambda x: {{'nm': x.nm, 'a': x.a, 'e': i}})) when single then list_append(done, {{'nm': tname, 'a': i, 'e': i + 1}}) else done end
  from (select fo.k, fo.n, stack, done, tname, i, ends, tag like '%/>' single, case when list_contains(list_transform(stack, lambda x: x.nm), tname) then len(stack) - list_position(list_reverse(list_transform(stack, lambda x: x.nm)), tname) else len(stack) end keep
    from fold join fo on fo.k = fold.k and fo.n = fold.n + 1)),
en_ as (select k, arg_max(stack, n) stack, arg_max(done, n) done from fold group by k),
sp as materialized (select k, url, x.nm nm, x.a a, x.e e, t[x.a] tag, array_to_string(list_transform(list_filter(t[x.a : x.e - 1], lambda y: not starts_with(y, '<') or y = '<'), lambda y: {decoded('y')}), '') txt
  from (select k, unnest(list_concat(done, list_transform(stack, lambda x: {{'nm': x.nm, 'a': x.a, 'e': cast(len(t) + 1 as bigint)}}))) x from en_ join pg using (k)) join pg using (k) where x.nm in ('title', 'p', 'a', 'form'))"""


PAGES = f"obs as (select url, 200 status_code, html from pages union all {sql(EDGE_PAGES)})"
PHRASES = " + ".join(f"cast(contains(lower(html), '{p}') as int)" for p in pages.SPAM_PHRASES)


def facts_sql() -> str:
    """CTE pf: page features, from the CTEs of markup_sql."""
    when = lambda c, w: f"case when {c} then {w} else 0 end"
    n = lambda c: f"count(*) filter (not ends and {c})"
    has = lambda tag, name, value: n(f"tname = '{tag}' and lower({attr_sql('tag', name)}) = '{value}'")
    said = lambda p: f"len(list_filter(plain, lambda y: regexp_matches(y, '{p}')))"
    return f"""tx as (select *, list_transform(list_filter(t, lambda y: not starts_with(y, '<') or y = '<'), lambda y: {decoded('y')}) plain from pg),
tc as (select k, {n("tname in ('h1', 'h2', 'h3')")} hn, {n("tname = 'img'")} imgs, count(*) filter (not ends and tname = 'img' and {attr_sql('tag', 'alt')} <> '') alts, {n(f"tname = 'a' and regexp_matches(tag, '(?is)^<(?:[^>{chr(34)}'']|{chr(34)}[^{chr(34)}]*{chr(34)}|''[^'']*'')*?\\shref\\s*=')")} ln,
  {n("tname = 'form'")} fm, {has('meta', 'name', 'robots')} robots, {has('link', 'rel', 'canonical')} canon, {has('script', 'type', 'application/ld+json')} ld, {n(f"tname = 'meta' and contains(lower({attr_sql('tag', 'property')}), 'og:')")} og, {has('meta', 'name', 'twitter:card')} tw,
  {has('meta', 'http-equiv', 'refresh')} refresh, {n(f"tname = 'script' and regexp_matches(regexp_replace(tag, '{HEAD}', ''), '(?is)alert|popup|window[.]open')")} pop, {n(f"regexp_matches({attr_sql('tag', 'style')}, '(?i)display:\\s*none|visibility:\\s*hidden')")} hid,
  arg_min(trim({attr_sql('tag', 'content')}), i) filter (not ends and tname = 'meta' and lower({attr_sql('tag', 'name')}) = 'description') about from tg group by k),
pw as (select k, i from tg where not ends and tname = 'input' and lower({attr_sql('tag', 'type')}) = 'password'),
fp as (select k, count(*) bad from (select sp.k, sp.a, count(*) c from sp join pw on pw.k = sp.k and pw.i between sp.a and sp.e where nm = 'form' group by sp.k, sp.a) where c > 1 group by k),
sc as (select k, {words_sql("string_agg(txt, ' ') filter (nm = 'p')")} wn, arg_min(trim(txt), a) filter (nm = 'title') title from sp group by k),
p1 as (select tx.*, tc.*, coalesce(wn, 0) wn, coalesce(title, '') title, length(coalesce(title, '')) tl, coalesce(length(about), 0) dl, coalesce(bad, 0) bad, there and length(html) >= 100 whole, {count('html', '!')} marks from tx left join tc using (k) left join sc using (k) left join fp using (k)),
pf as (select url, whole has_content, case when whole then least(1.0, case when tl between 10 and 60 then 0.2 when tl > 60 then 0.1 else 0 end + case when dl between 50 and 160 then 0.2 when dl > 160 then 0.1 else 0 end
    + {when('hn >= 1', 0.1)} + {when('hn >= 3', 0.1)} + case when wn >= 300 then 0.2 when wn >= 100 then 0.1 else 0 end + case when imgs > 0 then alts / imgs * 0.1 else 0 end + {when('ln >= 5', 0.1)}) else 0 end content_quality,
  case when whole then least(1.0, {when('robots > 0', 0.1)} + {when('canon > 0', 0.1)} + {when('ld > 0', 0.2)} + {when('og > 0', 0.1)} + {when('tw > 0', 0.1)}
    + {when("contains(lower(url), 'https://')", 0.2)} + {when(f"{said('(?i)contact|about|privacy|terms')} >= 2", 0.1)} + {when(f"{said('(?i)copyright|©|[(]c[)]')} > 0", 0.1)}) else 0 end content_trust,
  case when whole then least(1.0, least(({PHRASES}) * 0.1, 0.5) + least({count('html', '[A-Z]{5,}')} * 0.02, 0.3) + case when marks > 10 then least(marks * 0.01, 0.2) else 0 end + {when('pop > 0', 0.2)} + {when('refresh > 0', 0.3)}
    + {when('hid > 5', 0.2)} + bad * 0.2) when there then 0.5 else 1.0 end content_spam,
  case when whole then {words_sql("array_to_string(plain, '')")} else 0 end word_count, case when whole then title else '' end title, whole and coalesce(imgs, 0) > 0 has_images,
  whole and coalesce(fm, 0) > 0 has_forms, case when whole then length(html) else 0 end content_length from p1)"""


def links_sql() -> str:
    """CTEs up to cl: classified links, from the CTEs of markup_sql."""

    local = "case when starts_with(href, '/') then href else case when folder = '' then '/' else folder end || href end"
    dots = f"""case when contains({local}, '/./') or contains({local}, '/../') then regexp_replace(regexp_replace({local}, '/\\./', '/', 'g'), '[^/]+/\\.\\./', '', 'g') else {local} end"""
    among = lambda names: "(" + " or ".join(f"link_host = '{x}' or ends_with(link_host, '.{x}')" for x in names) + ")"
    says = lambda c: "(" + " or ".join(f"contains(lower({c}), '{p}')" for p in links.PHRASES) + ")"
    pattern = r"^(?:[a-z]+:)?//([^/?#:]+)([^?#]*)(?:\?([^#]*))?.*$"
    return f"""a1 as (select url page_url, tag head, trim(txt) text from sp where nm = 'a'),
a2 as (select *, trim({attr_sql('head', 'href')}) href, {attr_sql('head', 'title')} title, {attr_sql('head', 'rel')} rel, regexp_extract(page_url, '^[a-z]+://[^/?#]+') origin, regexp_extract(page_url, '^[^?#]*') base, regexp_extract(regexp_extract(page_url, '^[^?#]*'), '^[a-z]+://[^/?#]+(.*/)', 1) folder from a1),
ex as (select page_url, case when regexp_matches(href, '^[a-zA-Z][a-zA-Z0-9+.-]*:') then href when starts_with(href, '//') then string_split(page_url, '//')[1] || href when href = '' then page_url
  when starts_with(href, '#') then regexp_extract(page_url, '^[^#]*') || href when starts_with(href, '?') then base || href else origin || {dots} end link_url, text, title, rel from a2 where href <> ''),
l0 as (select * from ex where regexp_matches(lower(link_url), '^https?://')),
l1 as (select *, coalesce(nullif(regexp_extract(lower(link_url), '{pattern}', 1), ''), 'unknown.invalid') link_host, coalesce(nullif(regexp_extract(lower(page_url), '{pattern}', 1), ''), 'unknown.invalid') source_host from l0),
cl as (select l1.*, case when rep >= 0.3 then 'quality' when rep < -0.5 then 'spam' when rep < -0.1 then 'suspicious' when {among(links.SHORTENERS)} or {says('text')} or {says('title')} then 'spam' when {among(links.NEWS)} then 'news'
  when link_host = source_host then 'internal' when regexp_matches(link_host, '\\.(edu|gov|org)$') then 'quality' when regexp_matches(link_host, '\\.(tk|ml|ga|cf|gq)$') then 'suspicious'
  when length(text) < 3 or lower(text) in ('click', 'here', 'link', 'more', 'read') then 'low_quality' when regexp_matches(link_host, '[^\\w\\s.À-ɏ-]') then 'suspicious' else 'neutral' end kind
  from l1 left join (select domain link_host, reputation_score rep from ({R})) using (link_host))"""


def outlinks_sql(source: str) -> str:
    c = lambda *ks: "count(*) filter (kind in (" + ", ".join(f"'{k}'" for k in ks) + "))"
    each = ", ".join(f"{c(k)} n_{k}" for k in links.KINDS)
    return f"""o0 as (select page_url url, count(*) total, count(*) filter (link_host <> source_host) as "external", count(distinct link_host) hosts, {each} from cl group by page_url),
o1 as (select u.url, coalesce(total, 0) total, coalesce("external", 0) as "external", coalesce(hosts, 0) hosts, {", ".join(f"coalesce(n_{k}, 0) n_{k}" for k in links.KINDS)} from (select distinct url from {source}) u left join o0 using (url)),
ol as (select url, total, "external", total - "external" internal, hosts, case when total > 0 then (n_quality + n_news) / total else 0 end quality_ratio, case when total > 0 then (n_spam + n_suspicious + n_low_quality) / total else 0 end spam_ratio,
  case when total > 0 then least(hosts / total, 1.0) else 0 end diversity, case when total > 0 then "external" / total else 0 end external_ratio,
  case when total > 0 then greatest(0, least(1, 0.4 * quality_ratio + 0.2 * diversity + 0.2 * external_ratio - 0.5 * n_spam / total - 0.3 * (n_suspicious + n_low_quality) / total)) else 0 end trust from o1)"""


def archive_sql(source: str) -> str:
    t = "epoch(try_strptime(ts, '%Y%m%d%H%M%S'))"
    days = lambda x: f"cast(coalesce(floor((epoch(timestamp '{NOW}') - {x}) / 86400), -1) as bigint)"
    return f"""m0 as (select url, count(*) archive_count, count(*) filter (starts_with(status, '2')) successful, count(*) filter (not starts_with(status, '2')) failed, min({t}) f, max({t}) l, count({t}) times from ({source}) group by url),
m as (select url, archive_count, successful, failed, {days('f')} days_since_first, {days('l')} days_since_last, case when {days('f')} > 0 then times / {days('f')} else 0 end per_day, l is not null archived from m0)"""


OUT = f"oc as (select *, error_type is null accessible, case when error_type is null then null when error_type in ('ssl', 'connection', 'timeout') then error_type else 'unknown' end error_class from ({sql(OBSERVED)}))"
OUT2 = "oo as (select url, accessible, case when accessible then status_code else 0 end status_code, case when error_class = 'timeout' then 10.0 when not accessible then 0.0 else response_time end response_time, case when accessible then redirect_count else 0 end redirect_count, error_class, etag, last_modified from oc)"
C = sql(CAPTURES)
ENHANCED = f"""with recursive {OUT}, {OUT2}, src as (select url, timestamp '{NOW}' as timestamp from oc), {split_sql('src')}, {U.scored_sql(R)},
page as (select oc.url url, 200 status_code, html from oc join pages on page_id = cast(string_split(oc.url, '/')[-1] as bigint)), {markup_sql('page')}, {facts_sql()}, {links_sql()}, {outlinks_sql('page')},
{archive_sql(f"select string_split(url, '/item-')[1] || '/o/' || string_split(url, '-')[-1] url, ts, status from ({C})")},
en as (select scored.url, scored.domain, oo.etag, oo.last_modified, score, confidence, score
  + case when accessible and status_code = 200 and has_content then content_quality * 0.3 + content_trust * 0.2 - content_spam * 0.4 else 0 end + case when accessible and status_code = 200 and total > 0 then quality_ratio * 0.15 - spam_ratio * 0.25 else 0 end
  + case when not accessible then -0.5 else case when status_code = 200 then 0.1 when status_code >= 400 then -0.3 else 0 end - case when redirect_count > 3 then 0.1 else 0 end - case when response_time > 5 then 0.05 else 0 end end
  + case when archived then case when days_since_last between 0 and 29 then 0.1 when days_since_last > 365 then -0.1 else 0 end + least(archive_count / 100, 0.2) else -0.2 end enhanced_score,
  least(confidence + 0.1 * (cast(accessible and status_code = 200 and coalesce(has_content, false) as int) + cast(accessible and status_code = 200 and coalesce(total, 0) > 0 as int) + cast(accessible as int) + cast(coalesce(archived, false) as int)), 1.0) enhanced_confidence
  from scored join oo using (url) left join pf using (url) left join ol using (url) left join m using (url))"""
PUBLISHED = f"with {U.SPLIT_L}, {U.PUBLISHED}, {{rest}}"
PAIRS = f"""pub as materialized (with {U.SPLIT_L}, {U.PUBLISHED} select url, score score_b, is_spam spam_b, confidence confidence_b from scored), own as materialized (with {SCORED} select url, score score_a, is_spam spam_a, confidence confidence_a from scores), pairs as (select * from own join pub using (url))"""
TOP = "select url, round(round(score, 9), 6) score, round(confidence, 6) confidence, domain, data_source from scores order by round(score, 9) {}, url limit 10"


def section_sql(name: str, table: str, numbers: list[str], texts: list[str], order: str = "1") -> str:
    """A report table as rows of (section, rank, metric, value, text)."""
    cells = [f"""{{'metric': '{c}', 'value': cast("{c}" as double), 'text': null}}""" for c in numbers] + [f"""{{'metric': '{c}', 'value': null, 'text': "{c}"}}""" for c in texts]
    return f"select '{name}' section, cast(rank_ as int) rank, cell.metric metric, cell.value as value, cell.text as text from (select rank_, unnest([{', '.join(cells)}]) cell from (select *, row_number() over (order by {order}) rank_ from ({table})))"


ORACLE_SQL = {
    "summary_overall": f"""with {SCORED} select count(*) total, count(distinct url) distinct_urls, count(*) filter (is_spam) spam, count(*) filter (not is_spam) not_spam, round(avg(score), 6) avg_score, round(avg(confidence), 6) avg_confidence,
round(stddev(score), 6) score_stddev, round(quantile_disc(score, 0.5), 6) p50, round(quantile_disc(score, 0.75), 6) p75, round(quantile_disc(score, 0.95), 6) p95 from scores""",
    "summary_by_source": f"with {SCORED} select data_source, count(*) urls, round(avg(score), 6) avg_score, count(*) filter (is_spam) spam from scores group by data_source",
    "curated_benchmark": f"""with {SCORED} select count(*) filter (data_source = 'good_data') curated, round(curated / count(*), 6) share, round(quantile_disc(score, 0.75) filter (data_source = 'good_data'), 6) p75, round(quantile_disc(score, 0.95) filter (data_source = 'good_data'), 6) p95,
round(count(*) filter (data_source = 'good_data' and is_spam) / curated, 6) spam_rate, round(1 - count(*) filter (data_source = 'good_data' and is_spam) / curated, 6) clean_rate from scores""",
    "score_lift": f"""with {SCORED}, s9 as (select url, data_source, round(score, 9) score from scores), x as (select avg(score) filter (data_source = 'good_data') c, avg(score) filter (data_source <> 'good_data') i from s9),
t as (select count(*) filter (data_source = 'good_data') n from (select * from s9 order by score desc, url limit 10)), b as (select count(*) filter (data_source = 'good_data') n from (select * from s9 order by score, url limit 10))
select round(c, 6) curated_avg, round(i, 6) input_avg, round(c - i, 6) lift, round(case when i > 0 then (c - i) / i * 100 end, 6) lift_percent, t.n in_top, b.n in_bottom, case when c - i > 0.5 then 'EXCELLENT' when c - i > 0.2 then 'GOOD' when c - i > 0 then 'FAIR' else 'POOR' end grade from x, t, b""",
    "top_frequent_domains": f"with {SCORED} select domain, count(*) urls, round(count(*) / (select count(*) from scores), 6) share from scores group by domain order by urls desc, domain limit 10",
    "top_curated_domains": f"with {SCORED}, good as (select * from scores where data_source = 'good_data') select domain, count(*) urls, round(count(*) / (select count(*) from good), 6) share from good group by domain order by urls desc, domain limit 10",
    "summary_by_model": f"""with {PAIRS}, both_ as (select url, score_a score, spam_a is_spam, confidence_a confidence, 'documented' model_name from own union all select url, score_b, spam_b, confidence_b, 'as_published' from pub)
select model_name, count(*) total, count(distinct url) distinct_urls, count(*) filter (is_spam) spam, count(*) filter (not is_spam) not_spam, round(avg(score), 6) avg_score, round(avg(confidence), 6) avg_confidence,
round(stddev(score), 6) score_stddev, round(quantile_disc(score, 0.5), 6) p50, round(quantile_disc(score, 0.75), 6) p75, round(quantile_disc(score, 0.95), 6) p95 from both_ group by model_name""",
    "best_urls": f"with {SCORED} {TOP.format('desc')}",
    "worst_urls": f"with {SCORED} {TOP.format('asc')}",
    "model_agreement": f"with {PAIRS}, st as (select corr(score_a, score_b) c, avg(cast(spam_a = spam_b as double)) g from pairs) select spam_a, spam_b, count(*) urls, round(any_value(c), 6) correlation, round(any_value(g), 6) agreement from pairs, st group by spam_a, spam_b",
    "model_score_diff": f"with {PAIRS} select url, {r6('score_a', 'score_b')}, round(round(abs(score_a - score_b), 9), 6) gap from pairs order by round(abs(score_a - score_b), 9) desc, url limit 10",
    "union_dedupe_feeds": f"""with {U.L}, good as (select url, min(t) t from (select url, timestamp + interval 1 day t from src where flag = 'A' union all select url, timestamp '2020-01-01' from pages) where trim(url) <> '' group by url),
own as (select url, min(timestamp) t from src group by url) select coalesce(good.url, own.url) url, cast(epoch(coalesce(good.t, own.t)) as bigint) epoch, case when good.url is not null then 'good_data' else 'input_data' end data_source from own full join good on own.url = good.url""",
    "content_quality": f"with recursive {PAGES}, {markup_sql('obs')}, {facts_sql()} select url, {r6('content_quality')} from pf",
    "trust_signals": f"with recursive {PAGES}, {markup_sql('obs')}, {facts_sql()} select url, {r6('content_trust')} from pf",
    "spam_indicators": f"with recursive {PAGES}, {markup_sql('obs')}, {facts_sql()} select url, {r6('content_spam')} from pf",
    "page_facts": f"with recursive {PAGES}, {markup_sql('obs')}, {facts_sql()} select url, has_content, word_count, title, has_images, has_forms, content_length from pf",
    "link_extract": f"with recursive {PAGES}, {markup_sql('obs')}, {links_sql()} select page_url, link_url, text, title, rel from l0",
    "link_classes": f"with recursive {PAGES}, {markup_sql('obs')}, {links_sql()} select page_url, link_url, text, link_host, source_host, kind from cl",
    "outlink_scores": f"""with recursive {PAGES}, {markup_sql('obs')}, {links_sql()}, {outlinks_sql('obs')} select url, total, "external", internal, hosts, {r6('quality_ratio', 'spam_ratio', 'diversity', 'external_ratio', 'trust')} from ol""",
    "security_score": f"select url, round(0.3 + case when has_hsts then 0.3 else 0.2 end, 6) security_score from ({sql(OBSERVED)})",
    "request_outcome": f"with {OUT}, {OUT2} select url, accessible, status_code, round(response_time, 6) response_time, redirect_count, error_class from oo",
    "host_heuristic": f"""with {U.L}, u as (select url from pages union all select url from src), {split_sql('u')} select distinct domain, case when string_split(domain, '.')[-1] in ('tk', 'ml', 'ga', 'cf', 'gq', 'pw', 'top') then 0.1
when len(string_split(domain, '.')) > 2 and not regexp_matches(domain, '^(www|blog|news|support)\\.') then 0.3 else 0.5 end host_score from s""",
    "archive_metrics": f"with {archive_sql(C)} select url, archive_count, successful, failed, days_since_first, days_since_last, {r6('per_day')}, archived from m",
    "archive_trust": f"""with {archive_sql(C)} select url, round(case when archived then least(1.0, case when archive_count >= 50 then 0.3 when archive_count >= 20 then 0.2 when archive_count >= 5 then 0.1 else 0 end
+ case when days_since_last <= 30 then 0.2 when days_since_last <= 90 then 0.15 when days_since_last <= 365 then 0.1 when days_since_last <= 1095 then 0.05 else 0 end
+ case when days_since_first >= 1095 then 0.2 when days_since_first >= 365 then 0.15 when days_since_first >= 180 then 0.1 else 0 end + successful / archive_count * 0.2 + case when per_day > 0.1 then 0.1 when per_day > 0.01 then 0.05 else 0 end) else 0 end, 6) archive_trust from m""",
    "sample_per_domain": f"with {SCORED}, x as (select domain, url, md5(url || '42') h, row_number() over (partition by domain order by md5(url || '42'), url) n from scores) select domain, url from x where n = 1 order by h limit 6500",
    "sample_three_per_domain": f"with {U.SPLIT_L}, b as (select distinct url, domain from s union select distinct url, 'hot.example' from s), x as (select *, md5(url || '42') h, row_number() over (partition by domain order by md5(url || '42'), url) n from b) select domain, url from x where n <= 3 order by h limit 6500",
    "captures_read": f"select url, ts, status from ({C})",
    "archive_first_captures": f"with {archive_sql(f'select url, ts, status from ({C}) qualify row_number() over (partition by url order by ts, status) <= 5')} select url, archive_count, successful, failed, days_since_first, days_since_last, {r6('per_day')}, archived from m",
    "enhanced_scores": f"{ENHANCED} select url, {r6('score', 'enhanced_score')}, round(enhanced_score - score, 6) score_delta, {r6('enhanced_confidence')} from en",
    "enhanced_batch": f"""{ENHANCED}, best as (select domain, min_by(url, md5(url || '42')) url, min(md5(url || '42')) h from en group by domain order by h limit 6500)
select en.url, en.domain, round(case when best.url is not null then enhanced_score else score end, 6) score, round(case when best.url is not null then enhanced_confidence else confidence end, 6) confidence from en left join best on en.url = best.url""",
    "domain_volatility": f"""{ENHANCED}, v as (select domain, avg(enhanced_score - score) mean_delta, count(*) urls, (count(distinct etag) + count(distinct last_modified)) / count(*) volatility from en group by domain)
select domain, {r6('mean_delta')}, urls, {r6('volatility')}, cast(floor(greatest(1, 720 * (1 - least(volatility, 2) / 2))) as int) revisit_hours from v""",
    "store_rows": f"with {SCORED} select url, data_source source, 'processed' status, {r6('score')}, domain meta_domain, cast(is_spam as varchar) meta_spam from scores",
    "insert_if_absent": f"with {SCORED} select distinct url, data_source source from scores where data_source <> 'good_data'",
}
SHOWN = ["score", "confidence"]
ORACLE_SQL["summary_report"] = " union all ".join([
    section_sql("overall", ORACLE_SQL["summary_overall"], ["total", "distinct_urls", "spam", "not_spam", "avg_score", "avg_confidence", "score_stddev", "p50", "p75", "p95"], []),
    section_sql("by_source", ORACLE_SQL["summary_by_source"], ["urls", "avg_score", "spam"], ["data_source"], "data_source"),
    section_sql("curated_benchmark", ORACLE_SQL["curated_benchmark"], ["curated", "share", "p75", "p95", "spam_rate", "clean_rate"], []),
    section_sql("lift", ORACLE_SQL["score_lift"], ["curated_avg", "input_avg", "lift", "lift_percent", "in_top", "in_bottom"], ["grade"]),
    section_sql("best_urls", ORACLE_SQL["best_urls"], SHOWN, ["url", "domain", "data_source"], "score desc, url"),
    section_sql("worst_urls", ORACLE_SQL["worst_urls"], SHOWN, ["url", "domain", "data_source"], "score, url"),
    section_sql("frequent_domains", ORACLE_SQL["top_frequent_domains"], ["urls", "share"], ["domain"], "urls desc, domain"),
    section_sql("frequent_curated_domains", ORACLE_SQL["top_curated_domains"], ["urls", "share"], ["domain"], "urls desc, domain"),
])
