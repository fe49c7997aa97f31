"""Registered queries over URLs, scores and domains, with the SQL that they are compared with."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import AS_PUBLISHED
from ..functions import urls
from ..operators import domains, scoring, sketches
from ..sources.shared import stored
from .inputs import EDGES, FEED, HOSTS, KEYWORDS, KEYWORD_TABLE, REPUTATION, URLS, sql, view

NUMBERS = 6
PUBLIC = ["url", "domain", "score", "confidence", "is_spam", "risk_score", "trust_score", "composite_score", "url_hash", "domain_reputation_score"]


def rounded(df: DataFrame) -> DataFrame:
    return df.select([F.round(c, NUMBERS).alias(c) if kind == "double" else F.col(c) for c, kind in df.dtypes])


def feed(spark, sf_dir) -> DataFrame:
    return view(spark, sf_dir, URLS).select("url", F.col("ts").cast("timestamp").alias("timestamp"), "flag")


def reputation(spark, sf_dir) -> DataFrame:
    return view(spark, sf_dir, REPUTATION)


def scores(spark, sf_dir) -> DataFrame:
    return scoring.score_rules(feed(spark, sf_dir), reputation(spark, sf_dir)).withColumn("data_source", F.when(F.col("flag") == "A", "good_data").otherwise("input_data"))


def host_lists(spark, sf_dir) -> dict[str, DataFrame]:
    return {name: view(spark, sf_dir, text) for name, text in HOSTS.items()}


def feed_normalise(spark, sf_dir):
    rows = scoring.normalise_feed(view(spark, sf_dir, FEED))
    return rows.select("url", F.unix_timestamp("timestamp").alias("epoch"), "data_source")


def pages_and_edges(spark, sf_dir) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("url")
    return pages.union(scoring.normalise_feed(view(spark, sf_dir, EDGES)).select("url"))


def url_split(spark, sf_dir):
    return scoring.split_urls(pages_and_edges(spark, sf_dir)).select("url", "domain", "path", "query", "segment1", "segment2")


FLAGS = ["very_short_url", "very_long_url", "no_scheme", "suspicious_tld", "trustworthy_tld", "has_ip_address", "is_url_shortener", "suspicious_chars_path", "excessive_params", "domain_is_numeric_heavy", "domain_hyphen_heavy", "domain_entropy", "path_entropy", "vowel_consonant_ratio", "is_malformed_url", "path_depth", "is_root_page", "is_ugc_path", "path_has_article_slug", "path_has_date", "path_is_descriptive", "contains_download", "contains_phishing", "contains_financial", "contains_urgency", "is_media_or_api", "path_contains_sensitive", "path_keyword_stuffing", "excessive_subdomains", "excessive_encoding", "long_query", "short_domain", "very_long_domain", "has_invalid_timestamp", "is_nsfw_content", "is_spam_content", "is_nsfw_domain", "is_quality_domain", "is_news_domain"]


def url_features_rules(spark, sf_dir):
    rows = scoring.featured(feed(spark, sf_dir), lists=host_lists(spark, sf_dir), nsfw=KEYWORDS["nsfw"], spam=KEYWORDS["spam"])
    return rounded(rows.select("url", *FLAGS))


def host_entropy(spark, sf_dir):
    hosts = scoring.split_urls(spark.read.parquet(f"{sf_dir}/pages.parquet").select("url")).select("domain").distinct()
    return rounded(hosts.select("domain", urls.entropy(F.col("domain")).alias("entropy")))


def url_anomalies(spark, sf_dir):
    return scoring.anomalies(scoring.split_urls(feed(spark, sf_dir))).select("url", "length_anomaly", "param_anomaly")


def score_rules(spark, sf_dir):
    return rounded(scores(spark, sf_dir).select(*PUBLIC))


def score_with_lists(spark, sf_dir):
    """Scores with host lists and keywords."""
    rows = scoring.score_rules(feed(spark, sf_dir), reputation(spark, sf_dir), lists=host_lists(spark, sf_dir), nsfw=KEYWORDS["nsfw"], spam=KEYWORDS["spam"])
    return rounded(rows.select(*PUBLIC))


def keyword_index(spark, sf_dir):
    """Keyword flags from a table of keywords that grows with the customers, short ones among them."""
    words = view(spark, sf_dir, KEYWORD_TABLE)
    return scoring.featured(feed(spark, sf_dir), nsfw=words, spam=words.filter("length(entry) < 8")).select("url", "is_nsfw_content", "is_spam_content")


def domain_sketches(spark, sf_dir):
    """Partial statistics of the feed's three parts, merged: exact sums, and whether the estimates are as near to the exact
    values as they should be."""
    rows = stored(scores(spark, sf_dir).select("url", "domain", "segment1", "segment2", "score", "is_spam", "flag"))
    parts = None
    for flag in ("A", "N", "R"):
        part = sketches.partial(rows.filter(F.col("flag") == flag))
        parts = part if parts is None else parts.unionByName(part)
    found = sketches.read(sketches.merged(parts))
    exact = rows.groupBy("domain").agg(*[F.count_distinct(c).alias(f"exact_{c}") for c in sketches.DISTINCT], F.percentile("score", F.array(*[F.lit(p) for p in (0.5 - sketches.RANK_ERROR, 0.5 + sketches.RANK_ERROR, 0.95 - sketches.RANK_ERROR, 0.95 + sketches.RANK_ERROR)])).alias("p"))
    near = lambda c: F.abs(F.col(f"distinct_{c}") - F.col(f"exact_{c}")) <= sketches.DISTINCT_ERROR * F.col(f"exact_{c}") + 0.5
    between = lambda c, i: F.col(c).between(F.col("p")[i] - 1e-9, F.col("p")[i + 1] + 1e-9)
    both = found.join(exact, "domain")
    return rounded(both.select("domain", "total", "spam", "mean_score", "score_stddev", *[F.col(f"exact_{c}").alias(f"distinct_{c}") for c in sketches.DISTINCT], *[near(c).alias(f"near_{c}") for c in sketches.DISTINCT], between("p50", 0).alias("near_p50"), between("p95", 2).alias("near_p95")))


def bad_row_fallback(spark, sf_dir):
    rows = scoring.normalise_feed(view(spark, sf_dir, FEED))
    counts = stored(scoring.domain_counts(scoring.split_urls(rows)))
    out = scoring.conform(scoring.frequencies(scoring.score_rules(rows), counts))
    return rounded(out.select("url", "domain", "score", "confidence", "is_spam", "domain_frequency", "data_source"))


def domain_stats_exact(spark, sf_dir):
    return rounded(scoring.domain_stats(scores(spark, sf_dir)))


def domain_stats_approx(spark, sf_dir):
    return rounded(scoring.domain_stats(scores(spark, sf_dir), exact=False))


def domain_frequency(spark, sf_dir):
    rows = scoring.frequencies(scoring.split_urls(feed(spark, sf_dir)))
    return rounded(rows.groupBy("domain").agg(F.max("domain_frequency").alias("domain_frequency"), F.max("domain_frequency_pct").alias("domain_frequency_pct")))


def rescore_batch(spark, sf_dir):
    rows = stored(scores(spark, sf_dir).select(*scoring.SECOND_PASS, "url", "is_spam", "segment1", "segment2"))
    out = scoring.rescore(rows, scoring.domain_stats(rows))
    return rounded(out.select("url", "score", "batch_reputation", "rescored", "is_spam_final"))


def _parts(spark, sf_dir) -> DataFrame:
    rows = scores(spark, sf_dir)
    return rows.groupBy("domain", "flag").agg(F.avg("score").alias("reputation"), F.count("*").alias("total"), F.count_if("is_spam").alias("malicious"), F.count_if(~F.col("is_spam")).alias("benign"))


def merge_partial_stats(spark, sf_dir):
    return rounded(domains.merge_partial(_parts(spark, sf_dir)))


def _batch(spark, sf_dir) -> DataFrame:
    return scoring.domain_stats(scores(spark, sf_dir)).select("domain", F.col("mean_score").alias("reputation_score"), F.col("total_urls").alias("total_urls_seen"), F.col("malicious").alias("malicious_urls_count"), F.col("benign").alias("benign_urls_count"), "content_diversity_score")


def reputation_upsert(spark, sf_dir):
    return rounded(domains.upsert(reputation(spark, sf_dir), _batch(spark, sf_dir)))


def reputation_history_ema(spark, sf_dir):
    months = scores(spark, sf_dir).groupBy("domain", F.date_format("timestamp", "yyyyMM").alias("batch")).agg(F.avg("score").alias("value"))
    return rounded(domains.history_ema(months))


def top_domains(spark, sf_dir):
    return domains.ranked(reputation(spark, sf_dir), 20, min_urls=10)


def worst_domains(spark, sf_dir):
    return domains.ranked(reputation(spark, sf_dir), 20, worst=True, min_urls=10)


def domains_by_category(spark, sf_dir):
    return domains.of_category(reputation(spark, sf_dir), "good", 10)


def all_domains_ranked(spark, sf_dir):
    return domains.ranked(reputation(spark, sf_dir))


def domain_lookup(spark, sf_dir):
    wanted = scoring.split_urls(feed(spark, sf_dir).filter("flag = 'R'")).select("domain")
    return domains.lookup(reputation(spark, sf_dir), wanted)


def reputation_summary(spark, sf_dir):
    return rounded(domains.summary(reputation(spark, sf_dir)))


def profile_as_published(spark, sf_dir):
    """Scores under the published modes: suffix sets never match, the second pass ignores diversity."""
    rows = scoring.score_rules(feed(spark, sf_dir), reputation(spark, sf_dir), AS_PUBLISHED)
    rows = stored(rows.select(*scoring.SECOND_PASS, "url", "is_spam", "segment1", "segment2"))
    return rounded(scoring.rescore(rows, scoring.domain_stats(rows), AS_PUBLISHED).select("url", "score", "is_spam", "rescored"))


NAMES = ["feed_normalise", "url_split", "url_features_rules", "host_entropy", "url_anomalies", "score_rules", "score_with_lists", "keyword_index", "domain_sketches", "bad_row_fallback", "domain_stats_exact", "domain_stats_approx", "domain_frequency", "rescore_batch", "merge_partial_stats", "reputation_upsert", "reputation_history_ema", "top_domains", "worst_domains", "domains_by_category", "all_domains_ranked", "domain_lookup", "reputation_summary", "profile_as_published"]
QUERIES = {name: globals()[name] for name in NAMES}

# ---- the same in SQL ----

E_CLEAN = f"e as (select id, ts, trim(regexp_replace(url, '\"\"\\s*target=.*$', ''), '\"') url from ({sql(EDGES)}))"
F_CLEAN = f"e as (select ts, trim(regexp_replace(url, '\"\"\\s*target=.*$', ''), '\"') url from ({sql(FEED)}))"
EPOCH = "coalesce(try_cast(ts as bigint), cast(epoch(try_cast(ts as timestamptz)) as bigint))"


def split_sql(source: str) -> str:
    """CTEs s0 and s (url, domain, path, query and all other columns) over a source with url."""
    pattern = r"^(?:[a-z]+:)?//([^/?#:]+)([^?#]*)(?:\?([^#]*))?.*$"
    return f"""s0 as (select *, case when contains(url, '://') then url else '//' || url end full_ from {source}),
s as (select *, case when coalesce(regexp_extract(full_, '{pattern}', 1), '') = '' then 'unknown.invalid' else lower(regexp_extract(full_, '{pattern}', 1)) end as domain,
  coalesce(regexp_extract(full_, '{pattern}', 2), '') path, coalesce(regexp_extract(full_, '{pattern}', 3), '') query from s0)"""


def n(text: str, char: str) -> str:
    return f"(length({text}) - length(replace({text}, '{char}', '')))"


def lists_sql(lists: bool) -> str:
    """Membership in the host lists and keywords of inputs, or in none."""
    among = {f"is_{k}": f"domain in ({sql(text)})" for k, text in HOSTS.items()}
    among |= {f"is_{k}_content": " or ".join(f"contains(path || '?' || query, '{w}')" for w in words) for k, words in KEYWORDS.items()}
    return ", ".join(f"{c if lists else 'false'} as {k}" for k, c in among.items())


def features_sql(dot: str = "", lists: bool = False) -> str:
    """CTE f: rule features over s with a null-able column timestamp."""
    suffix = "case when contains(domain, '.') then string_split(domain, '.')[-1] else '' end"
    pq = "(path || '?' || query)"
    entropy = lambda c: f"case when length({c}) > 1 then list_entropy(string_split({c}, '')) else 0.0 end"
    count = lambda c, p: f"len(regexp_extract_all({c}, '{p}'))"
    tlds = lambda xs: ", ".join(f"'{dot}{x}'" for x in xs)
    content = ", ".join(f"regexp_matches({pq}, '{p}') {k}" for k, p in urls.CONTENT.items())
    return f"""f as (select *, coalesce(length(url), 0) <= 15 very_short_url, coalesce(length(url), 0) > 1024 very_long_url, not coalesce(contains(url, '://'), false) no_scheme,
  {n('path', '/')} > 10 and {n('path', '-')} > 10 path_keyword_stuffing, {suffix} in ({tlds(urls.SUSPICIOUS_TLDS)}) suspicious_tld, {suffix} in ({tlds(urls.TRUSTWORTHY_TLDS)}) trustworthy_tld,
  regexp_matches(domain, '{urls.IP}') has_ip_address, regexp_matches(domain, '{urls.SHORTENER}') is_url_shortener, {count('path', r'[^\w\s/.À-ɏ-]')} > 3 suspicious_chars_path,
  coalesce({n('url', '%')}, 0) > 5 excessive_encoding, {n('query', '&')} > 9 excessive_params, {count('domain', '[0-9]')} / greatest(length(domain), 1) > 0.4 domain_is_numeric_heavy,
  {n('domain', '-')} > 2 domain_hyphen_heavy, {entropy('domain')} domain_entropy, {entropy('path')} path_entropy,
  {count('domain', '[aeiou]')} / greatest({count('domain', '[bcdfghjklmnpqrstvwxyz]')}, 1) vowel_consonant_ratio, domain = 'unknown.invalid' is_malformed_url, timestamp is null has_invalid_timestamp,
  {n('path', '/')} path_depth, path in ('/', '') is_root_page, regexp_matches(path, '/(user|profile|c|channel|u)/') is_ugc_path, regexp_matches(path, '/[a-z0-9-]+-[0-9]{{4,}}/?') path_has_article_slug,
  regexp_matches(path, '/20[0-9]{{2}}/[0-9]{{1,2}}/') path_has_date, {n('path', '-')} >= 2 and length(path) > 15 path_is_descriptive, {content},
  {n('domain', '.')} > 4 excessive_subdomains, length(query) > 150 long_query, length(domain) < 6 short_domain, length(domain) > 25 very_long_domain, {lists_sql(lists)} from s)"""


def scored_sql(reputation_sql: str | None, dot: str = "", spam: str = "round(score, 9) < -1.8 or contains_phishing or is_nsfw_domain or domain_entropy > 4.2", lists: bool = False) -> str:
    """CTEs up to `scored` over s."""
    from ..config import DEFAULT

    risk = " + ".join(f"case when {k} then {w} else 0 end" for k, w in DEFAULT.risk.items())
    rep = f"left join ({reputation_sql}) rr using (domain)" if reputation_sql else "cross join (select null reputation_score, null content_diversity_score) rr"
    return f"""{features_sql(dot, lists)},
stats as (select avg(coalesce(length(url), 0)) lm, stddev_pop(coalesce(length(url), 0)) ls, avg({n('query', '&')}) pm, stddev_pop({n('query', '&')}) ps from s),
j as (select f.*, abs(coalesce(length(url), 0) - lm) > 2 * (case when ls > 0 then ls else 1 end) length_anomaly, abs({n('query', '&')} - pm) > 2 * (case when ps > 0 then ps else 1 end) param_anomaly,
  coalesce(rr.reputation_score, 0) domain_reputation_score, coalesce(rr.content_diversity_score, 0) domain_diversity from f {rep} cross join stats),
k as (select *, {risk} risk_score, domain_entropy < 3.3 and not domain_is_numeric_heavy and not domain_hyphen_heavy readable,
  case when readable and (path_has_article_slug or path_has_date or path_is_descriptive) then 0.6 + 0.1 * (least(greatest(path_depth, 2), 6) - 2) else 0 end - case when path_depth > 10 then 1 else 0 end path_score,
  case when trustworthy_tld then 1.2 else 0 end + case when is_quality_domain then 0.8 else 0 end + case when is_news_domain then 1.2 else 0 end + path_score + case when readable then 0.25 else 0 end trust_score,
  domain_reputation_score * 0.2 * (1 - least(greatest(domain_diversity, 0), 1)) reputation_part from j),
scored as (select *, trust_score - risk_score - case when very_long_url then 0.5 else 0 end - greatest(0, (domain_entropy - 3.5) * 0.6) - greatest(0, (path_entropy - 4.2) * 0.5)
  + least(greatest(vowel_consonant_ratio * 0.25, -0.25), 0.25) + reputation_part - case when length_anomaly then 0.2 else 0 end - case when param_anomaly then 0.2 else 0 end score,
  {spam} is_spam, trust_score - risk_score composite_score, substr(sha256(url), 1, 16) url_hash,
  least(greatest(0.6 + case when trustworthy_tld or contains_phishing or has_ip_address then 0.3 else 0 end - case when is_malformed_url then 0.5 else 0 end, 0.1), 1.0) confidence from k)"""


L = f"src as (select url, ts as timestamp, flag from ({sql(URLS)}))"
R = sql(REPUTATION)
SPLIT_L = f"{L}, {split_sql('src')}"
SCORED = f"{SPLIT_L}, {scored_sql(R)}, scores as (select *, case when flag = 'A' then 'good_data' else 'input_data' end data_source, string_split(path, '/')[2] segment1, string_split(path, '/')[3] segment2 from scored)"


def r6(*columns: str) -> str:
    return ", ".join(f"round({c}, 6) {c}" for c in columns)


STATS = f"""{SCORED}, stats0 as (select domain, avg(score) mean_score, count(*) total_urls, cast(sum(cast(is_spam as int)) as bigint) malicious, stddev(score) score_stddev, count(distinct segment1) segments1, count(distinct segment2) segments2 from scores group by domain),
dstats as (select *, total_urls - malicious benign, case when coalesce(score_stddev, 0) > 0.8 then 0.4 else 0 end + case when segments2 > 1000 then 0.5 else 0 end + case when segments1 > 100 then 0.1 else 0 end content_diversity_score from stats0)"""
CATEGORY = "case when reputation_score >= 0.7 then 'trusted' when reputation_score >= 0.3 then 'good' when reputation_score >= -0.1 then 'neutral' when reputation_score >= -0.5 then 'suspicious' else 'malicious' end"
RANK = "reputation_score desc, total_urls_seen desc, domain"
DOMAIN_ROW = f"domain, reputation_score, total_urls_seen, malicious_urls_count, {CATEGORY} category"
FEATURE_COLUMNS = ", ".join(f"round({c}, 6) {c}" if c.endswith(("entropy", "ratio")) else c for c in FLAGS)
PUBLISHED = scored_sql(R, dot=".")

ORACLE_SQL = {
    "feed_normalise": f"with {F_CLEAN} select url, {EPOCH} epoch, 'input_data' data_source from e",
    "url_split": f"with {E_CLEAN}, src as (select url from pages union all select url from e), {split_sql('src')} select url, domain, path, query, string_split(path, '/')[2] segment1, string_split(path, '/')[3] segment2 from s",
    "url_features_rules": f"with {SPLIT_L}, {features_sql(lists=True)} select url, {FEATURE_COLUMNS} from f",
    "host_entropy": f"with src as (select url from pages), {split_sql('src')} select distinct domain, round(case when length(domain) > 1 then list_entropy(string_split(domain, '')) else 0 end, 6) entropy from s",
    "url_anomalies": f"with {SPLIT_L}, {scored_sql(None)} select url, length_anomaly, param_anomaly from j",
    "score_rules": f"with {SCORED} select url, domain, {r6('score', 'confidence')}, is_spam, {r6('risk_score', 'trust_score', 'composite_score')}, url_hash, {r6('domain_reputation_score')} from scores",
    "score_with_lists": f"with {SPLIT_L}, {scored_sql(R, lists=True)} select url, domain, {r6('score', 'confidence')}, is_spam, {r6('risk_score', 'trust_score', 'composite_score')}, url_hash, {r6('domain_reputation_score')} from scored",
    "keyword_index": f"""with {SPLIT_L}, w as (select distinct entry from ({sql(KEYWORD_TABLE)}) where entry <> ''), c as (select distinct path || '?' || query c from s),
h as (select c, bool_or(contains(c, entry)) a, bool_or(contains(c, entry) and length(entry) < 8) b from c, w group by c) select url, a is_nsfw_content, b is_spam_content from s join h on c = path || '?' || query""",
    "domain_sketches": f"""with {STATS}, u as (select domain, count(distinct url) distinct_url from scores group by domain) select domain, total_urls total, malicious spam, {r6('mean_score', 'score_stddev')}, distinct_url, segments1 distinct_segment1, segments2 distinct_segment2,
true near_url, true near_segment1, true near_segment2, true near_p50, true near_p95 from dstats join u using (domain)""",
    "bad_row_fallback": f"""with {F_CLEAN}, src as (select url, {EPOCH} as timestamp from e), {split_sql('src')}, {scored_sql(None)},
x as (select *, url is null or trim(url) = '' bad, count(*) over (partition by domain) fr from scored)
select substr(coalesce(url, 'invalid_url'), 1, 1000) url, case when bad then 'unknown.invalid' else domain end as domain, round(case when bad then -2 else score end, 6) score, round(case when bad then 0.1 else confidence end, 6) confidence, bad or is_spam is_spam, case when bad then 1 else fr end domain_frequency, 'input_data' data_source from x""",
    "domain_stats_exact": f"with {STATS} select domain, {r6('mean_score', 'score_stddev', 'content_diversity_score')}, total_urls, malicious, segments1, segments2, benign from dstats",
    "domain_frequency": f"with {SPLIT_L} select domain, count(*) domain_frequency, round(count(*) / (select count(*) from s), 6) domain_frequency_pct from s group by domain",
    "rescore_batch": f"""with {STATS}, x as (select scores.*, mean_score batch_reputation, score - reputation_part + 0.2 * mean_score rescored from scores join dstats using (domain))
select url, {r6('score', 'batch_reputation', 'rescored')}, round(rescored, 9) < -1.8 or contains_phishing or domain_entropy > 4.2 is_spam_final from x""",
    "merge_partial_stats": f"with {SCORED} select domain, round(avg(score), 6) reputation, count(*) total, count(*) filter (is_spam) malicious, count(*) filter (not is_spam) benign from scores group by domain",
    "reputation_upsert": f"""with {STATS} select coalesce(o.domain, n.domain) as domain, round(coalesce(o.reputation_score * 0.9 + n.mean_score * 0.1, n.mean_score, o.reputation_score), 6) reputation_score,
coalesce(o.total_urls_seen, 0) + coalesce(n.total_urls, 0) total_urls_seen, coalesce(o.malicious_urls_count, 0) + coalesce(n.malicious, 0) malicious_urls_count, coalesce(o.benign_urls_count, 0) + coalesce(n.benign, 0) benign_urls_count,
round(coalesce(o.content_diversity_score * 0.9 + n.content_diversity_score * 0.1, n.content_diversity_score, o.content_diversity_score), 6) content_diversity_score from ({R}) o full join dstats n on o.domain = n.domain""",
    "reputation_history_ema": f"""with {SCORED}, m as (select domain, strftime(timestamp, '%Y%m') batch, avg(score) value from scores group by all),
x as (select *, row_number() over (partition by domain order by batch) i, count(*) over (partition by domain) n from m)
select domain, round(sum(case when i = 1 then 0.9 ** (n - 1) else 0.1 * 0.9 ** (n - i) end * value), 6) reputation_score, count(*) batches from x group by domain""",
    "top_domains": f"select {DOMAIN_ROW}, row_number() over (order by {RANK}) rank from ({R}) where total_urls_seen >= 10 qualify rank <= 20",
    "worst_domains": f"select {DOMAIN_ROW}, row_number() over (order by reputation_score, malicious_urls_count desc, domain) rank from ({R}) where total_urls_seen >= 10 qualify rank <= 20",
    "domains_by_category": f"with x as (select *, {CATEGORY} category, row_number() over (order by {RANK}) rank from ({R})) select domain, reputation_score, total_urls_seen, rank from x where category = 'good' order by rank limit 10",
    "all_domains_ranked": f"select {DOMAIN_ROW}, row_number() over (order by {RANK}) rank from ({R})",
    "domain_lookup": f"with {SPLIT_L} select * from ({R}) where domain in (select domain from s where flag = 'R')",
    "reputation_summary": f"""with x as (select *, {CATEGORY} c from ({R})) select count(*) domains, round(avg(reputation_score), 6) avg_reputation, cast(sum(total_urls_seen) as bigint) urls, cast(sum(malicious_urls_count) as bigint) malicious_urls,
count(*) filter (c = 'trusted') trusted, count(*) filter (c = 'good') good, count(*) filter (c = 'neutral') neutral, count(*) filter (c = 'suspicious') suspicious, count(*) filter (c = 'malicious') malicious from x""",
    "profile_as_published": f"""with {SPLIT_L}, {PUBLISHED}, m as (select domain, avg(score) mean_score from scored group by domain)
select url, {r6('score')}, is_spam, round(score - domain_reputation_score * 0.2 + 0.2 * mean_score, 6) rescored from scored join m using (domain)""",
}
