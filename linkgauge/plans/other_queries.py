"""Registered queries over landed files, the trained model and the stream."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.urls import CONTENT, MODEL_INPUTS, model_features
from ..operators import curated, ml, scoring
from ..sources import readers, sinks
from ..sources.shared import release, remove, shared_folder, stored
from ..streaming import batches
from .inputs import URLS, sql
from .url_queries import SPLIT_L, feed, features_sql, r6, rounded, scored_sql, scores, split_sql


def rss_curated(spark, sf_dir):
    """pages as an RSS day-file, landed and read back."""
    path = shared_folder(spark, "rss")
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    item = F.concat(F.lit("<item><link>"), F.replace("url", F.lit("&"), F.lit("&amp;")), F.lit("</link><title>t"), F.col("page_id").cast("string"), F.lit("</title><pubDate>Mon, 01 Sep 2025 10:00:00 +0000</pubDate></item>"))
    pages.select(item).write.option("compression", "gzip").text(path)
    return curated.rss_items(spark, path, "2025-09-02", lines=True).select("url", "source_uri", F.unix_timestamp("timestamp").alias("epoch"), F.get_json_object("metadata", "$.title").alias("title"))


RSS_SQL = "select url, 'mediacloud' source_uri, 1756720800 epoch, 't' || page_id title from pages"


def rss_days(spark, sf_dir):
    """pages as gzipped RSS files of three days, every other item without a time, of which two days are read back."""
    path = shared_folder(spark, "days")
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    for n in range(3):
        date = F.when(F.col("page_id") % 2 == 0, "<pubDate>Mon, 01 Sep 2025 10:00:00 +0000</pubDate>").otherwise("")
        item = F.concat(F.lit("<item><link>"), F.replace("url", F.lit("&"), F.lit("&amp;")), F.lit("</link><title>t"), F.col("page_id").cast("string"), F.lit("</title>"), date, F.lit("</item>"))
        pages.filter(F.col("page_id") % 3 == n).select(item).write.option("compression", "gzip").text(f"{path}/rss-2025-09-0{n + 3}")
    rows = curated.rss_days(spark, path, "2025-09-04", "2025-09-30", lines=True)
    return rows.select("url", F.unix_timestamp("timestamp").alias("epoch"), F.get_json_object("metadata", "$.title").alias("title"), F.col("source_file").endswith(".gz").alias("from_file"))


RSS_DAYS_SQL = "select url, case when page_id % 2 = 0 then 1756720800 else cast(epoch(timestamp '2025-09-03') as bigint) + 86400 * (page_id % 3) end epoch, 't' || page_id title, true from_file from pages where page_id % 3 > 0"


def wiki_curated(spark, sf_dir):
    """Pages as changed articles with the pages' urls as their links, landed and read back."""
    path = shared_folder(spark, "wiki")
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    title = F.concat(F.lit("Page "), F.pmod("page_id", F.lit(997)).cast("string"))
    change = F.struct(F.array(F.struct(title.alias("title"), F.lit("u").alias("user"), F.lit("2025-09-01T00:00:00Z").alias("timestamp"))).alias("recentchanges"))
    pages.select(change.alias("query")).distinct().write.json(f"{path}/changes")
    link = F.struct(F.create_map(F.col("page_id").cast("string"), F.struct(title.alias("title"), F.array(F.create_map(F.lit("*"), F.col("url"))).alias("extlinks"))).alias("pages"))
    pages.select(link.alias("query")).write.json(f"{path}/links")
    return _wiki(spark, path)


def _wiki(spark, path):
    return curated.wiki_changes(spark, f"{path}/changes", f"{path}/links", lines=True).select("url", "source_type", F.get_json_object("metadata", "$.title").alias("title"))


WIKI_SQL = """with t as (select distinct 'Page ' || (page_id % 997) title from pages),
l as (select distinct 'Page ' || (page_id % 997) title, url, page_id from pages), r as (select *, row_number() over (partition by title order by url) n from l)
select 'https://en.wikipedia.org/wiki/' || replace(title, ' ', '_') url, 'article' source_type, title from t union all select url, 'external', title from r where n <= 5"""


def gbt_features(spark, sf_dir):
    return rounded(ml.features(scoring.featured(feed(spark, sf_dir))))


def _learned(spark, sf_dir):
    """Model inputs of the feed, the labels of its urls and the model of both, of features that are derived once."""
    scored = scores(spark, sf_dir)
    inputs = model_features()
    rows = stored(scored.select("url", "score", "data_source", *[inputs[name].alias(name) for name in MODEL_INPUTS]))
    return rows.drop("score", "data_source"), ml.targets(rows), ml.train_scored(rows)


def gbt_train_predict(spark, sf_dir):
    """Trains on rule scores of all urls and predicts them, with the operator's own settings."""
    rows, _, model = _learned(spark, sf_dir)
    return rounded(ml.predict_features(rows, model))


def gbt_accuracy(spark, sf_dir):
    """Whether the trained model follows the rules on the tenth of the urls that its trees are not fitted to."""
    rows, labels, model = _learned(spark, sf_dir)
    found = ml.evaluate(ml.predict_features(rows, model), labels)
    return found.select((F.col("urls") > 0).alias("held_back"), (F.col("correlation") > 0.9).alias("follows"))


def curated_files(spark, sf_dir):
    """Pages as curated rows of tab-separated files with a header, landed and read back; every third lacks its url."""
    path = shared_folder(spark, "curated")
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    url = F.when(F.col("page_id") % 3 > 0, F.col("url")).otherwise(F.when(F.col("page_id") % 2 == 0, " ").otherwise(""))
    pages.select(url.alias("url"), F.lit("s").alias("source_uri"), F.lit("2024-01-01 00:00:00").alias("timestamp"), F.lit("").alias("user_text"), F.lit("rss").alias("source_type"), F.lit('{"a": 1}').alias("metadata")).write.option("sep", "\t").option("header", True).option("escape", '"').csv(path)
    rows = curated.clean_curated(readers.read_curated(spark, path))
    return rows.select("url", F.unix_timestamp("timestamp").alias("epoch"), "data_source")


CURATED_SQL = "select distinct url, 1704067200 epoch, 'good_data' data_source from pages where page_id % 3 > 0 and trim(url) <> ''"
PARTS = ("A", "N", "R")


def stream_batches(spark, sf_dir):
    """The url feed landed in three parts of several files each, each taken up by the stream and then removed; the reputation after the last."""
    path, files = shared_folder(spark, "stream"), 4
    rows = feed(spark, sf_dir).select(F.unix_timestamp("timestamp").cast("string").alias("ts"), "url", "flag")
    for flag in PARTS:
        rows.filter(F.col("flag") == flag).select("ts", "url").repartition(files).write.mode("append").option("sep", "\t").option("quote", "").option("escape", "").csv(f"{path}/landed")
        release(spark)
        batches.start(spark, f"{path}/landed", f"{path}/out", f"{path}/checkpoint", files=files, names="part-*").awaitTermination()
        remove(spark, f"{path}/landed")
    last = sinks.latest_reputation(spark, f"{path}/out/reputation", len(PARTS))
    return rounded(last.select("domain", "reputation_score", "total_urls_seen", "malicious_urls_count", "benign_urls_count", "content_diversity_score"))


QUERIES = {"curated_files": curated_files, "rss_curated": rss_curated, "rss_days": rss_days, "wiki_curated": wiki_curated, "gbt_features": gbt_features, "gbt_train_predict": gbt_train_predict, "gbt_accuracy": gbt_accuracy, "stream_batches": stream_batches}


def _stream_sql() -> str:
    """Each batch is scored with the reputation that the one before left."""
    out = []
    for i, flag in enumerate(PARTS):
        stored = f"select domain, reputation_score, content_diversity_score from r{i - 1}" if i else None
        out.append(f"""n{i} as (with src as (select distinct url, ts as timestamp from ({sql(URLS)}) where flag = '{flag}'), {split_sql('src')}, {scored_sql(stored)},
  x as (select *, string_split(path, '/')[2] segment1, string_split(path, '/')[3] segment2 from scored)
  select domain, avg(score) m, count(*) n, count(*) filter (is_spam) bad, case when coalesce(stddev(score), 0) > 0.8 then 0.4 else 0 end + case when count(distinct segment2) > 1000 then 0.5 else 0 end
    + case when count(distinct segment1) > 100 then 0.1 else 0 end div from x group by domain)""")
        old = f"r{i - 1}" if i else f"(select null as domain, null reputation_score, 0 total_urls_seen, 0 malicious_urls_count, 0 benign_urls_count, null content_diversity_score from n{i} limit 0)"
        out.append(f"""r{i} as (select coalesce(o.domain, n.domain) as domain, coalesce(o.reputation_score * 0.9 + n.m * 0.1, n.m, o.reputation_score) reputation_score, coalesce(o.total_urls_seen, 0) + coalesce(n.n, 0) total_urls_seen,
  coalesce(o.malicious_urls_count, 0) + coalesce(n.bad, 0) malicious_urls_count, coalesce(o.benign_urls_count, 0) + coalesce(n.n - n.bad, 0) benign_urls_count,
  coalesce(o.content_diversity_score * 0.9 + n.div * 0.1, n.div, o.content_diversity_score) content_diversity_score from {old} o full join n{i} n on o.domain = n.domain)""")
    return f"with {', '.join(out)} select domain, total_urls_seen, malicious_urls_count, benign_urls_count, {r6('reputation_score', 'content_diversity_score')} from r{len(PARTS) - 1}"


def _gbt_sql() -> str:
    one = lambda c: f"cast({c} as int)"
    digits, dots, hyphens = "len(regexp_extract_all(domain, '[0-9]'))", "(length(domain) - length(replace(domain, '.', '')))", "(length(domain) - length(replace(domain, '-', '')))"
    params = "(length(query) - length(replace(query, '&', '')) + cast(query <> '' as int))"
    given = {
        "len_url": "length(url)", "len_path": "length(path)", "len_query": "length(query)", "len_domain": "length(domain)", "is_very_short_url": one("very_short_url"), "is_very_long_url": one("very_long_url"),
        "is_suspicious_tld": one("suspicious_tld"), "is_trustworthy_tld": one("trustworthy_tld"), "num_subdomains": dots, "has_excessive_subdomains": one(f"{dots} > 4"), "num_path_dirs": "path_depth", "is_root_path": one("is_root_page"),
        "num_params": params, "has_excessive_params": one(f"{params} > 9"), "num_digits_domain": digits, "digit_ratio_domain": f"round({digits} / greatest(length(domain), 1), 6)", "num_hyphens_domain": hyphens,
        "has_suspicious_chars_path": one("suspicious_chars_path"), "has_excessive_encoding": one("excessive_encoding"), "domain_entropy": "round(domain_entropy, 6)", "path_entropy": "round(path_entropy, 6)", "vowel_consonant_ratio": "round(vowel_consonant_ratio, 6)",
        "is_quality_article": one("domain_entropy < 3.3 and not domain_is_numeric_heavy and not domain_hyphen_heavy and (path_has_article_slug or path_has_date or path_is_descriptive)"),
        "is_nsfw_content": "0", "is_spam_content": "0", "is_nsfw_domain": "0", "is_quality_domain": "0", "is_news_domain": "0",
    } | {k: one(f"regexp_matches(path || '?' || query, '(?i){p}')") for k, p in CONTENT.items()}
    return f"with {SPLIT_L}, {features_sql()} select url, " + ", ".join(f"{given.get(c, one(c))} as {c}" for c in MODEL_INPUTS) + " from f"


ORACLE_SQL = {"gbt_accuracy": "select true held_back, true follows", "curated_files": CURATED_SQL, "stream_batches": _stream_sql(), "gbt_features": _gbt_sql(), "rss_curated": RSS_SQL, "rss_days": RSS_DAYS_SQL, "wiki_curated": WIKI_SQL}
