"""Curated feeds: landed RSS and wiki files to curated rows, and the union with the input feed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import urls
from ..sources.shared import DAY, of_days

# fixed value: hosts whose links are not curated
SKIPPED_HOSTS = ("web.archive.org", "archive.org", "www.wikipedia.org", "en.wikipedia.org", "www.wikidata.org", "commons.wikimedia.org")
SKIPPED_TITLES = ("Category:", "User:", "Talk:")
ITEM = "link string, title string, pubDate string, domain string, source struct<_VALUE: string, _url: string, _mcFeedId: string, _mcSourceId: string>"


CURATED = "url string, source_uri string, timestamp timestamp, source_type string, metadata string, source_file string"


def _items(spark: SparkSession, paths: str | list[str], lines: bool) -> DataFrame:
    return spark.read.format("xml").option("rowTag", "item").option("multiLine", not lines).schema(ITEM).load(paths)


def _curated_items(items: DataFrame, file_date: Column) -> DataFrame:
    when = F.try_to_timestamp(F.expr("substr(pubDate, instr(pubDate, ',') + 2)"), F.lit("dd MMM yyyy HH:mm:ss Z"))
    meta = F.to_json(F.struct(F.col("title"), F.col("domain"), F.col("source._mcFeedId").alias("feed_id"), F.col("source._mcSourceId").alias("source_id")))
    kept = [c for c in ("source_file",) if c in items.columns]
    out = items.select(F.trim("link").alias("url"), F.coalesce("source._url", F.lit("mediacloud")).alias("source_uri"), F.coalesce(when, file_date).alias("timestamp"), F.lit("rss").alias("source_type"), meta.alias("metadata"), *kept)
    return linkable(out)


def rss_items(spark: SparkSession, path: str, file_date: str, lines: bool = False) -> DataFrame:
    """RSS day-files (or one item a line), also gzipped, to curated rows; missing times become the file's date, missing sources `mediacloud`."""
    return _curated_items(_items(spark, path, lines), F.lit(file_date).cast("timestamp"))


def file_day(path: Column) -> Column:
    """The last day that a file's path names."""
    found = F.regexp_extract_all(path, F.lit(DAY), F.lit(0))
    return F.to_timestamp(F.translate(F.element_at(found, -1), "-", ""), "yyyyMMdd")


def rss_days(spark: SparkSession, folder: str, first: str, last: str, lines: bool = False) -> DataFrame:
    """rss_items of all files and folders in folder whose names hold a day from first to last, in one read; files of other days are not
    opened. Missing times become the day of the item's own file, which source_file names."""
    paths = of_days(spark, folder, first, last)
    if not paths:
        return spark.createDataFrame([], CURATED)
    items = _items(spark, paths, lines).select("*", F.col("_metadata.file_path").alias("_path"), F.col("_metadata.file_name").alias("source_file"))
    return _curated_items(items, file_day(F.col("_path")))


def wiki_days(spark: SparkSession, folder: str, first: str, last: str, per_change: int = 5, lines: bool = False) -> DataFrame:
    """wiki_changes of the days from first to last, of which folder holds a folder each with changes and links in it."""
    days = of_days(spark, folder, first, last)
    if not days:
        return spark.createDataFrame([], "url string, timestamp timestamp, source_type string, metadata string")
    return wiki_changes(spark, [f"{d}/changes" for d in days], [f"{d}/links" for d in days], per_change, lines)


def wiki_changes(spark: SparkSession, changes: str | list[str], links: str | list[str], per_change: int = 5, lines: bool = False) -> DataFrame:
    """Landed recent-changes and external-links JSON (a document a file, or a line) to curated rows: the article and up to
    per_change links of it."""
    recent = spark.read.option("multiLine", not lines).schema("query struct<recentchanges: array<struct<title: string, user: string, timestamp: string>>>").json(changes)
    changed = recent.select(F.explode("query.recentchanges").alias("c")).select("c.title", "c.user", "c.timestamp")
    changed = changed.filter(~_any_prefix(F.col("title")))
    pages = spark.read.option("multiLine", not lines).schema("query struct<pages: map<string, struct<title: string, extlinks: array<map<string, string>>>>>").json(links)
    listed = pages.select(F.explode("query.pages").alias("id", "p")).select("p.title", F.explode("p.extlinks").alias("l")).select("title", F.element_at("l", "*").alias("url"))
    outside = linkable(changed.join(listed, "title").withColumn("timestamp", F.try_to_timestamp("timestamp")))
    rank = F.row_number().over(Window.partitionBy("title", "timestamp", "user").orderBy("url"))
    outside = outside.withColumn("n", rank).filter(F.col("n") <= per_change).drop("n").withColumn("source_type", F.lit("external"))
    article = changed.select("title", "user", F.try_to_timestamp("timestamp").alias("timestamp"), F.concat(F.lit("https://en.wikipedia.org/wiki/"), F.replace("title", F.lit(" "), F.lit("_"))).alias("url"), F.lit("article").alias("source_type"))
    both = article.unionByName(outside.select(*article.columns))
    return both.select("url", "timestamp", "source_type", F.to_json(F.struct("title", "user")).alias("metadata"))


def _any_prefix(title):
    out = F.lit(False)
    for p in SKIPPED_TITLES:
        out = out | title.startswith(p)
    return out


def linkable(rows: DataFrame) -> DataFrame:
    """http(s) links to hosts that are not skipped."""
    host = urls.host(F.lower("url"))
    return rows.filter(F.lower("url").rlike("^https?://") & ~host.isin(*SKIPPED_HOSTS))


def clean_curated(rows: DataFrame) -> DataFrame:
    """(url, timestamp, data_source) of curated rows with a url, each url once with its earliest time."""
    found = rows.filter(F.col("url").isNotNull() & (F.trim("url") != "")).select(F.trim("url").alias("url"), F.col("timestamp").cast("timestamp").alias("timestamp"))
    return found.groupBy("url").agg(F.min("timestamp").alias("timestamp")).withColumn("data_source", F.lit("good_data"))


def union_feeds(feed: DataFrame, curated: DataFrame) -> DataFrame:
    """One row a url from both feeds: the curated one first, then the earliest (rows without a time last)."""
    both = feed.select("url", F.col("timestamp").cast("timestamp").alias("timestamp"), "data_source").unionByName(curated.select("url", F.col("timestamp").cast("timestamp").alias("timestamp"), "data_source"))
    order = F.struct((F.col("data_source") != "good_data").alias("a"), F.col("timestamp").isNull().alias("b"), F.col("timestamp").alias("c"), F.col("data_source").alias("d"))
    return both.groupBy("url").agg(F.min(order).alias("o")).select("url", F.col("o.c").alias("timestamp"), F.col("o.d").alias("data_source"))
