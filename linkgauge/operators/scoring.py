"""Scoring of URL batches: normalise, features, anomalies, score, second pass, fallback rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import DEFAULT, ScoringProfile
from ..functions import urls
from . import keywords

LISTS = ("nsfw_domain", "quality_domain", "news_domain")
#: Bytes of the largest method that the JVM compiles.
HUGE = 8000
#: Domains that are sent to the tasks at most (about 100 bytes each).
MOST_SENT = 1_000_000
#: What the second pass needs of the first, and what beside it a batch's result is made of.
SECOND_PASS = ("domain", "score", "reputation_part", "domain_reputation_score", "contains_phishing", "is_nsfw_domain", "domain_entropy")
RESULT = ("url", "timestamp", "data_source", "source_file", "confidence", "is_spam", "segment1", "segment2", "risk_score", "trust_score", "composite_score", "domain_frequency", "domain_frequency_pct")


def normalise_feed(feed: DataFrame, source: str = "input_data") -> DataFrame:
    """Raw (ts, url) texts -> (url, timestamp, data_source): epoch seconds or ISO text, else null; the url is cleaned. source_file
    is kept if there is one."""
    epoch = F.timestamp_seconds(F.col("ts").try_cast("bigint"))
    when = F.coalesce(epoch, F.try_to_timestamp("ts"))
    return feed.select(urls.clean(F.col("url")).alias("url"), when.alias("timestamp"), F.lit(source).alias("data_source"), *[c for c in feed.columns if c == "source_file"])


def split_urls(rows: DataFrame) -> DataFrame:
    """Adds domain, path, query and the path's first two segments (null where there are none)."""
    after = lambda c: F.when(c.contains("/"), F.substr(c, F.instr(c, "/") + 1))
    first = after(F.col("path"))
    return urls.split(rows).withColumns({"segment1": F.substring_index(first, "/", 1), "segment2": F.substring_index(after(first), "/", 1)})


def list_flags(rows: DataFrame, lists: dict[str, DataFrame] | None = None) -> DataFrame:
    """Adds is_<list> for hosts in lists of (host): one join with all lists; a list that is not given has no members."""
    given = [name for name in LISTS if lists and name in lists]
    if given:
        hosts = reduce(DataFrame.union, [lists[name].select(F.lower(F.trim("host")).alias("domain"), F.lit(name).alias("_list")) for name in given])
        rows = rows.join(hosts.groupBy("domain").agg(*[F.bool_or(F.col("_list") == name).alias(f"_is_{name}") for name in given]), "domain", "left")
    flags = {f"is_{name}": F.coalesce(f"_is_{name}", F.lit(False)) if name in given else F.lit(False) for name in LISTS}
    return rows.withColumns(flags).drop(*[f"_is_{name}" for name in given])


def featured(rows: DataFrame, profile: ScoringProfile = DEFAULT, lists: dict[str, DataFrame] | None = None, nsfw: list[str] | DataFrame = (), spam: list[str] | DataFrame = ()) -> DataFrame:
    """Adds the rule features and list flags. Keywords are a list, which becomes one pattern, or a table (entry) of any size, which
    is joined."""
    return _featured(split_urls(rows), profile, lists, nsfw, spam)


def _featured(rows: DataFrame, profile: ScoringProfile, lists: dict[str, DataFrame] | None, nsfw, spam, reputation: DataFrame | None = None) -> DataFrame:
    """featured of split rows, with reputation: what is joined by domain is joined before the features make the rows wide.

    The features are too much for one compiled method, which the JVM would then run uncompiled: Spark is told to cut it up. It has no
    setting for a single plan, so the session's is set."""
    rows.sparkSession.conf.set("spark.sql.codegen.hugeMethodLimit", str(HUGE))
    tables = {name: words for name, words in (("is_nsfw_content", nsfw), ("is_spam_content", spam)) if isinstance(words, DataFrame)}
    for name, words in tables.items():
        rows = keywords.flag(rows, F.concat("path", F.lit("?"), "query"), words, f"_{name}")
    plain = [() if isinstance(words, DataFrame) else words for words in (nsfw, spam)]
    out = urls.rule_features(with_reputation(list_flags(rows, lists), reputation), profile, *plain)
    return out.withColumns({name: F.col(f"_{name}") for name in tables}).drop(*[f"_{name}" for name in tables])


def anomalies(rows: DataFrame, batch: DataFrame | None = None) -> DataFrame:
    """Adds length_anomaly and param_anomaly: more than two population deviations from the batch mean (deviation 0 counts
    as 1). The statistics are one row, joined to all; they are taken of batch, the same rows before any join, if it is given."""
    size, params = F.coalesce(F.length("url"), F.lit(0)), urls.occurrences(F.col("query"), "&")
    one = lambda c: F.when(F.stddev_pop(c) > 0, F.stddev_pop(c)).otherwise(1.0)
    stats = (rows if batch is None else batch).agg(F.avg(size).alias("len_mean"), one(size).alias("len_std"), F.avg(params).alias("param_mean"), one(params).alias("param_std"))
    joined = rows.join(F.broadcast(stats), how="left", on=F.lit(True))  # left, so that what needs no anomalies reads no statistics
    far = lambda c, of: F.abs(c - F.col(f"{of}_mean")) > 2 * F.col(f"{of}_std")
    return joined.withColumns({"length_anomaly": far(size, "len"), "param_anomaly": far(params, "param")}).drop(*stats.columns)


def _sum(columns: list[Column]) -> Column:
    return reduce(lambda a, b: a + b, columns)


def clip(c: Column, low: float, high: float) -> Column:
    return F.greatest(F.lit(low), F.least(F.lit(high), c))


def sent(table: DataFrame) -> DataFrame:
    """table, to be joined: by sending it to the tasks if it has MOST_SENT rows or fewer. It is counted, so it should be a stored one."""
    return F.broadcast(table) if table.count() <= MOST_SENT else table


def with_reputation(rows: DataFrame, reputation: DataFrame | None) -> DataFrame:
    """Adds domain_reputation_score and domain_diversity; unknown domains have 0. A reputation of MOST_SENT domains or fewer is sent to the
    tasks, so that the urls are not exchanged for it."""
    if reputation is None:
        return rows.withColumns({"domain_reputation_score": F.lit(0.0), "domain_diversity": F.lit(0.0)})
    known = reputation.select("domain", F.col("reputation_score").alias("_rep"), F.col("content_diversity_score").alias("_div"))
    joined = rows.join(sent(known), "domain", "left")
    return joined.withColumns({"domain_reputation_score": F.coalesce("_rep", F.lit(0.0)), "domain_diversity": F.coalesce("_div", F.lit(0.0))}).drop("_rep", "_div")


def scored(rows: DataFrame, profile: ScoringProfile = DEFAULT) -> DataFrame:
    """Adds score, is_spam, risk_score, trust_score, composite_score, confidence and url_hash to rows with features,
    anomalies and reputation."""
    on = lambda name, w: F.when(F.col(name), w).otherwise(0.0)
    risk = _sum([on(k, w) for k, w in profile.risk.items()])
    priority = _sum([on(k, w) for k, w in profile.priority.items()])
    readable = (F.col("domain_entropy") < 3.3) & ~F.col("domain_is_numeric_heavy") & ~F.col("domain_hyphen_heavy")
    article = F.col("path_has_article_slug") | F.col("path_has_date") | F.col("path_is_descriptive")
    deep = F.when(readable & article, 0.6 + 0.1 * (F.least(F.greatest("path_depth", F.lit(2)), F.lit(6)) - 2)).otherwise(0.0)
    path = deep - F.when(F.col("path_depth") > 10, 1.0).otherwise(0.0)
    bonus = F.when(readable, 0.25).otherwise(0.0)
    weight = profile.reputation_weight * (1 - clip(F.col("domain_diversity"), 0.0, 1.0))
    score = (
        priority - risk + path + bonus - on("very_long_url", 0.5) - F.greatest(F.lit(0.0), (F.col("domain_entropy") - 3.5) * 0.6) - F.greatest(F.lit(0.0), (F.col("path_entropy") - 4.2) * 0.5)
        + clip(F.col("vowel_consonant_ratio") * 0.25, -0.25, 0.25) + F.col("domain_reputation_score") * weight - on("length_anomaly", 0.2) - on("param_anomaly", 0.2)
    )
    strong = F.col("trustworthy_tld") | F.col("contains_phishing") | F.col("has_ip_address")
    spam = (F.round("score", 9) < profile.spam_below) | F.col("contains_phishing") | F.col("is_nsfw_domain") | (F.col("domain_entropy") > 4.2)
    out = rows.withColumns({"score": score, "risk_score": risk, "trust_score": priority + path + bonus, "reputation_part": F.col("domain_reputation_score") * weight})
    return out.withColumns({
        "is_spam": spam, "composite_score": F.col("trust_score") - F.col("risk_score"), "url_hash": urls.fingerprint(F.col("url")),
        "confidence": clip(0.6 + F.when(strong, 0.3).otherwise(0.0) - on("is_malformed_url", 0.5), 0.1, 1.0),
    })


def domain_counts(rows: DataFrame) -> DataFrame:
    """(domain, domain_frequency): counts are summed before they are exchanged."""
    return rows.groupBy("domain").agg(F.count("*").alias("domain_frequency"))


def frequencies(rows: DataFrame, counts: DataFrame | None = None) -> DataFrame:
    """Adds domain_frequency and domain_frequency_pct (share of the batch), of rows or of domain_counts that were taken of them before:
    if these have been written, Spark knows their size and need not exchange the rows."""
    counts = domain_counts(rows) if counts is None else counts
    total = counts.agg(F.sum("domain_frequency").alias("_total"))
    return rows.join(counts, "domain").crossJoin(F.broadcast(total)).withColumn("domain_frequency_pct", F.col("domain_frequency") / F.col("_total")).drop("_total")


def score_rules(rows: DataFrame, reputation: DataFrame | None = None, profile: ScoringProfile = DEFAULT, lists: dict[str, DataFrame] | None = None, nsfw: list[str] = (), spam: list[str] = ()) -> DataFrame:
    """Pass 1 over (url, timestamp, ...): every part of the rule score is kept. lists holds host lists by the names in LISTS,
    nsfw and spam are keywords looked for in paths and queries."""
    split = split_urls(rows)
    return scored(anomalies(_featured(split, profile, lists, nsfw, spam, reputation), split), profile)


def domain_stats(rows: DataFrame, exact: bool = True) -> DataFrame:
    """Batch statistics of each domain with its content-diversity score; exact or approximate distinct segments.

    Rows are summed up by domain and segments first, so that only these sums meet the exact distinct counts."""
    known = rows.filter(F.col("domain").isNotNull() & (F.col("domain") != ""))
    if exact:
        parts = known.groupBy("domain", "segment1", "segment2").agg(F.count("*").alias("n"), F.count("score").alias("scored"), F.sum(F.col("is_spam").cast("int")).alias("bad"), F.sum("score").alias("s"), F.sum(F.col("score") * F.col("score")).alias("s2"))
        sums = parts.groupBy("domain").agg(*[F.sum(c).alias(c) for c in ("n", "scored", "bad", "s", "s2")], F.count_distinct("segment1").alias("segments1"), F.count_distinct("segment2").alias("segments2"))
        spread = F.greatest(F.lit(0.0), F.col("s2") - F.col("s") * F.col("s") / F.col("scored")) / (F.col("scored") - 1)
        stats = sums.select("domain", (F.col("s") / F.nullif("scored", F.lit(0))).alias("mean_score"), F.col("n").alias("total_urls"), F.col("bad").alias("malicious"), F.when(F.col("scored") > 1, F.sqrt(spread)).alias("score_stddev"), "segments1", "segments2")
    else:
        stats = known.groupBy("domain").agg(
            F.avg("score").alias("mean_score"), F.count("*").alias("total_urls"), F.sum(F.col("is_spam").cast("int")).alias("malicious"),
            F.stddev("score").alias("score_stddev"), F.approx_count_distinct("segment1").alias("segments1"), F.approx_count_distinct("segment2").alias("segments2"),
        )
    flag = lambda c, w: F.when(c, w).otherwise(0.0)
    diversity = flag(F.coalesce("score_stddev", F.lit(0.0)) > 0.8, 0.4) + flag(F.col("segments2") > 1000, 0.5) + flag(F.col("segments1") > 100, 0.1)
    return stats.withColumns({"benign": F.col("total_urls") - F.col("malicious"), "content_diversity_score": diversity})


def rescore(rows: DataFrame, stats: DataFrame, profile: ScoringProfile = DEFAULT) -> DataFrame:
    """Pass 2: the old reputation's part of the score gives way to the batch mean's; adds rescored and is_spam_final."""
    taken = F.col("domain_reputation_score") * profile.reputation_weight if profile.flat_reputation else F.col("reputation_part")
    batch = stats.select("domain", F.col("mean_score").alias("_mean"))
    out = rows.join(batch, "domain", "left").withColumn("batch_reputation", F.coalesce("_mean", F.lit(0.0))).drop("_mean")
    out = out.withColumn("rescored", F.col("score") - taken + profile.reputation_weight * F.col("batch_reputation"))
    return out.withColumn("is_spam_final", (F.round("rescored", 9) < profile.spam_below) | F.col("contains_phishing") | F.col("is_nsfw_domain") | (F.col("domain_entropy") > 4.2))


def replaced_reputation(rows: DataFrame) -> DataFrame:
    """Rows of rescore with the rescored score and the batch mean of their domain in place of the old ones."""
    return rows.drop("score", "domain_reputation_score").withColumnsRenamed({"rescored": "score", "batch_reputation": "domain_reputation_score"})


def conform(rows: DataFrame, profile: ScoringProfile = DEFAULT, fallback: float = -2.0, received_at: str | None = None) -> DataFrame:
    """The public result of scored rows: nulls replaced, texts cut to max_len, and rows without a usable url or score as
    fallback rows (given score, spam, confidence 0.1, unknown domain). meta is a JSON text of the score's parts, url_hash is of the
    whole url, so that cut urls stay apart."""
    cut = lambda c: F.left(c, F.lit(profile.max_len))
    bad = F.col("url").isNull() | (F.trim("url") == "") | F.col("score").isNull() | F.isnan("score")
    parts = [F.col(c) for c in ("risk_score", "trust_score", "composite_score") if c in rows.columns]
    meta = F.to_json(F.struct("domain", "confidence", "is_spam", *parts))
    share = F.col("domain_frequency_pct") if "domain_frequency_pct" in rows.columns else F.lit(None).cast("double")
    return rows.select(
        cut(F.coalesce("url", F.lit("invalid_url"))).alias("url"), "timestamp",
        cut(F.when(bad, urls.UNKNOWN).otherwise(F.coalesce("domain", F.lit(urls.UNKNOWN)))).alias("domain"),
        F.when(bad, fallback).otherwise(F.col("score")).alias("score"), F.when(bad, 0.1).otherwise(F.col("confidence")).alias("confidence"),
        (bad | F.col("is_spam")).alias("is_spam"), F.when(bad, 0.0).otherwise(F.col("domain_reputation_score")).alias("domain_reputation_score"),
        F.when(bad, F.lit(1)).otherwise(F.col("domain_frequency")).cast("long").alias("domain_frequency"), F.coalesce("data_source", F.lit("input_data")).alias("data_source"),
        F.when(bad, 0.0).otherwise(share).alias("domain_frequency_pct"), F.when(~bad, meta).alias("meta"), F.lit(received_at).cast("timestamp").alias("received_at"),
        urls.fingerprint(F.coalesce("url", F.lit("invalid_url"))).alias("url_hash"), *[c for c in rows.columns if c == "source_file"],
    )
