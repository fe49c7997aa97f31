"""Deep features of a sample: one url a domain, joined with what was observed, and the scores that follow."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import urls
from . import domains


#: Parts that a domain's rows are dealt to before its first picks are taken.
SALTS = 16


def sample(rows: DataFrame, seed: str = "42", limit: int = 6500, fraction: float = 1.0, k: int = 1) -> DataFrame:
    """k urls of each domain, those with the least seeded hashes, each url once; then the `limit` least hashes of all picks. A null
    url is no pick. fraction keeps that share of the picks. One url a domain is summed up before the exchange; of
    several, each of SALTS parts of a domain keeps its own k first, so hot domains do no harm."""
    h = F.md5(F.concat("url", F.lit(seed)))
    known = rows.filter("url is not null")
    if k == 1:
        picked = known.groupBy("domain").agg(F.min(F.struct(h.alias("h"), "url")).alias("p")).select("domain", "p.url", "p.h")
    else:
        first = lambda df, *by: df.withColumn("_n", F.row_number().over(Window.partitionBy(*by).orderBy("h", "url"))).filter(F.col("_n") <= k).drop("_n")
        salted = known.select("domain", "url", h.alias("h"), F.pmod(F.xxhash64("url"), F.lit(SALTS)).alias("_salt")).distinct()
        picked = first(first(salted, "domain", "_salt").drop("_salt"), "domain")
    return picked.filter(F.conv(F.left("h", F.lit(8)), 16, 10).cast("double") < fraction * 4294967296.0).orderBy("h").limit(limit).drop("h")


def enhance(picked: DataFrame, content: DataFrame, outlinks: DataFrame, requests: DataFrame, archive: DataFrame) -> DataFrame:
    """picked (url, domain, score, confidence) with enhanced_score, score_delta and enhanced_confidence. Content and links
    count where the request came back with 200; what was not observed counts as inaccessible or never archived. Requests
    without a column last_modified have none."""
    if "last_modified" not in requests.columns:
        requests = requests.withColumn("last_modified", F.lit(None).cast("string"))
    joined = (
        picked.join(requests.select("url", "accessible", "status_code", "response_time", "redirect_count", "etag", "last_modified"), "url", "left")
        .join(content.select("url", "has_content", "content_quality", "content_trust", "content_spam"), "url", "left")
        .join(outlinks.select("url", "total", "quality_ratio", "spam_ratio"), "url", "left")
        .join(archive.select("url", "archived", "archive_count", "days_since_last"), "url", "left")
    )
    # fixed values: the weights and bounds below
    true = lambda c: F.coalesce(c, F.lit(False))
    w = lambda c, x: F.when(true(c), x).otherwise(0.0)
    reached, archived = true(F.col("accessible")), true(F.col("archived"))
    fine = reached & true(F.col("status_code") == 200)
    has, linked = fine & true(F.col("has_content")), fine & true(F.col("total") > 0)
    score = (
        F.coalesce("score", F.lit(0.0)) + w(has, F.col("content_quality") * 0.3 + F.col("content_trust") * 0.2 - F.col("content_spam") * 0.4)
        + w(linked, F.col("quality_ratio") * 0.15 - F.col("spam_ratio") * 0.25)
        + F.when(~reached, -0.5).otherwise(w(F.col("status_code") == 200, 0.1) - w(F.col("status_code") >= 400, 0.3) - w(F.col("redirect_count") > 3, 0.1) - w(F.col("response_time") > 5, 0.05))
        + F.when(~archived, -0.2).otherwise(w(F.col("days_since_last").between(0, 29), 0.1) - w(F.col("days_since_last") > 365, 0.1) + F.least(F.col("archive_count") / 100, F.lit(0.2)))
    )
    families = has.cast("int") + linked.cast("int") + reached.cast("int") + archived.cast("int")
    out = joined.withColumns({"enhanced_score": score, "enhanced_confidence": F.least(F.coalesce("confidence", F.lit(0.5)) + 0.1 * families, F.lit(1.0))})
    return out.withColumn("score_delta", F.col("enhanced_score") - F.coalesce("score", F.lit(0.0)))


def merge_enhanced(rows: DataFrame, enhanced: DataFrame) -> DataFrame:
    """All scored rows, those of the sample with their enhanced score and confidence; joined by the url's hash."""
    better = enhanced.select(urls.fingerprint(F.col("url")).alias("url_hash"), F.col("enhanced_score").alias("_s"), F.col("enhanced_confidence").alias("_c"))
    out = rows.join(better, "url_hash", "left")
    return out.withColumns({"score": F.coalesce("_s", "score"), "confidence": F.coalesce("_c", "confidence")}).drop("_s", "_c")


def volatility(enhanced: DataFrame, exact: bool = True) -> DataFrame:
    """Of each domain: mean score change, urls, distinct etags and times of change a url, hours until the next visit."""
    distinct = F.count_distinct if exact else F.approx_count_distinct
    out = enhanced.groupBy("domain").agg(F.avg("score_delta").alias("mean_delta"), F.count("*").alias("urls"), ((distinct("etag") + distinct("last_modified")) / F.count("*")).alias("volatility"))
    return out.withColumn("revisit_hours", domains.revisit_hours(F.col("volatility")))
