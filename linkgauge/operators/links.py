"""Outgoing links of pages: extraction, classification by reputation and wording, scores of the whole page."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import urls
from ..functions import markup
from ..functions.html import attribute, bound

# fixed values: hosts and phrases of the link rules
NEWS = ("nytimes.com", "washingtonpost.com", "wsj.com", "theguardian.com", "cnn.com", "bbc.co.uk", "reuters.com", "bloomberg.com", "economist.com")
SHORTENERS = ("bit.ly", "tinyurl.com", "goo.gl", "t.co", "ow.ly", "short.link")
PHRASES = ("click here", "free money", "make money", "work from home", "guaranteed", "miracle", "amazing", "incredible", "unbelievable", "shocking", "viral", "you won", "claim now", "limited time", "act fast", "download now")
KINDS = ("quality", "news", "internal", "neutral", "low_quality", "suspicious", "spam")


def without_dots(path: Column) -> Column:
    """The path with its . and .. segments resolved."""
    step = lambda done, x: F.when(x == ".", done).when(x == "..", F.slice(done, F.lit(1), F.greatest(F.size(done) - 1, F.lit(1)))).otherwise(F.concat(done, F.array(x)))
    parts = F.split(path, "/")
    return F.when(path.contains("/."), F.array_join(F.aggregate(parts, F.slice(parts, 1, 0), step), "/")).otherwise(path)


def resolve(page: Column, link: Column) -> Column:
    """Absolute form of a link on a page."""
    origin, base = F.regexp_extract(page, r"^[a-z]+://[^/?#]+", 0), F.regexp_extract(page, r"^[^?#]*", 0)
    folder = F.regexp_extract(base, r"^[a-z]+://[^/?#]+(.*/)", 1)
    local = F.when(link.startswith("/"), link).otherwise(F.concat(F.when(folder == "", "/").otherwise(folder), link))
    return (
        F.when(link.rlike("^[a-zA-Z][a-zA-Z0-9+.-]*:"), link).when(link.startswith("//"), F.concat(F.substring_index(page, "//", 1), link))
        .when(link == "", page).when(link.startswith("#"), F.concat(F.regexp_extract(page, "^[^#]*", 0), link)).when(link.startswith("?"), F.concat(base, link)).otherwise(F.concat(origin, without_dots(local)))
    )


def extract(pages: DataFrame) -> DataFrame:
    """(page_url, link_url, text, title, rel): one row for each anchor with an href that is not blank, however it is quoted, closed or
    nested (the text of an anchor inside another belongs to both); entities are decoded; other schemes than http go."""
    page = F.col("_page")
    target = lambda tag: bound(F.trim(attribute(tag, "href")), lambda href: F.when(href != "", resolve(F.col("url"), href)))
    link = lambda span, tag: F.struct(target(tag).alias("link_url"), F.trim(markup.text_of(page, span)).alias("text"), attribute(tag, "title").alias("title"), attribute(tag, "rel").alias("rel"))
    found = F.transform(markup.elements(page, "a"), lambda span: bound(F.get(page["tokens"], span["at"]), lambda tag: link(span, tag)))
    # read within the array, so that what follows the explode names plain columns
    out = pages.withColumn("_page", markup.parsed(F.col("html"))).select(F.col("url").alias("page_url"), F.explode(found).alias("link")).select("page_url", "link.*")
    return out.filter(F.lower("link_url").rlike("^https?://"))


def classify(links: DataFrame, reputation: DataFrame, substring_hosts: bool = False) -> DataFrame:
    """Adds link_host, source_host and kind. Hosts are matched exactly or as subdomains; substring_hosts restores the published
    containment. The first rule that fits decides; a reputation between -0.1 and 0.3 leaves it to the others."""
    hosts = links.withColumns({"link_host": urls.host(F.lower("link_url")), "source_host": urls.host(F.lower("page_url"))})
    known = reputation.select(F.col("domain").alias("link_host"), F.col("reputation_score").alias("_rep"))
    host, text, title, rep = F.col("link_host"), F.lower("text"), F.lower("title"), F.col("_rep")
    among = lambda names: _any([host.contains(x) if substring_hosts else (host == x) | host.endswith("." + x) for x in names])
    says = lambda c: _any([c.contains(p) for p in PHRASES])
    kind = (
        F.when(rep >= 0.3, "quality").when(rep < -0.5, "spam").when(rep < -0.1, "suspicious").when(among(SHORTENERS), "spam").when(says(text), "spam").when(says(title), "spam")
        .when(among(NEWS), "news").when(host == F.col("source_host"), "internal").when(host.rlike(r"\.(edu|gov|org)$"), "quality").when(host.rlike(r"\.(tk|ml|ga|cf|gq)$"), "suspicious")
        .when((F.length(text) < 3) | text.isin("click", "here", "link", "more", "read"), "low_quality").when(host.rlike(r"(?U)[^\w\s.-]"), "suspicious").otherwise("neutral")
    )
    return hosts.join(known, "link_host", "left").withColumn("kind", kind).drop("_rep")


def _any(conditions: list[Column]) -> Column:
    out = conditions[0]
    for c in conditions[1:]:
        out = out | c
    return out


def outlink_scores(pages: DataFrame, classified: DataFrame) -> DataFrame:
    """One row a page: link counts, ratios and trust; pages without links have zeros."""
    n = lambda k: F.count_if(F.col("kind") == k).alias(f"n_{k}")
    stats = classified.groupBy(F.col("page_url").alias("url")).agg(F.count("*").alias("total"), F.count_if(F.col("link_host") != F.col("source_host")).alias("external"), F.count_distinct("link_host").alias("hosts"), *[n(k) for k in KINDS])
    share = lambda *names: F.coalesce(sum(F.col(x) for x in names) / F.col("total"), F.lit(0.0))
    out = pages.select("url").distinct().join(stats, "url", "left").fillna(0)
    quality, bad, odd = share("n_quality", "n_news"), share("n_spam"), share("n_suspicious", "n_low_quality")
    variety, outside = F.least(share("hosts"), F.lit(1.0)), share("external")
    out = out.select("url", "total", "external", (F.col("total") - F.col("external")).alias("internal"), "hosts", *[F.when(F.col("total") > 0, c).otherwise(0.0).alias(a) for a, c in (("quality_ratio", quality), ("spam_ratio", bad + odd), ("diversity", variety), ("external_ratio", outside))], F.when(F.col("total") > 0, F.greatest(F.lit(0.0), F.least(F.lit(1.0), 0.4 * quality + 0.2 * variety + 0.2 * outside - 0.5 * bad - 0.3 * odd))).otherwise(0.0).alias("trust"))
    return out
