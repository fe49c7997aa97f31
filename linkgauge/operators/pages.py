"""Content features of page observations (url, status_code, html), read from the markup."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import markup
from ..functions.html import INSIDE, attribute, bound

# fixed values: phrases and patterns of the content rules
SPAM_PHRASES = ("click here", "free money", "make money fast", "guaranteed income", "work from home", "lose weight fast", "miracle cure", "limited time", "act now", "congratulations you won", "claim your prize", "no obligation")
CONTACT = r"(?i)contact|about|privacy|terms"
RIGHTS = r"(?i)copyright|©|\(c\)"
HIDDEN_STYLE = r"(?i)display:\s*none|visibility:\s*hidden"
POPUP = rf"(?is)^<script\b{INSIDE}>.*?(?:alert|popup|window\.open)"


def _n(text: Column, pattern: str) -> Column:
    return F.regexp_count(text, F.lit(pattern))


def _if(c: Column, w: float) -> Column:
    return F.when(c, w).otherwise(0.0)


def _with(tags: Column, name: str, value: str) -> Column:
    """Those of the tags whose attribute has a value, in any case."""
    return F.filter(tags, lambda t: F.lower(attribute(t["tag"], name)) == value)


def title_of(page: Column) -> Column:
    """Text of the first title; blank without one."""
    first = F.get(markup.elements(page, "title"), F.lit(0))
    return F.coalesce(bound(first, lambda span: F.trim(markup.text_of(page, span))), F.lit(""))


def description(page: Column) -> Column:
    """Content of the first meta tag named description; blank without one."""
    found = _with(markup.opening(page, "meta"), "name", "description")
    return F.coalesce(F.trim(attribute(F.get(found, F.lit(0))["tag"], "content")), F.lit(""))


def _sized(text: Column, low: int, high: int) -> Column:
    return bound(F.length(text), lambda n: F.when(n.between(low, high), 0.2).when(n > high, 0.1).otherwise(0.0))


def quality(page: Column) -> Column:
    """Of a parsed page. A paragraph inside another counts for both."""
    headings, images = F.size(markup.opening(page, "h1", "h2", "h3")), markup.opening(page, "img")
    words = markup.count_words(F.array_join(F.transform(markup.elements(page, "p"), lambda span: markup.text_of(page, span)), " "))
    named = F.size(F.filter(images, lambda t: attribute(t["tag"], "alt") != ""))
    links = F.size(F.filter(markup.opening(page, "a"), lambda t: markup.has_attribute(t["tag"], "href")))
    total = (
        _sized(title_of(page), 10, 60) + _sized(description(page), 50, 160)
        + _if(headings >= 1, 0.1) + _if(headings >= 3, 0.1) + bound(words, lambda n: F.when(n >= 300, 0.2).when(n >= 100, 0.1).otherwise(0.0))
        + F.when(F.size(images) > 0, named / F.size(images) * 0.1).otherwise(0.0) + _if(links >= 5, 0.1)
    )
    return F.least(total, F.lit(1.0))


def trust(page: Column, url: Column) -> Column:
    any_ = lambda tag, name, value: F.size(_with(markup.opening(page, tag), name, value)) > 0
    graph = F.exists(markup.opening(page, "meta"), lambda t: F.lower(attribute(t["tag"], "property")).contains("og:"))
    said = lambda pattern: F.size(F.filter(page["texts"], lambda t: t.rlike(pattern)))
    total = (
        _if(any_("meta", "name", "robots"), 0.1) + _if(any_("link", "rel", "canonical"), 0.1) + _if(any_("script", "type", "application/ld+json"), 0.2)
        + _if(graph, 0.1) + _if(any_("meta", "name", "twitter:card"), 0.1) + _if(F.lower(url).contains("https://"), 0.2)
        + _if(said(CONTACT) >= 2, 0.1) + _if(said(RIGHTS) >= 1, 0.1)
    )
    return F.least(total, F.lit(1.0))


def spam(page: Column, html: Column) -> Column:
    low, marks = F.lower(html), _n(html, "!")
    phrases = sum((F.when(low.contains(p), 1).otherwise(0) for p in SPAM_PHRASES), F.lit(0))
    secrets = _with(markup.opening(page, "input"), "type", "password")
    forms = F.size(F.filter(markup.elements(page, "form"), lambda span: F.size(F.filter(secrets, lambda t: t["at"].between(span["at"], span["end"]))) > 1))
    hidden = F.size(F.filter(markup.opening(page), lambda t: attribute(t["tag"], "style").rlike(HIDDEN_STYLE)))
    total = (
        F.least(phrases * 0.1, F.lit(0.5)) + F.least(_n(html, "[A-Z]{5,}") * 0.02, F.lit(0.3)) + F.when(marks > 10, F.least(marks * 0.01, F.lit(0.2))).otherwise(0.0)
        + _if(F.exists(markup.opening(page, "script"), lambda t: t["tag"].rlike(POPUP)), 0.2) + _if(F.size(_with(markup.opening(page, "meta"), "http-equiv", "refresh")) > 0, 0.3) + _if(hidden > 5, 0.2) + forms * 0.2
    )
    return F.least(total, F.lit(1.0))


def page_features(pages: DataFrame) -> DataFrame:
    """(url, has_content, content_quality, content_trust, content_spam, word_count, title, has_images, has_forms,
    content_length). Pages that are not there (null html, status not 200) count as spam, pages under 100 characters half."""
    html, there = F.coalesce("html", F.lit("")), F.coalesce(F.col("html").isNotNull() & (F.col("status_code") == 200), F.lit(False))
    whole = there & (F.length(html) >= 100)
    at = lambda c, other: F.when(whole, c).otherwise(other)
    page = F.col("_page")
    return pages.withColumn("_page", markup.parsed(F.col("html"))).select(
        "url", whole.alias("has_content"), at(quality(page), 0.0).alias("content_quality"), at(trust(page, F.col("url")), 0.0).alias("content_trust"),
        F.when(whole, spam(page, html)).when(there, 0.5).otherwise(1.0).alias("content_spam"), at(markup.count_words(markup.text(page)), 0).alias("word_count"), at(title_of(page), "").alias("title"),
        at(F.size(markup.opening(page, "img")) > 0, False).alias("has_images"), at(F.size(markup.opening(page, "form")) > 0, False).alias("has_forms"), at(F.length(html), 0).alias("content_length"),
    )
