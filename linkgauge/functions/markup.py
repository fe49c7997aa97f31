"""Markup as a stream of tokens, folded over a stack of open elements, as native columns.

A page is split into tags, texts, comments and whole script and style elements. Folding over its tags keeps the elements that are
open: an end tag closes the nearest open element of its name with all that is open inside; one that fits no open element
changes nothing; what is open at the end ends there. Elements may thus be left unclosed or stand inside their like, and a tag
may hold `>` in quotes. The fold's work grows with tags times depth, and with the square of the elements that are kept.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .html import INSIDE, VALUE, bound, unescape

TOKEN = rf"(?is)<!--.*?-->|<(script|style)\b{INSIDE}>.*?</\1\s*>|</?[a-z]{INSIDE}>|<[!?][^>]*>|[^<]++|<"
# fixed values: elements without content
VOID = ("area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr", "script", "style")
#: Elements whose extent is kept.
KEPT = ("title", "p", "a", "form")
_STACK, _SPANS = "array<struct<name:string,at:int>>", "array<struct<at:int,end:int,name:string>>"


def _tags(tokens: Column) -> Column:
    """(tag, name, at, closing, empty) of the tags among tokens; at counts tokens from 0."""
    name = lambda t: F.lower(F.regexp_extract(t, r"^</?([a-zA-Z][^\s/>]*)", 1))
    of = lambda t, i: F.struct(t.alias("tag"), name(t).alias("name"), i.alias("at"), t.startswith("</").alias("closing"), t.endswith("/>").alias("empty"))
    return F.filter(F.transform(tokens, lambda t, i: F.when(t.startswith("<"), of(t, i))), lambda x: x["name"] != "")


def _step(state: Column, tag: Column) -> Column:
    stack, spans, kept = state["stack"], state["spans"], tag["name"].isin(*KEPT)
    state_of = lambda stack, spans: F.struct(stack.alias("stack"), spans.alias("spans"))
    back = F.array_position(F.reverse(stack["name"]), tag["name"]).cast("int")  # how many elements it closes
    left = F.size(stack) - back
    ended = F.transform(F.filter(F.slice(stack, left + 1, back), lambda x: x["name"].isin(*KEPT)), lambda x: F.struct(x["at"].alias("at"), tag["at"].alias("end"), x["name"].alias("name")))
    alone = F.array(F.struct(tag["at"].alias("at"), (tag["at"] + 1).alias("end"), tag["name"].alias("name")))
    return (
        F.when(tag["closing"], F.when(back > 0, state_of(F.slice(stack, F.lit(1), left), F.concat(spans, ended))).otherwise(state))
        .when(tag["empty"], F.when(kept, state_of(stack, F.concat(spans, alone))).otherwise(state))
        .otherwise(state_of(F.concat(stack, F.array(F.struct(tag["name"].alias("name"), tag["at"].alias("at")))), spans))
    )


def _spans(tags: Column, size: Column) -> Column:
    start = F.struct(F.array().cast(_STACK).alias("stack"), F.array().cast(_SPANS).alias("spans"))
    rest = lambda s: F.transform(F.filter(s["stack"], lambda x: x["name"].isin(*KEPT)), lambda x: F.struct(x["at"].alias("at"), size.alias("end"), x["name"].alias("name")))
    return F.aggregate(F.filter(tags, lambda t: ~t["name"].isin(*VOID)), start, _step, lambda s: F.array_sort(F.concat(s["spans"], rest(s))))


def parsed(html: Column) -> Column:
    """(tokens, texts, tags, spans) of a page: texts has a place for each token, blank where it is no text, entities decoded; spans
    are the extents (at, end, name) of the KEPT elements in order of their start, in tokens. A null page has none of them."""
    texts = lambda tokens: F.transform(tokens, lambda t: F.when(t.startswith("<") & (t != "<"), "").otherwise(unescape(t)))
    whole = lambda tokens: bound(_tags(tokens), lambda tags: F.struct(tokens.alias("tokens"), texts(tokens).alias("texts"), tags.alias("tags"), _spans(tags, F.size(tokens)).alias("spans")))
    return bound(F.regexp_extract_all(F.coalesce(html, F.lit("")), F.lit(TOKEN), F.lit(0)), whole)


def elements(page: Column, name: str) -> Column:
    """Extents of the elements of a name, one of KEPT."""
    return F.filter(page["spans"], lambda s: s["name"] == name)


def text_of(page: Column, span: Column) -> Column:
    """All text inside an element."""
    return F.array_join(F.slice(page["texts"], span["at"] + 1, span["end"] - span["at"]), "")


def text(page: Column) -> Column:
    return F.array_join(page["texts"], "")


def opening(page: Column, *names: str) -> Column:
    """The start tags of some names, in order; of all if none is given."""
    return F.filter(page["tags"], lambda t: ~t["closing"] & (t["name"].isin(*names) if names else F.lit(True)))


def has_attribute(tag: Column, name: str) -> Column:
    return tag.rlike(rf"""(?is)^<(?:[^>"']|"[^"]*+"|'[^']*+')*?\s{name}\s*=\s*{VALUE}?""")


def count_words(text: Column) -> Column:
    """Parted by white space, no-break spaces included."""
    return F.regexp_count(text, F.lit(r"[^\s\u00a0]+"))
