"""The markup fold against a plain parser of the standard library."""

import html as entities
import random
from html.parser import HTMLParser

from pyspark.sql import functions as F

from linkgauge.functions import markup
from linkgauge.functions.html import unescape
from linkgauge.operators import links


class Tree(HTMLParser):
    """Texts of p and a elements by the order of their start tags; an end tag closes the nearest open element of its name."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.open, self.found, self.hidden = [], [], False

    def handle_starttag(self, tag, attrs):
        self.hidden = tag in ("script", "style")
        if tag not in markup.VOID:
            self.found.append([tag, dict(attrs), ""])
            self.open.append(self.found[-1])

    def handle_startendtag(self, tag, attrs):
        if tag not in markup.VOID:
            self.found.append([tag, dict(attrs), ""])

    def handle_endtag(self, tag):
        self.hidden = False
        if tag in [x[0] for x in self.open]:
            while self.open.pop()[0] != tag:
                pass

    def handle_data(self, data):
        for x in self.open:
            x[2] += "" if self.hidden else data


def parsed(page):
    tree = Tree()
    tree.feed(page)
    tree.close()
    return tree.found


def pages():
    rng = random.Random(11)
    parts = ["<p>", "<p class='a>b'>", "</p>", "<div>", "</div>", "<b>", "</b>", "</i>", "<br>", "<img alt='>' src=x>", '<a href="/u?x=1&amp;y=2">', "<a href=/v>", "</a>", "<a name=n>", "<p/>", "<a href='/w'/>",
             "word ", "more words ", "&amp;lt; ", "&#233;", "&#xE9; ", "<!-- <p>no</p> -->", "<script>var x = '<p>no</p>';</script>", "<style>p{}</style>", "3 > 2 ", "<input>", "<span title=\"q '>' q\">", "</span>"]
    return ["".join(rng.choices(parts, k=rng.randint(0, 60))) for _ in range(300)] + ["", "<p>a<p>b</div>c", "</p>x", "<a href=/1>x<a href=/2>y</a>z</a>", "<div><p>in</div>out</p>", "<p" + ">x" * 3, "<p>" * 200 + "deep"]


def test_elements_against_a_parser(spark):
    texts = pages()
    rows = spark.createDataFrame(list(enumerate(texts)), "id int, html string").repartition(4)
    page = markup.parsed(F.col("html"))
    found = rows.withColumn("page", page).select("id", F.transform(markup.elements(F.col("page"), "p"), lambda s: markup.text_of(F.col("page"), s)).alias("p"), F.transform(markup.elements(F.col("page"), "a"), lambda s: markup.text_of(F.col("page"), s)).alias("a"))
    for r in found.collect():
        tree = parsed(texts[r.id])
        assert r.p == [x[2] for x in tree if x[0] == "p"], texts[r.id]
        assert r.a == [x[2] for x in tree if x[0] == "a"], texts[r.id]


def test_links_against_a_parser(spark):
    texts = pages()
    rows = spark.createDataFrame([(f"http://h{i}.org/", t) for i, t in enumerate(texts)], "url string, html string").repartition(4)
    got = sorted((r.page_url, r.link_url, r.text) for r in links.extract(rows).collect())
    expected = [(f"http://h{i}.org/", f"http://h{i}.org{x[1]['href']}", x[2].strip(" ")) for i, t in enumerate(texts) for x in parsed(t) if x[0] == "a" and x[1].get("href")]
    assert got == sorted(expected) and len(got) > 300


def test_entities_against_the_standard_library(spark):
    texts = ["&amp;lt; &lt;&gt;&quot;&apos;", "&#65;&#x41;&#X41;&#0;&#128;&#x9f;&#1114112;&#xD800;&#x1F600;", "&euro;&hellip;&nbsp;&szlig;&yuml;&Agrave;&frac34;", "a & b &; &unknownname; &#; &#x;", "", "plain"]
    rows = spark.createDataFrame([(t,) for t in [*texts, None]], "t string").select("t", unescape(F.col("t")).alias("u")).collect()
    assert {r.t: r.u for r in rows} == {t: entities.unescape(t) for t in texts} | {None: None}
