"""Line dedup with a log-template tree of fixed depth.

A line goes down the tree by its token count and its LEAD leading tokens (tokens with a digit count as variable). In a
leaf, a token stays where it recurs in its place in at least `min_docs` documents and becomes the wildcard where it
varies, which yields the line's template. A template that at least `min_docs` documents hold, and of which enough is
constant, recurs: its lines are dropped from all documents but the first, so that nothing is lost altogether. A line that
has too many digits for any template is never taken as one; it recurs if at least `min_docs` documents hold it as it stands.

Texts are read three times and masked twice: once to hash every line, once for the tokens of one line of each kind in
leaves that hold several kinds, and once to leave out the lines that go, which are known by their places. Everything
between is counts and joins of hashes; equal lines are counted before any exchange, leaves are handled token by token, and
nothing is gathered that is longer than a line, or than the lines of one document. Texts are exchanged only where a
sieve of fixed size says that they may hold what is looked for.
"""

from __future__ import annotations

import re
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import ROW, cut_lineage, map_batches, replaced, row_key, shelf, sieve, sifted, text_bytes

WILDCARD = "<*>"
#: Documents that make a template recur, least tokens of a line, leading tokens in the tree, least constant share. Shorter
#: lines (headings, single words, braces) have no place for a variable field besides the leading tokens: they stay by definition.
MIN_DOCS, MIN_TOKENS, LEAD, CONSTANT = 3, 4, 3, 0.75

_DIGIT, _WILD = re.compile(rb"[0-9]").search, WILDCARD.encode()


def masked(line: bytes) -> list[bytes]:
    """The line's tokens (parted by ASCII white space), those with a digit as wildcards."""
    if _DIGIT(line):
        return [_WILD if _DIGIT(x) else x for x in line.split()]
    return line.split()


def sparse(words: list[bytes]) -> bool:
    """True if too little of a masked line is constant for a template."""
    n = words.count(_WILD)
    return n > 0 and len(words) - n < CONSTANT * len(words)


def _hash(words: list[bytes]) -> int:
    """Of a masked line, as a signed number."""
    value = xxhash.xxh3_64_intdigest(b" ".join(words))
    return value - (1 << 64) if value >> 63 else value


def _hash_lines(batches):
    """Of each line: its row, place, leaf and hash, whether the row holds it for the first time, and, if it is sparse, a
    hash of the line as it stands."""
    names = ["doc_id", *ROW, "at", "leaf", "line", "once", "raw"]
    for batch in batches:
        owner, at, leaf, lines, once, raw = [], [], [], [], [], []
        for row, text in enumerate(text_bytes(batch)):
            seen = set()
            for i, line in enumerate(text.split(b"\n")):
                words = masked(line)
                if len(words) < MIN_TOKENS:
                    continue
                own = _hash(words)
                owner.append(row)
                at.append(i)
                leaf.append(xxhash.xxh3_64_intdigest(b" ".join(words[:LEAD]), len(words)))
                lines.append(own)
                once.append(own not in seen)
                seen.add(own)
                raw.append(xxhash.xxh3_128_digest(b" ".join(line.split())) if sparse(words) else None)
        rows = pa.array(owner, pa.int64())
        yield pa.RecordBatch.from_arrays([*[batch.column(i).take(rows) for i in range(3)], pa.array(at, pa.int32()), pa.array(np.array(leaf, np.uint64).view(np.int64)), pa.array(lines, pa.int64()), pa.array(once, pa.bool_()), pa.array(raw, pa.binary())], names)


def hashed_lines(docs: DataFrame) -> DataFrame:
    """(doc_id, row_a, row_b, at, leaf, line, once, raw) of every line of MIN_TOKENS or more tokens. Null texts have none."""
    rows = docs.filter(F.col("text").isNotNull()).select("doc_id", *row_key("doc_id", "text"), "text")
    return map_batches(rows, _hash_lines, f"doc_id {dict(rows.dtypes)['doc_id']}, row_a long, row_b long, at int, leaf long, line long, once boolean, raw binary")


def _wanted_lines(docs: DataFrame, wanted: DataFrame, get, kind: pa.DataType) -> DataFrame:
    """(leaf, line, got) for wanted (row_a, leaf, line): got is get(tokens of the masked line)."""
    lines = wanted.groupBy("row_a").agg(F.collect_list(F.struct("leaf", "line")).alias("wanted"))  # at most a document's lines
    rows = docs.filter(F.col("text").isNotNull()).select(*row_key("doc_id", "text")[:1], "text")
    rows = sifted(rows, sieve(wanted, "row_a"), "row_a")[0].join(lines, "row_a").select("text", "wanted")

    def run(batches):
        for batch in batches:
            leaf, line, got = [], [], []
            for text, own in zip(text_bytes(batch), batch.column(1).to_pylist(), strict=True):
                own = {p["line"]: p["leaf"] for p in own}
                for words in map(masked, text.split(b"\n")):
                    if len(words) >= MIN_TOKENS and (of := own.pop(_hash(words), None)) is not None:
                        leaf.append(of)
                        line.append(_hash(words))
                        got.append(get(words))
            yield pa.RecordBatch.from_arrays([pa.array(leaf, pa.int64()), pa.array(line, pa.int64()), pa.array(got, pa.list_(kind))], ["leaf", "line", "got"])

    simple = {pa.int64(): "long", pa.string(): "string"}[kind]
    return map_batches(rows, run, f"leaf long, line long, got array<{simple}>").groupBy("leaf", "line").agg(F.any_value("got").alias("got"))


def _token_hashes(words: list[bytes]) -> np.ndarray:
    """0 for the wildcard."""
    return np.array([0 if x == _WILD else xxhash.xxh3_64_intdigest(x) for x in words], np.uint64).view(np.int64)


def _holders(hashed: DataFrame, counted: DataFrame, enough: int, put) -> DataFrame:
    """(leaf, line, who): hashes of up to `enough` different documents that hold each line. Whether a set of lines is held
    by `enough` documents in all is thereby told exactly: a line that has left any out has enough by itself."""
    several = put(counted.filter("who <> whom").select("leaf", "line"))
    held = sifted(hashed, sieve(several, "line"), "line")[0].join(several, ["leaf", "line"]).select("leaf", "line", _who("doc_id")).distinct()
    order = Window.partitionBy("leaf", "line").orderBy("who")
    some = held.withColumn("nth", F.row_number().over(order)).filter(F.col("nth") <= enough).drop("nth")
    return put(some.union(counted.filter("who = whom").select("leaf", "line", "who")))


def _who(doc_id: str) -> Column:
    """A document by its id; a null id is one document."""
    return F.xxhash64(doc_id).alias("who")


def _recurring(docs: DataFrame, hashed: DataFrame, min_docs: int, put) -> DataFrame:
    """(leaf, line, kept, template, first, row_a) of every masked line whose template recurs: which of its tokens the template
    keeps (null for all), a hash of the template, the least id of the documents that hold it, and a row that holds the line.
    Documents are counted once, however many lines and repeated rows they have of a token or template."""
    who = _who("doc_id")
    counted = put(hashed.groupBy("leaf", "line").agg(F.min(who).alias("who"), F.max(who).alias("whom"), F.count_if("once").alias("docs"), F.min("doc_id").alias("first"), F.max(F.col("raw").isNotNull()).alias("sparse"), F.min("row_a").alias("row_a")))
    leaves = counted.groupBy("leaf").agg(F.sum("docs").alias("in_leaf"), F.count("*").alias("kinds")).filter(F.col("in_leaf") >= min_docs)
    counted = put(counted.join(leaves.drop("in_leaf"), "leaf").drop("docs"))
    holders = _holders(hashed, counted, min_docs, put)
    enough = F.count("*") >= min_docs
    many = holders.groupBy("leaf", "line").agg(enough.alias("enough")).filter("enough").drop("enough")
    alone = counted.filter("kinds = 1 and not sparse").join(many, ["leaf", "line"]).select("leaf", "line", F.lit(None).cast("array<boolean>").alias("kept"), F.col("line").alias("template"), "first", "row_a")

    several = counted.filter("kinds > 1")
    words = _wanted_lines(docs, several.select("row_a", "leaf", "line"), _token_hashes, pa.int64())
    several = put(several.select("leaf", "line", "first", "row_a").join(words, ["leaf", "line"]))
    votes = several.select("leaf", "line", "got").join(holders, ["leaf", "line"]).select("leaf", "who", F.posexplode("got").alias("at", "token")).distinct()
    steady = votes.groupBy("leaf", "at", "token").agg(enough.alias("kept")).filter("kept")
    tokens = several.select("leaf", "line", F.posexplode("got").alias("at", "token"))
    flags = tokens.join(steady, ["leaf", "at", "token"], "left").groupBy("leaf", "line").agg(F.array_sort(F.collect_list(F.struct("at", (F.coalesce("kept", F.lit(False)) & (F.col("token") != 0)).alias("kept"))))["kept"].alias("kept"))
    shaped = several.join(flags, ["leaf", "line"]).filter(F.size(F.filter("kept", lambda x: x)) >= CONSTANT * F.size("kept"))
    shaped = put(shaped.withColumn("template", F.xxhash64(F.zip_with("got", "kept", lambda word, kept: F.when(kept, word).otherwise(0)))).drop("got"))
    held = shaped.select("leaf", "line", "template").join(holders, ["leaf", "line"]).select("leaf", "template", "who").distinct()
    wide = held.groupBy("leaf", "template").agg(enough.alias("enough")).filter("enough").drop("enough")
    totals = shaped.groupBy("leaf", "template").agg(F.min("first").alias("first")).join(wide, ["leaf", "template"])
    return alone.unionByName(shaped.drop("first").join(totals, ["leaf", "template"]))


def templates(docs: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """(template, docs, first) of every recurring template, as text, with the number of documents that hold it and the least
    id of these; lines that recur as they stand are not among them."""
    with shelf(docs.sparkSession) as put:
        hashed = put(hashed_lines(docs))
        put = partial(put, rows=hashed.count())
        found = put(_recurring(docs, hashed, min_docs, put))
        lines = _wanted_lines(docs, found.select("row_a", "leaf", "line"), lambda words: [x.decode() for x in words], pa.string())
        words = F.when(F.col("kept").isNull(), F.col("got")).otherwise(F.zip_with("got", "kept", lambda word, kept: F.when(kept, word).otherwise(WILDCARD)))
        counts = hashed.join(found.select("leaf", "line", "template"), ["leaf", "line"]).select("leaf", "template", _who("doc_id")).distinct().groupBy("leaf", "template").agg(F.count("*").alias("docs"))
        named = found.join(lines, ["leaf", "line"]).join(counts.withColumnRenamed("template", "id"), [found["leaf"] == counts["leaf"], found["template"] == F.col("id")])
        return cut_lineage(named.select(F.array_join(words, " ").alias("template"), "docs", "first").distinct())


def repeated(hashed: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """(raw, first) of the sparse lines that recur as they stand: each document counts once."""
    once = hashed.filter("raw is not null").select("raw", "doc_id").distinct()
    return once.groupBy("raw").agg(F.count("*").alias("docs"), F.min("doc_id").alias("first")).filter(F.col("docs") >= min_docs).drop("docs")


def dropped_places(docs: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """(row_a, row_b, places): the places of the lines that go, of each row that loses any."""
    with shelf(docs.sparkSession) as put:
        hashed = put(hashed_lines(docs))
        lines = hashed.count()
        put = partial(put, rows=lines)
        found = put(_recurring(docs, hashed, min_docs, put).select("leaf", "line", "first"))
        own = sifted(hashed.filter("raw is null"), sieve(found, "line"), "line")[0].join(found, ["leaf", "line"])
        raw = hashed.filter("raw is not null").join(repeated(hashed, min_docs), "raw")
        gone = own.select("doc_id", "first", *ROW, "at").union(raw.select("doc_id", "first", *ROW, "at")).filter(~F.col("doc_id").eqNullSafe(F.col("first")))
        return cut_lineage(gone.groupBy(*ROW).agg(F.collect_set("at").alias("places")), lines)


def _cleaned(docs: DataFrame, min_docs: int) -> DataFrame:
    """(doc, text, n_lines, n_dropped): doc holds all columns but the text, under whatever names."""
    gone = dropped_places(docs, min_docs)
    wide = docs.select(F.struct(*[c for c in docs.columns if c != "text"]).alias("doc"), "text", *row_key("doc_id", "text"))
    hit, clean = sifted(wide, sieve(gone, "row_a"), "row_a")
    n = F.coalesce(F.length("text") - F.length(F.replace("text", F.lit("\n"), F.lit(""))) + 1, F.lit(0)).cast("long").alias("n_lines")
    hit = hit.join(gone, ROW, "left").select("doc", "text", n, F.coalesce(F.size("places"), F.lit(0)).cast("long").alias("n_dropped"), "places")

    def run(batches):
        for batch in batches:
            out = []
            for text, places in zip(text_bytes(batch), batch.column(4).to_pylist(), strict=True):
                if places:
                    own = set(places)
                    text = b"\n".join(x for i, x in enumerate(text.split(b"\n")) if i not in own)
                out.append(text)
            yield replaced(batch, pa.schema([batch.schema.field(i) for i in range(4)]), text=pa.array(out, pa.binary()).cast(pa.string()))

    kept = map_batches(hit, run, hit.drop("places").schema)
    return kept.union(clean.select("doc", "text", n, F.lit(0).cast("long")))


def _columns(names: list[str], **own: Column) -> list[Column]:
    return [own[c].alias(c) if c in own else F.col("doc").getField(c).alias(c) for c in names]


def drop_recurring(docs: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """docs, all columns, with two more: `_lines` (number of lines) and `_dropped` (lines dropped), and the text without them.

    A line stays in the document with the least id among those that hold its template (in repeated rows of that document
    too), and wherever it has fewer than MIN_TOKENS tokens. Null texts stay null with no lines; a text may become empty.
    Repeated rows are treated alike. Columns of docs named `_lines` or `_dropped` are replaced; other names may be anything."""
    names = [c for c in docs.columns if c not in ("_lines", "_dropped")]
    rows = _cleaned(docs.select(*names), min_docs)
    return rows.select(*_columns(names, text=F.col("text")), F.col("n_lines").alias("_lines"), F.col("n_dropped").alias("_dropped"))


def drop_lines(docs: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """docs, with its columns, whatever their names, without recurring lines; rows of which no other word is left go. n_chars
    follows the text. Rows that lose no line stay as they are, null and empty texts too."""
    rows = _cleaned(docs, min_docs).filter((F.col("n_dropped") == 0) | F.col("text").rlike(r"\S"))
    own = {"text": F.col("text")}
    if "n_chars" in docs.columns:
        own["n_chars"] = F.when(F.col("n_dropped") > 0, F.length("text")).otherwise(F.col("doc.n_chars")).cast(dict(docs.dtypes)["n_chars"])
    return rows.select(*_columns(docs.columns, **own))
