"""Near-duplicate classes over word shingles: DartMinHash signatures, banded candidates, exact verification.

A text is a weighted set: a shingle weighs as often as it occurs. Similarity is the weighted Jaccard similarity, the sum of
the lesser weights over the sum of the greater ones.

1. Texts that are equal word for word collapse into one node, counted before any exchange.
2. Each node gets a DartMinHash signature of its weighted shingles; nodes that agree in all coordinates of a band share a bucket.
3. In every bucket each node is compared with the bucket's pivot alone: no pairs within the group. The pivot is the node
   whose buckets hold the most nodes in all, which is the text that the others are variants of, if there is one. Links
   are exact Jaccard similarities of at least `least`, and connected nodes form a class.
4. Buckets that still hold several classes are taken up again; only pairs of different classes are looked for, so no
   candidate link that would join two classes is lost. In buckets of up to CROWD nodes, those outside the largest class
   meet the nodes of other classes. The nodes of larger buckets, which mostly share a common passage and nothing else, are
   paired by prefix filtering instead: of two sets with a link, the shingles that come first in an order with frequent ones last
   share one, early enough for the rest to make up the link. Frequent passages thus make no pairs.
5. A pair is passed over if longer signatures agree in so few coordinates that a link is out of the question (4.5 standard
   deviations); the others are compared exactly.

Texts are exchanged only to make the shingle sets of nodes that share a bucket, and to drop or keep rows that a sieve of
fixed size cannot tell. With BANDS bands of ROWS coordinates a pair at similarity 0.8 shares no bucket with a probability of 3 in 100,000.
"""

from __future__ import annotations

import math
import re
from functools import partial

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ROW, cut_lineage, map_batches, passes, row_key, sent, shelf, sieve, sifted, texts
from .darts import band_keys, mix, signatures

WORDS, LEAST = 5, 0.8
BANDS, ROWS = 20, 4
#: Coordinates of the longer signature that pairs across classes must agree in before they are compared.
MARKS = 256
#: Nodes of a bucket that meet each other, and nodes that make a shingle a frequent one in larger buckets.
CROWD, FREQUENT = 64, 32
#: Shingles whose signatures are computed together, and word hashes that a task remembers.
TOGETHER, REMEMBERED = 50_000, 100_000


#: Below U+0300 there are no marks, and the standard module is faster.
_NARROW, _WIDE, _MARKS = re.compile(r"[^\W_]+"), re.compile("[^\x00-\u02ff]"), regex.compile(r"[\p{L}\p{M}\p{N}]+")


def words_of(text: str | None) -> list[str]:
    """Lower-case words (runs of letters, marks and digits); null has none."""
    low = (text or "").lower()
    return (_MARKS if _WIDE.search(low) else _NARROW).findall(low)


class _Words(dict):
    def __missing__(self, word: str) -> int:
        value = xxhash.xxh64_intdigest(word)
        if len(self) < REMEMBERED:
            self[word] = value
        return value


def shingles(own: list[str], words: _Words, size: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the distinct runs of `size` words (of the whole text if it has fewer), sorted, and how often each occurs."""
    if not own:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    own = np.array([*map(words.__getitem__, own)], np.uint64)
    size = min(size, len(own))
    out = np.zeros(len(own) - size + 1, np.uint64)
    for i in range(size):
        out = mix(out * np.uint64(31) + own[i : len(own) - size + 1 + i])
    return np.unique(out, return_counts=True)


def weighted(elements: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """A plain set for a set weighted with whole numbers: an element for each unit of weight, so that plain similarities of
    these sets are the weighted ones of the others."""
    more = np.repeat(np.arange(len(counts)), counts - 1)
    if not len(more):
        return elements
    nth = np.arange(len(more)) - np.repeat(np.cumsum(counts - 1) - (counts - 1), counts - 1)
    return np.concatenate([elements, mix(elements[more] ^ mix(nth.astype(np.uint64) + np.uint64(1)))])


def _bands(batches):
    """(doc_id, row_a, row_b, node, bands) of each row; texts without words have no bands."""
    words = _Words()
    for batch in batches:
        nodes, sets = [], []
        for text in texts(batch):  # one text's words at a time
            own = words_of(text)
            nodes.append(xxhash.xxh3_128_digest(" ".join(own)))
            sets.append(shingles(own, words))
        sizes = [int(s[1].sum()) for s in sets]
        keys, i = [], 0
        while i < len(sets):
            j, n = i, 0
            while j < len(sets) and (j == i or n + sizes[j] <= TOGETHER):
                n, j = n + sizes[j], j + 1
            elements, weights = (np.concatenate([s[x] for s in sets[i:j]]) for x in (0, 1))
            keys.append(band_keys(signatures(elements, weights.astype(np.float64), np.array([len(s[0]) for s in sets[i:j]]), BANDS * ROWS), BANDS))
            i = j
        keys = np.concatenate(keys) if keys else np.zeros((0, BANDS), np.int64)
        held = np.array([len(s[0]) > 0 for s in sets], bool)
        offsets = np.concatenate([[0], np.cumsum(held * BANDS)])
        bands = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(keys[held].ravel(), pa.int64()))
        yield pa.RecordBatch.from_arrays([*[batch.column(i) for i in range(3)], pa.array(nodes, pa.binary()), bands], ["doc_id", *ROW, "node", "bands"])


def _sets(batches):
    words = _Words()
    for batch in batches:
        found = [weighted(*shingles(words_of(t), words)).view(np.int64) for t in texts(batch)]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(pa.int64()))], ["node", "shingles"])


def _marks(batches):
    """(node, marks): a byte of each coordinate of a longer signature."""
    for batch in batches:
        sets = [np.array(x, np.int64).view(np.uint64) for x in batch.column(1).to_pylist()]
        for i in range(0, len(sets), 64):
            own = sets[i : i + 64]
            found = signatures(np.concatenate(own), np.ones(sum(map(len, own))), np.array([len(x) for x in own]), MARKS)
            marks = pa.ListArray.from_arrays(pa.array(np.arange(len(own) + 1) * MARKS, pa.int32()), pa.array((found >> np.uint64(56)).astype(np.uint8).view(np.int8).ravel(), pa.int8()))
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, 64), marks], ["node", "marks"])


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """pairs (a, b) with their exact Jaccard similarity."""
    left, right = sets.select(F.col("node").alias("a"), F.col("shingles").alias("x")), sets.select(F.col("node").alias("b"), F.col("shingles").alias("y"))
    both = F.size(F.array_intersect("x", "y"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", (both / (F.size("x") + F.size("y") - both)).alias("sim"))


def components(edges: DataFrame) -> DataFrame:
    """(node, label) of every node of edges (a, b): the least node of its component.

    Each turn takes the least label among the neighbours and then that label's own label, so the turns grow with the
    logarithm of a chain's length. Labels are checkpointed; only the count of changes reaches the driver."""
    most = 2 * edges.count()
    ends = cut_lineage(edges.select("a", "b").union(edges.select("b", "a")).filter("a <> b").distinct(), most)
    labels = cut_lineage(ends.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("label")).withColumnRenamed("a", "node"), most)
    while True:
        near = ends.join(labels.select(F.col("node").alias("b"), "label"), "b").groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near"))
        step = labels.join(near, "node").select("node", F.col("label").alias("before"), F.least("label", "near").alias("label"))
        jump = labels.select(F.col("node").alias("label"), F.col("label").alias("beyond"))
        step = cut_lineage(step.join(jump, "label").select("node", "before", F.least("label", "beyond").alias("label")), most)
        labels = step.select("node", "label")
        if step.filter("before <> label").isEmpty():
            return labels


def _met(rows: DataFrame, key: str, condition=None) -> DataFrame:
    """Pairs (a, b) of nodes of different classes that share a key of rows (key, node, label, ...), each once. For each key, nodes
    outside the largest class meet those of other classes."""
    parts = rows.groupBy(key, "label").agg(F.count("*").alias("n")).groupBy(key).agg(F.max(F.struct("n", "label"))["label"].alias("main"), F.count("*").alias("labels"))
    mixed = rows.join(parts.filter("labels > 1").drop("labels"), key)
    x, y = mixed.filter("label <> main").alias("x"), mixed.alias("y")
    other = (F.col("y.label") == F.col("y.main")) | (F.col("x.label") < F.col("y.label"))
    pairs = x.join(y, (F.col(f"x.{key}") == F.col(f"y.{key}")) & other & (F.lit(True) if condition is None else condition))
    return pairs.select(F.greatest("x.node", "y.node").alias("a"), F.least("x.node", "y.node").alias("b")).distinct()


def _prefixes(rows: DataFrame, again, hot, least: float) -> DataFrame:
    """(token, node, label, size, at, inner) of the first shingles of each set (node, label, shingles) by an order with frequent ones
    last: so many that one of two linked sets must hold one of the other's, of which the shorter set's is an inner one.
    Shingles of one set alone are left out."""
    bits, size_of, hot_bits, hot_size = sent(again), again.size, sent(hot), hot.size

    def run(batches):
        for batch in batches:
            tokens, owner, sizes, at, inner = [], [], [], [], []
            for i, own in enumerate(batch.column(2).to_pylist()):
                own = np.array(own, np.int64)
                n = len(own)
                own = own[np.lexsort((own, passes(hot_bits.value, hot_size, own)))][: n - math.ceil(least * n - 1e-9) + 1]
                kept = np.flatnonzero(passes(bits.value, size_of, own))
                tokens.append(own[kept])
                owner.append(np.full(len(kept), i))
                sizes.append(np.full(len(kept), n))
                at.append(kept)
                inner.append(kept < n - math.ceil(2 * least / (1 + least) * n - 1e-9) + 1)
            owner, *rest = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (owner, tokens, sizes, at, inner))
            of = pa.array(owner.astype(np.int64))
            tokens, sizes, at = (pa.array(x, pa.int64()) for x in rest[:3])
            yield pa.RecordBatch.from_arrays([tokens, batch.column(0).take(of), batch.column(1).take(of), sizes, at, pa.array(rest[3].astype(bool))], ["token", "node", "label", "size", "at", "inner"])

    return map_batches(rows, run, "token long, node binary, label binary, size long, at long, inner boolean")


def _crowded(nodes: DataFrame, sets: DataFrame, least: float, put) -> DataFrame:
    """Pairs (a, b) of different classes among nodes (node, label) that may be linked, by prefix filtering."""
    own = put(sets.join(nodes, "node").select("node", "label", "shingles")).repartition("node")  # so that no task opens many sets
    counts = put(own.select(F.explode("shingles").alias("token")).groupBy("token").agg(F.count("*").alias("n")).filter("n > 1"))
    rows = put(_prefixes(own, sieve(counts, "token"), sieve(counts.filter(F.col("n") >= FREQUENT), "token"), least))
    x, y = (lambda c: F.col(f"x.{c}")), (lambda c: F.col(f"y.{c}"))
    early = ((x("size") <= y("size")) & x("inner")) | ((y("size") <= x("size")) & y("inner"))
    enough = F.least(x("size") - x("at"), y("size") - y("at")) >= least / (1 + least) * (x("size") + y("size")) - 1e-6
    return _met(rows, "token", early & enough)


def _likely(pairs: DataFrame, sets: DataFrame, least: float, put) -> DataFrame:
    """The pairs whose longer signatures leave a link possible."""
    nodes = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
    marks = put(map_batches(sets.join(nodes, "node").select("node", "shingles"), _marks, "node binary, marks array<byte>"))
    both = pairs.join(marks.select(F.col("node").alias("a"), F.col("marks").alias("x")), "a").join(marks.select(F.col("node").alias("b"), F.col("marks").alias("y")), "b")
    agree = F.aggregate(F.zip_with("x", "y", lambda p, q: F.when(p == q, 1).otherwise(0)), F.lit(0), lambda n, one: n + one)
    return both.filter(agree >= int(MARKS * least - 4.5 * (MARKS * least * (1 - least)) ** 0.5)).select("a", "b")


def node_classes(docs: DataFrame, least: float, put, crowd: int = CROWD) -> tuple[DataFrame, DataFrame]:
    """(doc_id, row_a, row_b, node, n_bands) of every row of docs, and (node, class_id, first, row_a, row_b) of every node:
    class_id is the least doc_id of its class, first the least of the node's own rows, of which row_a and row_b tell one."""
    texts_ = docs.select("doc_id", *row_key("doc_id", "text"), "text")
    kind = dict(texts_.dtypes)["doc_id"]
    rows = put(map_batches(texts_, _bands, f"doc_id {kind}, row_a long, row_b long, node binary, bands array<long>"))
    put = partial(put, rows=BANDS * rows.count())  # what is stored grows with the rows' bands
    known = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", *ROW)  # a row with an id goes before one without
    nodes = put(rows.groupBy("node").agg(F.min(known).alias("first"), F.any_value("bands").alias("bands")).select("node", F.col("first.doc_id").alias("first"), "first.row_a", "first.row_b", "bands"))
    held = nodes.select("node", F.explode("bands").alias("key"))
    sizes = held.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1")
    shared = put(held.join(sizes, "key"))
    central = shared.groupBy("node").agg(F.sum("n").alias("central"))
    pivots = shared.join(central, "node").groupBy("key").agg(F.max(F.struct("central", "node"))["node"].alias("pivot"))
    shared = put(shared.select("key", "node", "n").join(pivots, "key"))
    stars = shared.filter("node <> pivot").select(F.col("node").alias("a"), F.col("pivot").alias("b")).distinct()

    wanted = put(shared.select("node").distinct().join(nodes.select("node", *ROW), "node"))
    chosen = sifted(texts_, sieve(wanted, "row_a"), "row_a")[0].join(wanted, ROW).select("node", "text")
    sets = put(map_batches(chosen, _sets, "node binary, shingles array<long>").dropDuplicates(["node"]))

    first = put(_verified(stars, sets))
    links = first.filter(F.col("sim") >= least)
    labels = components(links)

    apart = put(shared.join(labels, "node", "left").select("key", "node", "n", F.coalesce("label", "node").alias("label")))
    several = apart.groupBy("key").agg(F.min("label").alias("one"), F.max("label").alias("other"), F.max("n").alias("n")).filter("one <> other")
    crowded = apart.drop("n").join(several.filter(F.col("n") > crowd).select("key"), "key").select("node", "label").distinct()
    pairs = _met(apart.filter(F.col("n") <= crowd), "key").union(_crowded(crowded, sets, least, put)).distinct()
    pairs = put(pairs.join(first.select("a", "b"), ["a", "b"], "left_anti").join(first.select(F.col("a").alias("b"), F.col("b").alias("a")), ["a", "b"], "left_anti"))
    joined = put(_verified(put(_likely(pairs, sets, least, put)), sets).filter(F.col("sim") >= least))
    if not joined.isEmpty():
        labels = components(links.select("a", "b").union(joined.select("a", "b")))

    labelled = nodes.drop("bands").join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    firsts = labelled.groupBy("label").agg(F.min("first").alias("class_id"))
    return rows.select("doc_id", *ROW, "node", F.size("bands").alias("n_bands")), labelled.join(firsts, "label").select("node", "class_id", "first", *ROW)


def classes(docs: DataFrame, least: float = LEAST) -> DataFrame:
    """(doc_id, class_id) for every row of docs, repeated rows included; other columns are left out.

    class_id is the least doc_id of the rows that links of similarity `least` or more connect, directly or through
    others. Null texts and texts without words resemble nothing: each is its own class. A null doc_id takes part; its
    class has another id unless all are null."""
    with shelf(docs.sparkSession) as put:
        rows, nodes = node_classes(docs, least, put)
        found = rows.join(nodes.select("node", "class_id"), "node")
        return cut_lineage(found.select("doc_id", F.when(F.col("n_bands") > 0, F.col("class_id")).otherwise(F.col("doc_id")).alias("class_id")), rows.count())


def _touched(docs: DataFrame, least: float) -> DataFrame:
    """(row_a, row_b, gone): the rows that go, and those that are repeated and of which one stays."""
    with shelf(docs.sparkSession) as put:
        rows, nodes = node_classes(docs, least, put)
        worded = rows.filter("n_bands > 0").groupBy("node", *ROW).agg(F.count("*").alias("n"))
        order = F.struct(F.coalesce(F.col("first") != F.col("class_id"), F.lit(True)).alias("other"), "node", *ROW)
        best = nodes.groupBy("class_id").agg(F.min(order).alias("best")).select("best.row_a", "best.row_b", F.lit(True).alias("best"))
        told = worded.join(best, ROW, "left").select(*ROW, "n", F.col("best").isNull().alias("gone"))
        return cut_lineage(told.filter("gone or n > 1").drop("n"), rows.count())


def keep_first(docs: DataFrame, least: float = LEAST) -> DataFrame:
    """docs, all columns, with one row of each class: that of the least doc_id (and then node). Rows without words stay.

    Of rows that are repeated as a whole one stays; a null doc_id gives way to others. Columns of docs may have any names
    besides row_a, row_b and gone, which are taken for what they are here only inside: the result has docs' own."""
    touched = _touched(docs, least)
    wide = docs.select(F.struct(*docs.columns).alias("doc"), *row_key("doc_id", "text"))
    hit, clean = sifted(wide, sieve(touched, "row_a"), "row_a")
    hit = hit.join(touched, ROW, "left").filter("gone is null or not gone")
    single = hit.filter("gone is null").select("doc")
    several = hit.filter("not gone").dropDuplicates(ROW).select("doc")
    return clean.select("doc").union(single).union(several).select("doc.*")
