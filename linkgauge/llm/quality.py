"""Quality classifier: similarity-weighted votes of the nearest labelled documents in a latent-semantic space.

A document's terms are its words (hashed), the shapes of its tokens (runs of letters, digits and marks squeezed), pairs of
neighbouring shapes, and marks for tokens that repeat what came shortly before. Log-scaled counts times inverse document frequency,
projected on the leading singular vectors of the labelled sample, give its latent-semantic vector. The labelled
vectors are sent to all tasks (their number is bounded), which compute exact cosine products with every document in
blocks; the NEIGHBOURS most similar vote, weighted by similarity.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import held_out, map_batches, texts

TERMS, FACTORS, NEIGHBOURS = 1536, 32, 15
#: About this many labelled documents of each label are learnt from; their texts' terms come to the driver, no texts.
SAMPLE = 1200
#: Documents multiplied with the labelled vectors at once, and token shapes that a task remembers.
BLOCK, REMEMBERED = 512, 200_000
#: Terms for shapes and for pairs of shapes; the others are for repeats at these distances, and for the share of
#: distinct tokens in twentieths. Words have the places from WORDS_AT on, and this part of the weight of the others.
SHAPES, PAIRS, BACK = 560, 420, (1, 2)
WORDS_AT, WORDS, WORD_WEIGHT = 1023, 512, 0.3


def shape(token: str) -> str:
    """Case and script of letters, digits, and marks as they are, each run squeezed to one or `+`: `Ab3!!` -> `Aa9!+`."""
    token = re.sub(r"[^\W\d_]", lambda m: "A" if m[0].isupper() else "a", token)
    token = re.sub(r"\d", "9", token)
    return re.sub(r"(.)\1+", lambda m: m[1] if m[1] in "Aa9" else m[1] + "+", token)[:24]


class _Shapes(dict):
    """Token -> number of its shape, and above these 31 bits the place of its word; numbers are hashes, so they mean the same
    in every task."""

    def __missing__(self, token: str) -> int:
        value = xxhash.xxh32_intdigest(shape(token)) & 0x7FFFFFFF | xxhash.xxh32_intdigest(token.lower()) % WORDS << 31
        if len(self) < REMEMBERED and len(token) < 40:
            self[token] = value
        return value


def term_counts(text: str, shapes: _Shapes) -> tuple[np.ndarray, np.ndarray]:
    """Hashed terms of a text and their counts. The last place counts all texts, also those without tokens."""
    tokens = text.split()
    n = len(tokens)
    if not n:
        return np.array([TERMS - 1]), np.ones(1)
    s = np.fromiter(map(shapes.__getitem__, tokens), np.int64, n)
    words, s = s >> 31, s & 0x7FFFFFFF
    ids = np.fromiter(map(hash, tokens), np.int64, n)
    parts = [s % SHAPES, SHAPES + (s[1:] * 31 + s[:-1]) % PAIRS]
    parts += [np.full(int((ids[back:] == ids[:-back]).sum()), SHAPES + PAIRS + i) for i, back in enumerate(BACK)]
    parts.append(np.full(n, SHAPES + PAIRS + len(BACK) + int(20 * len(np.unique(ids)) / n)))
    terms, counts = np.unique(np.concatenate([*parts, WORDS_AT + words, [TERMS - 1]]), return_counts=True)
    return terms, np.where((terms >= WORDS_AT) & (terms < TERMS - 1), WORD_WEIGHT, 1.0) * counts / n


@dataclass
class Space:
    """Projection, labelled vectors (unit length) and their labels."""

    weights: np.ndarray
    factors: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray


def _dense(rows: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    out = np.zeros((len(rows), TERMS), np.float32)
    for i, (terms, shares) in enumerate(rows):
        out[i, terms] = np.log1p(100 * shares)
    return out


def _units(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)


def fit_space(rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray) -> Space | None:
    """None without labelled rows."""
    if not rows:
        return None
    x = _dense(rows)
    weights = np.log((1 + len(x)) / (1 + (x > 0).sum(0))).astype(np.float32) + 0.1
    x *= weights
    values, vectors = np.linalg.eigh((x.T @ x).astype(np.float64))
    factors = vectors[:, ::-1][:, :FACTORS].astype(np.float32)
    return Space(weights, factors, _units(x @ factors), labels.astype(np.float32))


def vote(space: Space, rows: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """Share of label 1 among the nearest, weighted by similarity. Similarities count to six decimals; ties go to the
    earlier labelled vectors."""
    out = np.zeros(len(rows))
    k = min(NEIGHBOURS, len(space.labels))
    for a in range(0, len(rows), BLOCK):
        near = np.round(_units((_dense(rows[a : a + BLOCK]) * space.weights) @ space.factors) @ space.vectors.T, 6)
        least = np.partition(near, -k, axis=1)[:, -k, None]
        above, level = near > least, near == least
        best = above | level & (np.cumsum(level, 1) <= k - above.sum(1, keepdims=True))
        sim = np.where(best, np.clip(near, 1e-6, 1) ** 8, 0)
        out[a : a + BLOCK] = sim @ space.labels / sim.sum(1)
    return np.clip(out, 0, 1)


def labelled_terms(docs: DataFrame, labels: DataFrame, label: str) -> tuple[list[tuple[np.ndarray, np.ndarray]], np.ndarray]:
    """Terms of about SAMPLE documents of each label that may be learnt from, chosen by a hash of the id."""
    known = labels.select("doc_id", F.col(label).cast("int").alias("label")).dropna().filter(~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("label").alias("label"))
    share = F.lit(0.0)
    for row in known.groupBy("label").agg(F.count("*").alias("n")).orderBy("label").collect():
        share = F.when(F.col("label") == row.label, min(1.0, SAMPLE / row.n)).otherwise(share)
    # at most some SAMPLE ids of each label, so they go to the documents and no text is exchanged
    picked = known.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < share * 1_000_000)
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(picked), "doc_id")

    def count(batches):
        shapes = _Shapes()
        for batch in batches:
            found = [term_counts(t, shapes) for t in texts(batch)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array([x[0] for x in found], pa.list_(pa.int64())), pa.array([x[1] for x in found], pa.list_(pa.float64()))], ["doc_id", "label", "terms", "shares"])

    found = sorted(map_batches(rows, count, f"doc_id {dict(rows.dtypes)['doc_id']}, label int, terms array<long>, shares array<double>").distinct().collect())
    return [(np.array(r.terms), np.array(r.shares)) for r in found], np.array([r.label for r in found])


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality") -> Space | None:
    """The space of the labelled sample; None without a label. Null ids and labels teach nothing, null texts count as
    empty, and of several labels of an id the greatest counts; repeated rows count once, other columns do not matter."""
    return fit_space(*labelled_terms(docs, labels, label))


def score(docs: DataFrame, space: Space | None) -> DataFrame:
    """(doc_id, score) of every row, in one pass: the whole text decides. Null and empty texts share the vector of a text
    without tokens. Without any label every score is one half. Repeated rows have equal scores; other columns are left out."""
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    model = docs.sparkSession.sparkContext.broadcast(space)

    def run(batches):
        shapes, space = _Shapes(), model.value
        for batch in batches:
            found = [term_counts(t, shapes) for t in texts(batch)] if space is not None else []
            scores = vote(space, found) if space is not None else np.full(batch.num_rows, 0.5)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64())], ["doc_id", "score"])

    return map_batches(rows, run, f"doc_id {dict(rows.dtypes)['doc_id']}, score double")
