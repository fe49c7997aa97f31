"""Toxicity: a linear-chain conditional random field tags toxic words; its marginals give spans and document scores.

Only documents are labelled, so tokens get their labels from a lexicon that is read off the labelled sample: words and
word beginnings that stand in enough toxic documents that differ from each other, and next to never in others. On
windows of the sample tagged this way the field learns weights of hashed word features and of tag changes, by gradients
from forward-backward. Inference runs forward-backward over all words of many documents at once, exactly: products of
2 x 2 matrices over segments, a scan over the segments, and vector passes within them; a document's first word has a
matrix that forgets what came before.
"""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import held_out, map_batches, texts

WORD = re.compile(r"[^\W\d_]+")
#: About this many labelled documents of each label are learnt from.
SAMPLE = 1500
#: A lexicon entry stands in this share of the toxic documents (and LEAST_DOCS) and at least this part of its documents is toxic.
SHARE, LEAST_DOCS, PURE = 0.02, 4, 0.98
#: Words of a training window, windows of a document, buckets of word features, training steps.
WINDOW, WINDOWS, BUCKETS, STEPS, BATCH, RATE = 32, 4, 1 << 16, 400, 256, 0.1
#: Marginal from which a word belongs to a span, and how many of the highest marginals make up a document's score.
TOXIC, HIGHEST, REMEMBERED = 0.5, 3, 300_000


def units(word: str) -> list[str]:
    """What a lexicon entry can be: the word, or its first four or five letters."""
    word = word.lower()
    return [word, *[f"{word[:n]}*" for n in (4, 5) if len(word) >= n]]


def features(word: str) -> list[int]:
    """Buckets of the word, its beginnings and its ends."""
    word = word.lower()
    parts = [f"w{word}", *[f"b{word[:n]}" for n in (3, 4, 5)], *[f"e{word[-n:]}" for n in (3, 4)]]
    return [zlib.crc32(p.encode()) % BUCKETS for p in parts]


@dataclass
class Field:
    """Feature weights of the toxic tag against the other, tag changes (from, to), first tags; all as logarithms."""

    weights: np.ndarray
    change: np.ndarray
    first: np.ndarray


def marginals(odds: np.ndarray, starts: np.ndarray, change: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Probability of the toxic tag at every word. odds: of the toxic tag by features; starts: True at first words of
    documents; change and first as in Field, not logarithms."""
    n = len(odds)
    if not n:
        return np.zeros(0)
    length = int(np.ceil(np.sqrt(n)))
    rows = -(-n // length)
    m = np.zeros((2, 2, rows * length))
    for i in range(2):
        m[i, 0, :n] = np.where(starts, first[0], change[i, 0])
        m[i, 1, :n] = np.where(starts, first[1], change[i, 1]) * odds
        m[i, i, n:] = 1
    m = m.reshape(2, 2, rows, length)
    whole = np.zeros((rows, 2, 2))
    whole[:, 0, 0] = whole[:, 1, 1] = 1
    for t in range(length):
        whole = np.einsum("sij,jks->sik", whole, m[:, :, :, t])
        whole /= whole.sum((1, 2), keepdims=True)
    ahead, back = np.ones((rows, 2)), np.ones((rows, 2))
    for s in range(1, rows):
        a = ahead[s - 1] @ whole[s - 1]
        ahead[s] = a / a.sum()
        b = whole[rows - s] @ back[rows - s]
        back[rows - s - 1] = b / b.sum()
    out = np.empty((2, rows, length))
    a0, a1 = ahead.T
    for t in range(length):
        a0, a1 = a0 * m[0, 0, :, t] + a1 * m[1, 0, :, t], a0 * m[0, 1, :, t] + a1 * m[1, 1, :, t]
        total = a0 + a1
        out[0, :, t] = a0 = a0 / total
        out[1, :, t] = a1 = a1 / total
    b0, b1 = back.T
    for t in range(length - 1, -1, -1):
        out[0, :, t] *= b0
        out[1, :, t] *= b1
        b0, b1 = m[0, 0, :, t] * b0 + m[0, 1, :, t] * b1, m[1, 0, :, t] * b0 + m[1, 1, :, t] * b1
        total = b0 + b1
        b0, b1 = b0 / total, b1 / total
    return (out[1] / (out[0] + out[1])).ravel()[:n]


def train(windows: list[list[str]], tags: list[list[int]]) -> Field:
    """Maximum likelihood by Adagrad; deterministic in the order of the windows."""
    rng = np.random.default_rng(3)
    field = Field(np.zeros(BUCKETS), np.zeros((2, 2)), np.zeros(2))
    grown = [np.full_like(x, 1e-3) for x in (field.weights, field.change, field.first)]
    n = len(windows)
    ids = np.zeros((n, WINDOW, 6), np.int64)
    y, valid = np.zeros((n, WINDOW), np.int64), np.zeros((n, WINDOW), bool)
    for i, (words, own) in enumerate(zip(windows, tags, strict=True)):
        k = len(words)
        ids[i, :k], y[i, :k], valid[i, :k] = [features(w) for w in words], own, True
    order = np.concatenate([rng.permutation(n) for _ in range(-(-STEPS * BATCH // n))])
    for step in range(STEPS):
        pick = order[step * BATCH : (step + 1) * BATCH]
        grads = _gradients(field, ids[pick], y[pick], valid[pick])
        for x, g, s in zip((field.weights, field.change, field.first), grads, grown, strict=True):
            s += g * g
            x -= RATE * g / np.sqrt(s)
    return field


def _gradients(field: Field, ids: np.ndarray, y: np.ndarray, valid: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of the mean negative log-likelihood: expected less observed counts."""
    n, length = y.shape
    emit = np.stack([np.zeros((n, length)), np.clip(field.weights[ids].sum(2), -30, 30)], 2)
    change, scale = np.exp(field.change), 1 / n
    alpha, beta = np.zeros((n, length, 2)), np.ones((n, length, 2))
    for t in range(length):
        a = np.exp(field.first) if t == 0 else alpha[:, t - 1] @ change
        a = a * np.exp(emit[:, t])
        alpha[:, t] = np.where(valid[:, t, None], a / a.sum(1, keepdims=True), alpha[:, t - 1] if t else 0.5)
    for t in range(length - 2, -1, -1):
        b = (beta[:, t + 1] * np.exp(emit[:, t + 1])) @ change.T
        beta[:, t] = np.where(valid[:, t + 1, None], b / b.sum(1, keepdims=True), 1)
    p = alpha * beta
    p /= p.sum(2, keepdims=True)
    d = np.where(valid, p[:, :, 1] - y, 0) * scale
    weights = np.zeros(BUCKETS)
    np.add.at(weights, ids.ravel(), np.repeat(d.ravel(), ids.shape[2]))
    pair = alpha[:, :-1, :, None] * change * (beta[:, 1:] * np.exp(emit[:, 1:]))[:, :, None, :]
    pair /= pair.sum((2, 3), keepdims=True)
    both = valid[:, 1:]
    seen = np.zeros((2, 2))
    np.add.at(seen, (y[:, :-1][both], y[:, 1:][both]), scale)
    first = p[:, 0].sum(0) * scale - np.bincount(y[:, 0], minlength=2) * scale
    return weights + 1e-4 * field.weights * (weights != 0), pair[both].sum(0) * scale - seen, first


class _Odds(dict):
    """Odds of the toxic tag by a word's features."""

    def __init__(self, field: Field) -> None:
        super().__init__()
        self.weights = field.weights

    def __missing__(self, word: str) -> float:
        value = float(np.exp(np.clip(self.weights[features(word)].sum(), -30, 30)))
        if len(self) < REMEMBERED and len(word) < 40:
            self[word] = value
        return value


class Tagger:
    def __init__(self, field: Field | None) -> None:
        self.field = field
        if field is not None:
            self.odds, self.change, self.first = _Odds(field), np.exp(field.change), np.exp(field.first)

    def tag(self, many: list[str | None]) -> tuple[list[float], list[list[dict]]]:
        """Score and toxic spans (start and end in the original text, highest marginal) of each text."""
        scores, spans = [0.0] * len(many), [[] for _ in many]
        if self.field is None:
            return scores, spans
        words = [WORD.findall(t or "") for t in many]
        sizes = np.array([len(w) for w in words], np.int64)
        odds = np.fromiter((x for w in words for x in map(self.odds.__getitem__, w)), np.float64, int(sizes.sum()))
        ends = np.cumsum(sizes)
        starts = np.zeros(len(odds), bool)
        starts[(ends - sizes)[sizes > 0]] = True
        p = marginals(odds, starts, self.change, self.first)
        for i in np.flatnonzero(sizes):
            own = p[ends[i] - sizes[i] : ends[i]]
            scores[i] = float(1 - np.prod(1 - np.partition(own, -min(HIGHEST, len(own)))[-HIGHEST:]))
            if own.max() >= TOXIC:
                places = [m.span() for m in WORD.finditer(many[i])]
                edges = np.flatnonzero(np.diff(np.concatenate([[0], own >= TOXIC, [0]]).astype(np.int8)))
                spans[i] = [{"start": places[a][0], "end": places[b - 1][1], "marginal": float(own[a:b].max())} for a, b in edges.reshape(-1, 2)]
        return scores, spans


def _sample(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, text, label, n): about SAMPLE documents of each label that may be learnt from, chosen by a hash of the id."""
    known = labels.select("doc_id", F.col("toxic").cast("int").alias("label")).dropna().filter(~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("label").alias("label"))
    share = F.lit(0.0)
    for row in known.groupBy("label").agg(F.count("*").alias("n")).orderBy("label").collect():
        share = F.when(F.col("label") == row.label, min(1.0, SAMPLE / row.n)).otherwise(share)
    # at most some SAMPLE ids of each label, so they go to the documents and no text is exchanged
    picked = known.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < share * 1_000_000)
    return docs.select("doc_id", "text").filter(F.col("text").isNotNull()).join(F.broadcast(picked), "doc_id").distinct()


def lexicon(sample: DataFrame) -> set[str]:
    """Words and word beginnings (with *) of toxic documents. Copies of a document count once, by their least word hash."""

    def cut(batches):
        for batch in batches:
            found = []
            for text, label in zip(texts(batch), batch.column(2).to_pylist(), strict=True):
                words = {w.lower() for w in WORD.findall(text)}
                alike = min((zlib.crc32(w.encode()) for w in words), default=0)
                found += [(label, alike, u) for u in {u for w in words for u in units(w)}]
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*found, strict=True), (pa.int32(), pa.int64(), pa.string()), strict=True)], ["label", "alike", "unit"])

    entries = map_batches(sample, cut, "label int, alike long, unit string").distinct()
    groups = sample.filter("label = 1").count()
    counted = entries.groupBy("unit").agg(F.count_if(F.col("label") == 1).alias("toxic"), F.count_if(F.col("label") == 0).alias("other"))
    counted = counted.filter((F.col("toxic") >= max(LEAST_DOCS, SHARE * groups)) & (F.col("toxic") >= PURE * (F.col("toxic") + F.col("other"))))
    return {r.unit for r in counted.select("unit").collect()}


def fit(docs: DataFrame, labels: DataFrame) -> Field | None:
    """None if no lexicon comes out of the labels. The sample and its windows are bounded by the parameters above."""
    sample = _sample(docs, labels).persist()
    toxic = lexicon(sample)

    def cut(batches):
        for batch in batches:
            found = []
            for doc_id, text, label in zip(*(c.to_pylist() for c in batch.columns[:3]), strict=True):
                words = WORD.findall(text)
                hits = [i for i, w in enumerate(words) if any(u in toxic for u in units(w))]
                if label == 1:
                    at = hits[:: max(1, len(hits) // WINDOWS)][:WINDOWS]
                else:
                    at = [len(words) * i // WINDOWS for i in range(WINDOWS)]
                hit = set(hits) if label == 1 else set()
                for i in at:
                    a = max(0, i - WINDOW // 2)
                    if own := words[a : a + WINDOW]:
                        found.append((str(doc_id), own, [int(j in hit) for j in range(a, a + len(own))]))
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*found, strict=True), (pa.string(), pa.list_(pa.string()), pa.list_(pa.int32())), strict=True)], ["doc_id", "words", "tags"])

    found = sorted(tuple(r) for r in map_batches(sample, cut, "doc_id string, words array<string>, tags array<int>").collect()) if toxic else []
    sample.unpersist()
    return train([r[1] for r in found], [r[2] for r in found]) if any(1 in r[2] for r in found) else None


def score(docs: DataFrame, field: Field | None) -> DataFrame:
    """(doc_id, score, spans) of every row, in one pass over whole texts: score is the chance that any of the HIGHEST
    likeliest words is toxic, spans are runs of words with a marginal of TOXIC or more.

    Texts without a word, null ones too, and all texts without a field score 0. Other columns are left out."""
    rows = docs.select("doc_id", "text")
    model = docs.sparkSession.sparkContext.broadcast(field)

    def run(batches):
        tagger = Tagger(model.value)
        kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("marginal", pa.float64())]))
        for batch in batches:
            scores, spans = tagger.tag(texts(batch))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64()), pa.array(spans, kind)], ["doc_id", "score", "spans"])

    return map_batches(rows, run, f"doc_id {dict(rows.dtypes)['doc_id']}, score double, spans array<struct<start: long, end: long, marginal: double>>")
