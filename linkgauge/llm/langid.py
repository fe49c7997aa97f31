"""Language identification with a bidirectional gated recurrent network over UTF-8 bytes.

Texts are cut into chunks of CHUNK bytes. One recurrent layer reads each chunk forwards, one backwards; a softmax over
both states labels every byte, and the mean of a document's byte probabilities decides. The network is trained in
numpy by backpropagation through time on a bounded sample of chunks; every byte of every document is scored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import held_out, keep_rows, map_batches, texts

UNDETERMINED = "und"
LETTER = regex.compile(r"\p{L}")
#: Bytes read together, units a direction, chunks computed at once.
CHUNK, UNITS, BLOCK = 96, 8, 4096
#: The training sample: about DOCS documents of each of the LANGUAGES most frequent languages, PIECES chunks from places all
#: over each. Rarer languages are not learnt.
DOCS, PIECES, LANGUAGES = 400, 6, 200
STEPS, BATCH, RATE = 260, 192, 0.02
PAD = 256


@dataclass
class Layer:
    """Gates in the order update, reset, candidate: input table, recurrent weights."""

    table: np.ndarray
    recurrent: np.ndarray


@dataclass
class Network:
    languages: list[str]
    ahead: Layer
    back: Layer
    out: np.ndarray
    bias: np.ndarray


def _fresh(languages: list[str], rng: np.random.Generator) -> Network:
    def layer() -> Layer:
        return Layer(rng.normal(0, 0.3, (257, 3 * UNITS)).astype(np.float32), rng.normal(0, 0.3, (UNITS, 3 * UNITS)).astype(np.float32))

    return Network(languages, layer(), layer(), rng.normal(0, 0.3, (2 * UNITS, len(languages))).astype(np.float32), np.zeros(len(languages), np.float32))


def _run(layer: Layer, x: np.ndarray, keep: list | None = None) -> np.ndarray:
    """States after each byte of x (bytes, chunks); keep gets what the backward pass needs."""
    n = x.shape[1]
    states, h, u = np.empty((len(x), n, UNITS), np.float32), np.zeros((n, UNITS), np.float32), UNITS
    for t, codes in enumerate(x):
        a, b = layer.table[codes], h @ layer.recurrent
        gates = 0.5 * np.tanh(0.5 * (a[:, : 2 * u] + b[:, : 2 * u])) + 0.5
        z, r = gates[:, :u], gates[:, u:]
        c = np.tanh(a[:, 2 * u :] + r * b[:, 2 * u :])
        if keep is not None:
            keep.append((codes, h, z, r, c, b[:, 2 * u :]))
        h = c + z * (h - c)
        states[t] = h
    return states


def _softmax(logits: np.ndarray) -> np.ndarray:
    logits = np.exp(logits - logits.max(-1, keepdims=True))
    return logits / logits.sum(-1, keepdims=True)


def _through_time(layer: Layer, kept: list, given: np.ndarray) -> Layer:
    """Gradients of a layer from the gradients of its states."""
    table, recurrent, dh = np.zeros_like(layer.table), np.zeros_like(layer.recurrent), np.zeros_like(given[0])
    for t in range(len(kept) - 1, -1, -1):
        codes, h, z, r, c, b = kept[t]
        dh = dh + given[t]
        dc = dh * (1 - z) * (1 - c * c)
        dz = dh * (h - c) * z * (1 - z)
        dr = dc * b * r * (1 - r)
        da = np.concatenate([dz, dr, dc], 1)
        db = np.concatenate([dz, dr, dc * r], 1)
        np.add.at(table, codes, da)
        recurrent += h.T @ db
        dh = dh * z + db @ layer.recurrent.T
    return Layer(table, recurrent)


def train(chunks: list[bytes], labels: list[str], seed: int = 7) -> Network | None:
    """None without any chunk. Deterministic in the order of the chunks."""
    languages = sorted(set(labels))
    if not languages:
        return None
    rng, net = np.random.default_rng(seed), None
    net = _fresh(languages, rng)
    x = np.full((CHUNK, len(chunks)), PAD, np.int64)
    for i, chunk in enumerate(chunks):
        x[: len(chunk), i] = np.frombuffer(chunk, np.uint8)
    y = np.searchsorted(languages, labels)
    weights = [net.ahead.table, net.ahead.recurrent, net.back.table, net.back.recurrent, net.out, net.bias]
    first, second = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]
    _hold(net)
    for step in range(1, STEPS + 1):
        pick = rng.integers(0, len(chunks), min(BATCH, len(chunks) * 2))
        xs, kept_a, kept_b = x[:, pick], [], []
        states = np.concatenate([_run(net.ahead, xs, kept_a), _run(net.back, xs[::-1], kept_b)[::-1]], 2)
        valid = (xs != PAD)[:, :, None]
        d = _softmax(states @ net.out + net.bias)
        d[:, np.arange(len(pick)), y[pick]] -= 1
        d *= valid / max(1, valid.sum())
        ds = d @ net.out.T
        a, b = _through_time(net.ahead, kept_a, ds[:, :, :UNITS]), _through_time(net.back, kept_b, ds[::-1, :, UNITS:])
        grads = [a.table, a.recurrent, b.table, b.recurrent, np.einsum("tbi,tbj->ij", states, d), d.sum((0, 1))]
        for w, g, m, v in zip(weights, grads, first, second, strict=True):
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            w -= RATE * min(1, 1.5 - step / STEPS) * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
        _hold(net)
    return net


def _hold(net: Network) -> None:
    """Padding keeps the state: its update gate stays open."""
    for layer in (net.ahead, net.back):
        layer.table[PAD] = 0
        layer.table[PAD, :UNITS] = 40


class Reader:
    def __init__(self, net: Network | None) -> None:
        self.net = net

    def read(self, many: list[str | None]) -> list[tuple[str, float]]:
        """Language and mean probability of each text; undetermined, 0 without a letter or without a network."""
        owners, parts = [], []
        for i, text in enumerate(many):
            if self.net is not None and text and LETTER.search(text):
                data = text.encode()
                parts.append(data + b"\0" * (-len(data) % CHUNK))
                owners.append((i, len(data)))
        out: list[tuple[str, float]] = [(UNDETERMINED, 0.0)] * len(many)
        if not owners:
            return out
        x = np.frombuffer(b"".join(parts), np.uint8).astype(np.int16).reshape(-1, CHUNK)
        sizes = np.array([n for _, n in owners])
        counts = -(-sizes // CHUNK)
        firsts = np.concatenate([[0], np.cumsum(counts)])
        rest = sizes - (counts - 1) * CHUNK
        last = firsts[1:] - 1
        x[last] = np.where(np.arange(CHUNK) < rest[:, None], x[last], PAD)
        sums = np.concatenate([self._sums(x[a : a + BLOCK]) for a in range(0, len(x), BLOCK)])
        means = np.add.reduceat(sums, firsts[:-1], axis=0) / sizes[:, None]
        for (i, _), p in zip(owners, means, strict=True):
            best = int(p.argmax())
            out[i] = self.net.languages[best], float(min(1.0, p[best]))
        return out

    def _sums(self, x: np.ndarray) -> np.ndarray:
        """Probabilities of each language, summed over the bytes of each chunk."""
        net, x = self.net, np.ascontiguousarray(x.T)
        ahead, back = _run(net.ahead, x), _run(net.back, x[::-1])[::-1]
        total = np.zeros((x.shape[1], len(net.languages)), np.float64)
        for t in range(len(x)):
            p = _softmax(ahead[t] @ net.out[:UNITS] + back[t] @ net.out[UNITS:] + net.bias)
            total += p * (x[t] != PAD)[:, None]
        return total


def training_chunks(docs: DataFrame) -> tuple[list[bytes], list[str]]:
    """Chunks of about DOCS documents of each language: rows that may be learnt from, with a letter, by hash of the id.

    Rows with a null id, text or language teach nothing; repeated rows are taken as often as they stand."""
    known = docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    counts = {r.lang: r.n for r in known.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang").limit(LANGUAGES).collect()}
    share = F.lit(0.0)
    for lang, n in counts.items():
        share = F.when(F.col("lang") == lang, min(1.0, DOCS / n)).otherwise(share)
    rows = known.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < share * 1_000_000).select("doc_id", "lang", "text")

    def cut(batches):
        for batch in batches:
            found = []
            for doc_id, lang, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if LETTER.search(text):
                    data = text.encode()
                    room = max(0, len(data) - CHUNK)
                    starts = sorted({room * i // (PIECES - 1) for i in range(PIECES)})
                    found += [(doc_id, lang, data[s : s + CHUNK]) for s in starts]
            if found:
                yield pa.RecordBatch.from_arrays([pa.array([str(x[0]) for x in found]), pa.array([x[1] for x in found]), pa.array([x[2] for x in found], pa.binary())], ["doc_id", "lang", "chunk"])

    found = sorted(tuple(r) for r in map_batches(rows, cut, "doc_id string, lang string, chunk binary").collect())
    return [bytes(r[2]) for r in found], [r[1] for r in found]


def fit(docs: DataFrame) -> Network | None:
    """The network of a table's training chunks; None for a table without any."""
    return train(*training_chunks(docs))


def identify(docs: DataFrame, net: Network | None) -> DataFrame:
    """(doc_id, lang_pred, score) of every row, in one pass. Null and empty texts and texts without a letter: `und`, 0.

    Repeated rows give repeated results, ties go to the language that is first by name; columns besides doc_id and text
    are left out, so their names do not matter."""
    rows = docs.select("doc_id", "text")
    model = docs.sparkSession.sparkContext.broadcast(net)

    def run(batches):
        reader = Reader(model.value)
        for batch in batches:
            found = reader.read(texts(batch))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([x[0] for x in found], pa.string()), pa.array([x[1] for x in found], pa.float64())], ["doc_id", "lang_pred", "score"])

    return map_batches(rows, run, f"doc_id {dict(rows.dtypes)['doc_id']}, lang_pred string, score double")


def keep_identified(docs: DataFrame, net: Network | None, least: float = 0.5) -> DataFrame:
    """docs, all columns, without rows whose language is undetermined or has a mean probability below `least`; null and
    empty texts go with them. Repeated rows stay or go together; other columns may have any names."""
    model = docs.sparkSession.sparkContext.broadcast(net)

    def keep():
        reader = Reader(model.value)
        return lambda batch: [lang != UNDETERMINED and score >= least for lang, score in reader.read(texts(batch))]

    return keep_rows(docs, keep)
