"""Benchmark decontamination with one Aho-Corasick automaton over normalised benchmark windows.

Texts are normalised on UTF-8 bytes: A-Z become a-z, every other ASCII byte that is not a letter or digit becomes a
space, runs of spaces become one. The automaton holds each window of WINDOW words (a whole item if it is shorter)
between spaces, so one scan of a text finds all of them at word boundaries. Word numbers follow from the spaces before
a match, and offsets in the original text from the places where its words begin and end.

The windows are sent to every task. A benchmark of more than PART_CHARS characters is dealt into parts of that size, each
with its own automaton; the parts scan the same rows one after the other and add their hits up, without any exchange.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import keep_rows, map_batches, replaced, texts

WINDOW = 10
#: Characters of benchmark texts that the driver holds and sends at once, and that make one automaton.
PART_CHARS = 50_000_000
WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
NORMAL = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(NORMAL).split()


def windows_of(text: str | None, size: int = WINDOW) -> list[bytes]:
    words = words_of(text)
    return [b" ".join(words[i : i + size]) for i in range(max(1, len(words) - size + 1))] if words else []


def read_items(benchmark: DataFrame) -> Iterator[dict[bytes, list[str]]]:
    """Windows and the items that hold them, in parts of PART_CHARS characters and an item more; one empty part for an
    empty benchmark. Null ids and texts hold none; repeated items count once."""
    held: dict[bytes, set[str]] = defaultdict(set)
    chars = parts = 0
    for item_id, text in benchmark.select(benchmark["item_id"].cast("string"), "text").dropna().toLocalIterator():
        if chars > PART_CHARS:
            yield {w: sorted(ids) for w, ids in held.items()}
            held, chars, parts = defaultdict(set), 0, parts + 1
        chars += len(text)
        for w in windows_of(text):
            held[w].add(item_id)
    if held or not parts:
        yield {w: sorted(ids) for w, ids in held.items()}


class Scanner:
    def __init__(self, windows: dict[bytes, list[str]]) -> None:
        self.automaton = ahocorasick.Automaton()
        for w, ids in windows.items():
            self.automaton.add_word(f" {w.decode('latin-1')} ", (len(w) + 2, w.count(b" ") + 1, ids))
        if windows:
            self.automaton.make_automaton()
        self.empty = not windows

    def scan(self, text: str | None) -> tuple[int, np.ndarray | None, set[str]]:
        """Number of words, marks of the words that are hit (None if there are none), items that occur."""
        words = words_of(text)
        if not words or self.empty:
            return len(words), None, set()
        normal = f" {b' '.join(words).decode('latin-1')} "
        found = [*self.automaton.iter(normal)]
        if not found:
            return len(words), None, set()
        spaces = np.flatnonzero(np.frombuffer(normal.encode("latin-1"), np.uint8) == 32)
        ends = np.searchsorted(spaces, np.array([end for end, _ in found]))  # the word before the space at `end`
        change = np.zeros(len(words) + 1, np.int64)
        np.add.at(change, ends - np.array([n for _, (_, n, _) in found]), 1)
        np.add.at(change, ends, -1)
        return len(words), np.cumsum(change[:-1]) > 0, {i for _, (_, _, ids) in found for i in ids}

    def spans(self, text: str, hit: np.ndarray) -> list[tuple[int, int]]:
        """Character offsets in the original text of each run of words that are hit."""
        places = [m.span() for m in WORD.finditer(text.encode().translate(LOWER).decode())]
        edges = np.flatnonzero(np.diff(np.concatenate([[0], hit.astype(np.int8), [0]])))
        return [(places[a][0], places[b - 1][1]) for a, b in edges.reshape(-1, 2)]


def _scan(rows: DataFrame, windows: dict[bytes, list[str]]) -> DataFrame:
    """rows with the hits of one part of the benchmark added to column found: the words that are hit so far, packed eight to
    a byte (null without any), and the items found."""
    sent = rows.sparkSession.sparkContext.broadcast(windows)
    kind = pa.struct([("hit", pa.binary()), ("items", pa.list_(pa.string()))])

    def run(batches):
        scanner = Scanner(sent.value)
        for batch in batches:
            at = batch.schema.get_field_index("found")
            out = []
            for text, before in zip(texts(batch), batch.column(at).to_pylist(), strict=True):
                _, hit, items = scanner.scan(text)
                packed, old = before["hit"], before["items"] or []
                if hit is not None:
                    packed = np.packbits(hit if packed is None else hit | np.unpackbits(np.frombuffer(packed, np.uint8), count=len(hit)).astype(bool)).tobytes()
                out.append({"hit": packed, "items": [*{*old, *items}]})
            yield replaced(batch, batch.schema.set(at, pa.field("found", kind)), found=pa.array(out, kind))

    return map_batches(rows, run, rows.schema)


def _scanned(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    rows = docs.withColumn("found", F.struct(F.lit(None).cast("binary").alias("hit"), F.array().cast("array<string>").alias("items")))
    for part in read_items(benchmark):
        rows = _scan(rows, part)
    return rows


def contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row for each row of docs: doc_id, n_words, n_hit, items (sorted ids as strings), spans (start, end offsets).

    Null and empty texts have no words and no hits; an empty benchmark hits nothing; repeated rows give repeated
    results; columns besides doc_id and text are left out. No shuffle."""
    rows = _scanned(docs.select("doc_id", "text"), benchmark)
    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def run(batches):
        scanner = Scanner({})
        for batch in batches:
            n_words, n_hit, items, spans = [], [], [], []
            for text, found in zip(texts(batch), batch.column(2).to_pylist(), strict=True):
                n = len(words_of(text))
                hit = None if found["hit"] is None else np.unpackbits(np.frombuffer(found["hit"], np.uint8), count=n)
                n_words.append(n)
                n_hit.append(0 if hit is None else int(hit.sum()))
                items.append(sorted(found["items"]))
                spans.append([] if hit is None else [{"start": a, "end": b} for a, b in scanner.spans(text, hit)])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n_words, pa.int64()), pa.array(n_hit, pa.int64()), pa.array(items, pa.list_(pa.string())), pa.array(spans, span)], ["doc_id", "n_words", "n_hit", "items", "spans"])

    return map_batches(rows, run, f"doc_id {dict(rows.dtypes)['doc_id']}, n_words long, n_hit long, items array<string>, spans array<struct<start: long, end: long>>")


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """docs without the rows in whose text a benchmark window occurs; all columns stay, whatever their names.

    Null and empty texts stay, and so does everything where the benchmark is empty; repeated rows stay or go together."""
    for part in read_items(benchmark):
        docs = _without(docs, part)
    return docs


def _without(docs: DataFrame, windows: dict[bytes, list[str]]) -> DataFrame:
    sent = docs.sparkSession.sparkContext.broadcast(windows)

    def keep():
        scanner = Scanner(sent.value)
        return lambda batch: [scanner.scan(t)[1] is None for t in texts(batch)]

    return keep_rows(docs, keep)
