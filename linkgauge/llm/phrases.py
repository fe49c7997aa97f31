"""Phrase collocations from Rabin-Karp fingerprints.

1. Each task hashes every run of words inside a piece of text with prefix polynomials, counts equal fingerprints, and hands
   on one row for each: the count, the least and greatest of a second, independent fingerprint, and a pointer to a row that holds
   the phrase. Words and pairs of words come first; longer phrases only where all their pairs are frequent, which a
   sieve of the frequent pairs tells (a phrase is no more frequent than its parts), so most are never exchanged.
2. Fingerprints with enough occurrences are read back from the texts that they point to. Pointers go to the least row, so
   few texts hold them all, and only those are exchanged: frequent phrases alone become text.
3. Where the second fingerprints of one fingerprint differ, phrases have collided; all occurrences of these fingerprints are
   counted again as text.
4. Cuts, containment in longer phrases and ranks are joins and aggregates of the frequent phrases.

Equal fingerprints are combined before every exchange, so frequent words are no hot keys.
"""

from __future__ import annotations

from array import array
from collections import Counter

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import cut_lineage, map_batches, passes, sent, shelf, sieve, sifted
from .darts import mix
from .polynomials import BASES, Prefixes

#: Words of a phrase at most, occurrences at least, percent of a phrase's occurrences in a longer one that make it a part of that.
MOST_WORDS, LEAST, PART = 4, 30, 80
SCALE = 2_000_000
#: Bits of a fingerprint besides those for its size.
BITS = 61
#: Ends of pieces, after lower-casing A-Z, are line feeds.
_ENDS = b".,;:!?\n\x0b\x0c\r"
_FOLD = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ" + _ENDS, b"abcdefghijklmnopqrstuvwxyz" + b"\n" * len(_ENDS))
#: Stands between pieces; no UTF-8 text holds this byte.
BREAK = b"\xff"
#: Words that a task remembers between batches.
REMEMBERED = 300_000


def words_of(text: bytes | None) -> list[bytes]:
    """Words of all pieces in order, with BREAK between pieces and at the end."""
    return [*(text or b"").translate(_FOLD).replace(b"\n", b" \xff ").split(), BREAK]


class _Vocabulary(dict):
    """The index of each word in two arrays of its hashes; BREAK has 0."""

    def __init__(self) -> None:
        super().__init__({BREAK: 0})
        self.hashes = array("Q", [0]), array("Q", [0])

    def __missing__(self, word: bytes) -> int:
        value = xxhash.xxh3_128_intdigest(word)
        self.hashes[0].append(value >> 64)
        self.hashes[1].append(value & 0xFFFFFFFFFFFFFFFF)
        self[word] = n = len(self)
        return n

    def values(self, ids: np.ndarray) -> list[np.ndarray]:
        return [np.frombuffer(x, np.uint64)[ids] for x in self.hashes]


class Grams:
    """Fingerprints of the runs of words of one language, over texts that lie one after the other."""

    def __init__(self, words: list[bytes], vocabulary: _Vocabulary, lang: str, bits: int) -> None:
        ids = np.fromiter(map(vocabulary.__getitem__, words), np.int64, len(words))
        self.inside = np.append(0, np.cumsum(ids == 0))
        self.prefixes = [Prefixes(values, base) for values, base in zip(vocabulary.values(ids), BASES, strict=True)]
        self.salt = np.uint64(xxhash.xxh3_64_intdigest(lang))
        self.mask = np.uint64((1 << bits) - 1)

    def starts(self, size: int) -> np.ndarray:
        """Where a run of `size` words stands within a piece. Runs of no words stand at every word."""
        wide = max(size, 1)
        return np.flatnonzero(self.inside[wide:] == self.inside[:-wide])

    def at(self, starts: np.ndarray, size: int) -> list[np.ndarray]:
        """Fingerprint, with the size in its last bits, and check of the runs there."""
        salt = mix(np.array([self.salt + np.uint64(size)], np.uint64))
        key, check = (mix(p.of(starts, starts + size) ^ salt) for p in self.prefixes)
        return [((key & self.mask) << np.uint64(3) | np.uint64(size)).view(np.int64), check.view(np.int64)]


def _by_language(batch: pa.RecordBatch) -> dict[str, list[int]]:
    out: dict[str, list[int]] = {}
    for i, lang in enumerate(batch.column(1).to_pylist()):
        out.setdefault(lang, []).append(i)
    return out


def _combined(key: np.ndarray, check: np.ndarray, row: np.ndarray) -> list[np.ndarray]:
    """key, n, low, high, row, one of each key."""
    order = np.argsort(key, kind="stable")
    key, check, row = key[order], check[order], row[order]
    firsts = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.zeros(0, np.int64)
    if not len(firsts):
        return [key, np.zeros(0, np.int64), check, check, row]
    n = np.diff(np.append(firsts, len(key)))
    return [key[firsts], n, np.minimum.reduceat(check, firsts), np.maximum.reduceat(check, firsts), np.minimum.reduceat(row, firsts)]


def _counts(rows: DataFrame, sizes: tuple[int, ...], bits: int, frequent=None) -> DataFrame:
    """(key, n, low, high, row) of the runs of these sizes. frequent: a sieve of frequent pairs, which longer runs must pass."""
    held, size_of = (sent(frequent), frequent.size) if frequent else (None, 0)

    def run(batches):
        vocabulary = _Vocabulary()
        for batch in batches:
            row, texts_ = batch.column(0).to_numpy(), batch.column(2).cast(pa.binary()).to_pylist()
            for lang, own in _by_language(batch).items():
                lists = [words_of(texts_[i]) for i in own]
                grams = Grams([w for x in lists for w in x], vocabulary, lang, bits)
                of = np.repeat(row[own], [len(x) for x in lists])
                if held:
                    pairs = np.zeros(len(of) + 1, bool)
                    at = grams.starts(2)
                    pairs[at] = passes(held.value, size_of, grams.at(at, 2)[0])
                for size in sizes:
                    at = grams.starts(size)
                    for k in range(size - 1 if held else 0):
                        at = at[pairs[at + k]]
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in _combined(*grams.at(at, size), of[at])], ["key", "n", "low", "high", "row"])
            if len(vocabulary) > REMEMBERED:
                vocabulary = _Vocabulary()

    found = map_batches(rows, run, "key long, n long, low long, high long, row long")
    return found.groupBy("key").agg(F.sum("n").alias("n"), F.min("low").alias("low"), F.max("high").alias("high"), F.min("row").alias("row"))


def _read_back(rows: DataFrame, found: DataFrame, bits: int, put) -> DataFrame:
    """(lang, phrase, size, a) of the fingerprints in found, from the rows that they point to."""
    wanted = put(found.groupBy("row").agg(F.collect_list("key").alias("keys"), F.collect_list("n").alias("counts")))  # at most a text's phrases
    chosen = sifted(rows, sieve(wanted, "row"), "row")[0].dropDuplicates(["row"]).join(wanted, "row")

    def run(batches):
        vocabulary = _Vocabulary()
        for batch in batches:
            out = []
            for lang, text, keys, counts in zip(*[batch.column(i).to_pylist() for i in range(1, 5)], strict=True):
                words, wanted = words_of((text or "").encode()), dict(zip(keys, counts, strict=True))
                grams = Grams(words, vocabulary, lang, bits)
                for size in range(MOST_WORDS + 1):
                    at = grams.starts(size)
                    own = grams.at(at, size)[0]
                    hit = np.isin(own, keys)
                    for i, key in zip(at[hit].tolist(), own[hit].tolist(), strict=True):
                        if (n := wanted.pop(key, None)) is not None:
                            out.append((lang, b" ".join(words[i : i + size]).decode(), size, n))
            yield _phrase_rows(out)

    return map_batches(chosen.select("row", "lang", "text", "keys", "counts"), run, "lang string, phrase string, size int, a long")


def _phrase_rows(out: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], kind) for i, kind in enumerate((pa.string(), pa.string(), pa.int32(), pa.int64()))], ["lang", "phrase", "size", "a"])


def _counted_as_text(rows: DataFrame, keys, bits: int) -> DataFrame:
    """(lang, phrase, size, a) of all phrases whose fingerprint the sieve keys lets through, counted by their words."""
    held, size_of = sent(keys), keys.size

    def run(batches):
        vocabulary = _Vocabulary()
        for batch in batches:
            texts_ = batch.column(2).cast(pa.binary()).to_pylist()
            for lang, own in _by_language(batch).items():
                words = [w for i in own for w in words_of(texts_[i])]
                grams, counts = Grams(words, vocabulary, lang, bits), Counter()
                for size in range(MOST_WORDS + 1):
                    at = grams.starts(size)
                    hit = at[passes(held.value, size_of, grams.at(at, size)[0])]
                    counts.update((size, b" ".join(words[i : i + size])) for i in hit.tolist())
                yield _phrase_rows([(lang, phrase.decode(), size, n) for (size, phrase), n in counts.items()])
            if len(vocabulary) > REMEMBERED:
                vocabulary = _Vocabulary()

    return map_batches(rows, run, "lang string, phrase string, size int, a long").groupBy("lang", "phrase", "size").agg(F.sum("a").alias("a"))


def frequent_phrases(docs: DataFrame, put, least: int = LEAST, bits: int = BITS) -> DataFrame:
    """(lang, phrase, size, a): phrases of up to MOST_WORDS words that occur `least` times or more in their language, words joined by
    a space, and how often each occurs, overlaps included. The phrase of no words occurs at every word. bits: of the
    fingerprint; fewer make collisions, with the same result."""
    rows = docs.select(F.xxhash64("doc_id", "lang", "text").alias("row"), F.coalesce("lang", F.lit("und")).alias("lang"), "text")
    short = put(_counts(rows, (0, 1, 2), bits).filter(F.col("n") >= least))
    long = put(_counts(rows, tuple(range(3, MOST_WORDS + 1)), bits, sieve(short, "key")).filter(F.col("n") >= least))
    counts = short.union(long)
    found = put(_read_back(rows, counts.filter("low = high"), bits, put))
    collided = put(counts.filter("low <> high").select("key"))
    if collided.isEmpty():
        return found
    again = put(_counted_as_text(rows, sieve(collided, "key"), bits).filter(F.col("a") >= least))
    return put(found.unionByName(again).distinct())


def collocations(docs: DataFrame, least: int = LEAST, part: int = PART, most: int = 2000, bits: int = BITS) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the first `most` phrases of each language by their weakest cut.

    A phrase of 2 to MOST_WORDS words that occurs a >= `least` times is cut in two in all ways; with l and r occurrences of the
    parts, its score is the least floor(SCALE * a / (l + r)), of equal ones that of the shortest first part. A phrase goes if
    a longer one that holds it occurs in `part` percent of its places or more. n counts the language's words. Ranks are by
    score and a, greatest first, and then by the phrase's bytes. A null lang is `und`; null and empty texts have no words;
    repeated rows count each; a null doc_id and columns of any names change nothing; an empty table gives an empty result."""
    with shelf(docs.sparkSession) as put:
        phrases = frequent_phrases(docs, put, least, bits)
        chosen = phrases.filter("size > 1")
        part_of = phrases.select("lang", F.col("phrase").alias("part"), F.col("a").alias("times"))
        cuts = chosen.select("*", F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k"))
        cuts = cuts.select("lang", "phrase", "a", "k", F.expr("substring_index(phrase, ' ', k)").alias("left"), F.expr("substring_index(phrase, ' ', k - size)").alias("right"))
        cuts = cuts.join(part_of.withColumnsRenamed({"part": "left", "times": "l"}), ["lang", "left"]).join(part_of.withColumnsRenamed({"part": "right", "times": "r"}), ["lang", "right"])
        score = F.expr(f"cast({SCALE} as decimal(10, 0)) * cast(a as decimal(19, 0)) div cast(cast(l as decimal(19, 0)) + r as decimal(20, 0))")
        scored = put(cuts.withColumn("score", score)).groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))

        places = chosen.filter("size > 2").select("*", F.explode(F.sequence(F.lit(2), F.col("size") - 1)).alias("m"))
        places = places.select("*", F.explode(F.sequence(F.lit(1), F.col("size") - F.col("m") + 1)).alias("i"))
        inner = places.select("lang", F.expr("array_join(slice(split(phrase, ' '), i, m), ' ')").alias("phrase"), F.col("a").alias("times"))
        longer = inner.groupBy("lang", "phrase").agg(F.max("times").alias("longer"))
        dec = lambda c: F.col(c).cast("decimal(20, 0)")
        alone = scored.join(longer, ["lang", "phrase"], "left").filter(F.coalesce(dec("longer") * 100 < dec("a") * part, F.lit(True)))
        order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
        ranked = alone.select("lang", "phrase", "a", "cut.*").withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= most)
        n = phrases.filter("size = 0").select("lang", F.col("a").alias("n"))
        result = ranked.join(n, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
        return cut_lineage(result)
