import hashlib
import random
import re
import zlib
from fractions import Fraction

import pytest

from linkgauge.llm import queries
from linkgauge.llm.common import table
from linkgauge.llm.runs import least_level, periodic, runs

SMALL = "/root/testdata/sf0.001"


def brute(words, exponent=4, shortest=6):
    """Every stretch that is periodic, by period; a period that a smaller one of the same stretch divides is no smallest one."""
    n, found = len(words), {}
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j + q - i
            if j > i and length >= max(shortest, exponent * q) and (i, length) not in found:
                found[i, length] = q
            i = j + 1
    return sorted(((i, length, q) for (i, length), q in found.items()), key=lambda r: (r[0], r[2]))


@pytest.mark.parametrize(("exponent", "shortest"), [(4, 6), (2, 2), (2, 5), (3, 1), (5, 20)])
def test_runs_against_brute_force(exponent, shortest):
    rng = random.Random(7)
    for turn in range(400):
        words = [rng.choice("ab" if turn % 3 else "abc") for _ in range(rng.randint(0, 40))]
        unit, at = rng.choices("abcd", k=rng.randint(1, 6)), rng.randint(0, len(words))
        words[at:at] = unit * rng.randint(0, 6) + unit[: rng.randint(0, len(unit))]
        words = [w.encode() for w in words]
        assert runs(words, exponent, shortest) == brute(words, exponent, shortest), words


def test_long_runs():
    assert least_level(4, 6) == 5 and runs([b"a"] * 30_000) == [(0, 30_000, 1)]
    unit = [str(i).encode() for i in range(2000)]
    assert runs([b"x", *unit * 5, b"7"]) == [(1, 10_000, 2000)]
    assert runs(unit * 3) == [] and runs([]) == []


def planted(doc_id, words):
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    g = h // 10
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def expected(doc_id, text):
    words = planted(doc_id, re.findall("[^\x20\x09-\x0d]+", text or ""))
    found = brute(words)
    best = max(found, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=None)
    gone = {i for s, n, q in found for i in range(s + q, s + n)}
    short = digest(" ".join(w for i, w in enumerate(words) if i not in gone))
    listed = digest("".join(f"{s},{n},{q}\n" for s, n, q in found))
    return (doc_id, len(found), *(best or (None, None, None)), 1000 * best[1] // best[2] if best else None, listed, short)


def fields(row):
    return (row.doc_id, row.n_runs, row.start, row.length, row.period, row.exponent_milli, row.runs_sha256, row.collapsed_sha256)


def test_op11(spark):
    docs = [(r.doc_id, r.text) for r in table(spark, SMALL, "documents").collect()]
    short = {i: t for i, t in docs if len(t.split()) < 3000}
    got = {r.doc_id: fields(r) for r in queries.op11_runs(spark, SMALL).collect()}
    assert len(got) == len(docs) and sum(r[1] for r in got.values()) > 10
    for i, text in short.items():
        assert got[i] == expected(i, text)


def test_op11_odd_rows(spark, tmp_path):
    ids = [i for i in range(400) if zlib.crc32(str(i).encode()) % 10 == 0][:12]
    rng = random.Random(3)
    rows = [(i, " ".join(rng.choices("ab", k=rng.randint(1, 60)))) for i in ids] + [(i, "") for i in ids[:1]] + [(900, None), (901, " \t\r\n\v\f "), (902, "ü x " * 9 + "\x1c"), (903, "a b " * 50_000)]
    rows += [(904, "na " * 8), (904, "na " * 8), (None, "k l m " * 4)]
    spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, runs int").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted(map(fields, queries.op11_runs(spark, str(tmp_path)).collect()), key=repr)
    assert len(got) == len(rows)
    small = [expected(i, t) for i, t in rows if i != 903]
    assert sorted((r for r in got if r[0] != 903), key=repr) == sorted(small, key=repr)
    assert [r[2:5] for r in got if r[0] == 903] == [(0, 100_000, 2)]
    assert periodic(spark.createDataFrame([], "doc_id long, text string")).count() == 0
