import random
import re
from collections import Counter

import duckdb
import numpy as np
import pytest

from linkgauge.llm import queries
from linkgauge.llm.common import passes, sent, sieve, table
from linkgauge.llm.phrases import collocations
from linkgauge.llm.polynomials import BASES, Prefixes

SMALL = "/root/testdata/sf0.001"
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, least=30, part=80, most=2000):
    f, n, out = Counter(), Counter(), []
    for lang, text in rows:
        for piece in re.split("[.,;:!?\n-\r]", (text or "").translate(FOLD)):
            words = tuple(re.findall("[^ \t]+", piece))
            n[lang or "und"] += len(words)
            f.update((lang or "und", words[i : i + m]) for m in range(1, 5) for i in range(len(words) - m + 1))
    chosen = {k: a for k, a in f.items() if a >= least and len(k[1]) > 1}
    for (lang, w), a in chosen.items():
        score, _, l, r = min((2_000_000 * a // (f[lang, w[:k]] + f[lang, w[k:]]), k, f[lang, w[:k]], f[lang, w[k:]]) for k in range(1, len(w)))
        inside = [b for (other, x), b in chosen.items() if other == lang and len(x) > len(w) and any(x[i : i + len(w)] == w for i in range(len(x) - len(w) + 1))]
        if all(100 * b < part * a for b in inside):
            out.append((lang, score, a, " ".join(w), l, r, n[lang]))
    ranked, rank = [], Counter()
    for lang, score, a, phrase, l, r, words in sorted(out, key=lambda x: (x[0], -x[1], -x[2], x[3].encode())):
        rank[lang] += 1
        if rank[lang] <= most:
            ranked.append((lang, rank[lang], phrase, a, l, r, words, score))
    return ranked


def rows():
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(12)] + ["Ä", "Das", "x\x1cy", "\U0001f600"]
    out = [(rng.choice(["en", "de", None, "und"]), "".join(rng.choice(vocabulary) + rng.choice([" ", " ", " ", "  ", "\t", ". ", ",", "\n", "!?"]) for _ in range(rng.randint(0, 300)))) for _ in range(60)]
    out += [("en", "New York City Hall is far " * 40), ("en", None), ("fr", ""), ("fr", " . , \n"), ("es", "na " * 30_000), ("en", "one two"), ("tie", "b a. " * 30 + "d c. " * 30 + "\U0001f600 ￿. " * 30 + "￿ \U0001f600. " * 30)]
    return [*out, out[0], out[0]]


def frame(spark, found):
    return spark.createDataFrame([(i % 50 if i % 7 else None, t, lang, 1, "k") for i, (lang, t) in enumerate(found)], "doc_id long, text string, lang string, n int, row string").repartition(4)


@pytest.mark.parametrize("bits", [61, 9, 3])
def test_against_brute_force_with_and_without_collisions(spark, bits):
    got = sorted(map(tuple, collocations(frame(spark, rows()), least=8, bits=bits).collect()))
    assert got == sorted(brute(rows(), 8)) and len(got) > 100
    if bits == 9:
        got = sorted(map(tuple, collocations(frame(spark, rows()), least=5, part=40, most=7, bits=bits).collect()))
        assert got == sorted(brute(rows(), 5, 40, 7))


def test_nothing_to_find(spark):
    assert collocations(spark.createDataFrame([], "doc_id long, text string, lang string")).count() == 0
    assert collocations(frame(spark, [("en", "one two three")] * 3)).count() == 0
    assert collocations(frame(spark, [("en", None)] * 3)).count() == 0


def test_op12_and_its_sql(spark):
    docs = table(spark, SMALL, "documents").select("lang", "text").collect()
    got = [(r.lang, r["rank"], r.phrase, r.a, r.l, r.r, r.n, r.score) for r in queries.op12_phrases(spark, SMALL).collect()]
    assert sorted(got) == sorted(brute([tuple(r) for r in docs]))
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{SMALL}/documents.parquet'")
    assert sorted(con.execute(queries.OP12_SQL).fetchall()) == sorted(got)


def test_prefixes():
    values = np.random.default_rng(0).integers(0, 1 << 63, 5000).astype(np.uint64)
    values[3000:3400] = values[100:500]
    for base in BASES:
        p = Prefixes(values, base)
        assert p.of(np.array([100]), np.array([500])) == p.of(np.array([3000]), np.array([3400]))
        assert len(np.unique(p.windows(7))) == 4994 - 394 and len(p.windows(5001)) == 0


def test_sieves_for_tasks(spark):
    keys = spark.range(2000).selectExpr("xxhash64(id) as key")
    held = sieve(keys, "key")
    own, other = (np.array([r.key for r in df.collect()], np.int64) for df in (keys, spark.range(2000, 4000).selectExpr("xxhash64(id) as key")))
    bits = sent(held).value
    assert passes(bits, held.size, own).all() and passes(bits, held.size, other).mean() < 0.01
