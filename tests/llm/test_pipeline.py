import random
import re

import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from linkgauge.llm.common import table
from linkgauge.llm.decontaminate import WORD, windows_of, words_of
from tests.llm.test_linetemplates import brute as brute_lines
from tests.llm.test_neardup import brute as brute_classes

SMALL = "/root/testdata/sf0.001"


def test_each_stage_against_brute_force(spark):
    stages = dict(corpus_pipeline.STAGES)
    docs = table(spark, SMALL, "documents")
    columns, rows = docs.columns, docs.collect()
    odd = [(10_001, None, "en", "x", 0), (10_002, "", None, None, None), (10_003, "123 456", "en", "x", 7), (None, rows[0].text, "en", "x", 1), tuple(rows[3]), (10_004, "the and of " * 9000, "en", "x", 1)]
    docs = spark.createDataFrame([tuple(r) for r in rows] + odd, docs.schema)

    kept = stages["language"](spark, docs, SMALL).cache()
    ids = {r.doc_id for r in kept.collect()}
    assert kept.columns == columns and not ids & {10_001, 10_002, 10_003} and len(ids) > 0.97 * len(rows)

    source = [(r.doc_id, r.text) for r in kept.collect()]
    expected = [(i, t) for (i, before), t in zip(source, brute_lines(source), strict=True) if t == before or t.strip()]
    after = stages["lines"](spark, kept, SMALL).cache()
    assert after.columns == columns
    assert sorted(((r.doc_id, r.text) for r in after.collect()), key=repr) == sorted(expected, key=repr)
    assert all(r.n_chars == len(r.text) for r in after.collect() if r.doc_id is not None and r.doc_id < 10_000)

    source = [(r.doc_id, r.text) for r in after.collect()]
    heads = {c for (_, t), (_, c) in zip(source, brute_classes(source), strict=True) if re.search(r"\w", t)}
    single = stages["near_duplicates"](spark, after, SMALL).cache()
    assert single.columns == columns and sorted((r.doc_id for r in single.collect()), key=repr) == sorted(heads, key=repr)

    windows = {w for r in table(spark, SMALL, "benchmark").collect() for w in windows_of(r.text)}
    clean = stages["benchmark"](spark, single, SMALL).cache()
    hit = {r.doc_id for r in single.collect() if any(f" {w.decode()} " in f" {b' '.join(words_of(r.text)).decode()} " for w in windows)}
    assert {r.doc_id for r in clean.collect()} == {r.doc_id for r in single.collect()} - hit and WORD

    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    texts = {r.doc_id: r.text for r in clean.collect()}
    out = stages["tokens"](spark, clean, SMALL).collect()
    assert len(out) == clean.count()
    for r in random.Random(1).sample(out, 30):
        ids = library.encode(texts[r.doc_id], add_special_tokens=False).ids
        assert r.n_tokens == len(ids) and bytes(r.token_ids) == b"".join(i.to_bytes(4, "little") for i in ids)


def test_run(spark):
    out = corpus_pipeline.run(spark, SMALL)
    assert 0 < out.count() < 200 and "n_tokens" in out.columns
