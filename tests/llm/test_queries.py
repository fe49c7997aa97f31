"""The registered queries themselves: their columns, held-out rows, thresholds and digests, by plain Python."""

import hashlib
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from linkgauge.llm import linetemplates, queries
from linkgauge.llm.common import table
from tests.llm.test_linetemplates import brute as brute_lines
from tests.llm.test_neardup import brute as brute_classes
from tests.llm.test_stableann import exact

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    return {r.doc_id: r for r in table(spark, SMALL, "documents").collect()}


def held(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 4 == 2


def test_op2(spark, docs):
    got = {r.doc_id: r.class_id for r in queries.op2_neardup(spark, SMALL).collect()}
    assert got == dict(brute_classes([(i, r.text) for i, r in docs.items()]))


def test_op4(spark, docs):
    rows = [(i, r.text) for i, r in docs.items()]
    out = queries.op4_lines(spark, SMALL).collect()
    assert {r.doc_id: r.text for r in out} == {i: t for (i, _), t in zip(rows, brute_lines(rows), strict=True)}
    assert all(r.n_lines == len(docs[r.doc_id].text.split("\n")) for r in out)
    assert all(r.n_dropped == 0 for r in out if r.text == docs[r.doc_id].text) and linetemplates.MIN_TOKENS == 4


def test_op5_and_op10(spark, docs):
    for query, threshold in ((queries.op5_quality, 0.7), (queries.op10_toxicity, 0.3)):
        out = query(spark, SMALL).collect()
        assert sorted(r.doc_id for r in out) == sorted(docs)
        assert all(r.held_out == held(r.doc_id) and r.predicted == int(r.score >= threshold) and 0 <= r.score <= 1 for r in out)


def test_op6(spark, docs):
    out = queries.op6_langid(spark, SMALL).collect()
    assert sorted(r.doc_id for r in out) == sorted(docs) and all(r.held_out == held(r.doc_id) for r in out)
    assert np.mean([r.lang_pred == docs[r.doc_id].lang for r in out if r.held_out and docs[r.doc_id].lang]) > 0.9
    assert {r.lang_pred for r in out} <= {r.lang for r in docs.values()} | {"und"}


def test_op7(spark):
    data = {r.vec_id: r.embedding for r in table(spark, SMALL, "embeddings").collect()}
    out = queries.op7_neighbours(spark, SMALL).collect()
    asked = [i for i in data if i % 50 == 0]
    true = exact(list(data), list(data.values()), asked)
    assert {(r.query_id, r["rank"]) for r in out} == {(q, n) for q in asked for n in range(1, 6)}
    assert sum(r.vec_id in true[r.query_id] for r in out) >= 0.9 * len(out)


def test_op9(spark, docs):
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    for r in queries.op9_bpe(spark, SMALL).collect():
        ids = library.encode(docs[r.doc_id].text or "", add_special_tokens=False).ids
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()
