import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from linkgauge.llm.bpe import Encoder, Vocabulary, tokenize

PATH = public_tokenizers.path("byte_bpe_50k.json")
PARTS = ["a", "aa", "the ", " ", "  ", "\n\n", "é", "ñ", "日本", "😀", "12", "'s", "'ll", " ", "​", "\x1c", "\x85", "\t", "<|endoftext|>", "<|endof", "|>", "!!", "###", "x" * 30, "ab" * 20, "ß", "́", "٣", "\x00"]


@pytest.fixture(scope="module")
def both():
    return Encoder(Vocabulary.from_file(PATH)), Tokenizer.from_file(PATH)


def test_same_ids_as_the_library(both):
    own, library = both
    random.seed(5)
    cases = ["", "a" * 3000, "ab" * 2000, " " * 3000, "xyz!" * 700]
    cases += ["".join(random.choices(PARTS, k=random.randint(1, 25))) for _ in range(600)]
    cases += ["".join(random.choices("abcdefghint '", k=60)) for _ in range(600)]
    for text in cases:
        ids = library.encode(text, add_special_tokens=False).ids
        assert own.encode(text) == ids
        assert own.decode(ids) == library.decode(ids, skip_special_tokens=False)


def test_every_entry_of_the_vocabulary_is_its_own_encoding(both):
    own, _ = both
    for i in range(0, 50_256, 7):
        assert own.encode_piece(own.tokens[i]) == [i]


def test_rows(spark):
    df = spark.createDataFrame([(1, "Hello there", 9), (2, None, 9), (3, "", 9), (None, "Hello there", 9), (1, "Hello there", 9)], "doc_id long, text string, token_ids int")
    rows = {(r.doc_id, r.decoded, len(r.token_ids)) for r in tokenize(df, PATH).collect()}
    assert rows == {(1, "Hello there", 8), (2, "", 0), (3, "", 0), (None, "Hello there", 8)}
    assert tokenize(df.limit(0), PATH).count() == 0


def test_frequent_pieces_are_remembered(both, monkeypatch):
    """However many rare pieces came first."""
    from linkgauge.llm import bpe

    monkeypatch.setattr(bpe, "CACHE", 100)
    monkeypatch.setattr(bpe, "PAIRS", 100)
    own, library = bpe.Encoder(Vocabulary.from_file(PATH)), both[1]
    rare = [f" qz{a}{b}x" for a in "abcdefghijklmnopqrst" for b in "abcdefghijklmnopqrst"]
    assert all(own.encode(t) == library.encode(t, add_special_tokens=False).ids for t in rare)
    met, plain = [], own.encode_piece
    own.encode_piece = lambda data: met.append(data) or plain(data)
    for i in range(400):
        text = f" frequentlyzq{rare[i]}"
        assert own.encode(text) == library.encode(text, add_special_tokens=False).ids
    assert met.count(b" frequentlyzq") <= 5 and len(own.cache) <= 100 and len(own.apart) <= 100
