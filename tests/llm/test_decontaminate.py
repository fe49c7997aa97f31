import random

from linkgauge.llm import decontaminate
from linkgauge.llm.decontaminate import WORD, Scanner, contamination, drop_contaminated, windows_of

ITEM = "One two three four five six seven eight nine ten eleven"


def brute(text, items, size=10):
    words = WORD.findall((text or "").translate({c: c + 32 for c in range(65, 91)}))
    hit, found = set(), set()
    for i, item in items:
        own = WORD.findall((item or "").translate({c: c + 32 for c in range(65, 91)}))
        for a in range(max(1, len(own) - size + 1)) if own else ():
            w = own[a : a + size]
            for p in range(len(words) - len(w) + 1):
                if words[p : p + len(w)] == w:
                    hit.update(range(p, p + len(w)))
                    found.add(str(i))
    return len(words), len(hit), sorted(found)


def test_against_brute_force_and_offsets(spark):
    random.seed(3)
    vocabulary = ["a", "b", "É", "ß", "x1"]
    items = [(i, " ".join(random.choices(vocabulary, k=n))) for i, n in enumerate((1, 3, 9, 10, 11, 14))] + [(6, None), (7, "--"), (None, "a a a a")]
    texts = ["".join(w + random.choice([" ", ", ", "\n"]) for w in random.choices(vocabulary, k=60)) for _ in range(40)]
    texts += [None, "", ITEM, f"Zwölf <b>{ITEM.upper()}</b>!", items[5][1] * 3, "a"]
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, n_words string")
    bench = spark.createDataFrame([*items, (8, ITEM)], "item_id long, text string")
    rows = {r.doc_id: r for r in contamination(docs, bench).collect()}
    for i, t in enumerate(texts):
        assert (rows[i].n_words, rows[i].n_hit, rows[i]["items"]) == brute(t, [*[x for x in items if x[0] is not None], (8, ITEM)]), t
        for a, b in rows[i].spans:
            assert WORD.fullmatch(t[a]) or t[a].isupper()
            assert b == len(t) or not WORD.fullmatch(t[b].lower()) or ord(t[b]) < 128
    kept = {r.doc_id for r in drop_contaminated(docs, bench).collect()}
    assert kept == {i for i in rows if not rows[i].n_hit}


def test_spans_point_into_the_original():
    s = Scanner({w: ["1"] for w in windows_of(ITEM)})
    text = f"Ä €; {ITEM.upper()}! end"
    n, hit, ids = s.scan(text)
    assert [text[a:b] for a, b in s.spans(text, hit)] == [ITEM.upper()]


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, ITEM)], "doc_id long, text string")
    none = spark.createDataFrame([], "item_id long, text string")
    assert contamination(docs, none).first().n_hit == 0
    assert contamination(docs.limit(0), docs.withColumnRenamed("doc_id", "item_id")).count() == 0


def test_parts_give_what_one_automaton_gives(spark, monkeypatch):
    random.seed(8)
    items = [(i, " ".join(random.choices("abcdefgh", k=random.choice([2, 9, 10, 14])))) for i in range(30)]
    texts = [" ".join(random.choices("abcdefgh", k=80)) for _ in range(30)] + [None, "", "x y " * 40_000 + items[3][1]]
    docs = spark.createDataFrame([(i, t, "f") for i, t in enumerate(texts)] + [(0, texts[0], "f"), (None, texts[1], "f")], "doc_id long, text string, found string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    kept = sorted(map(repr, drop_contaminated(docs, bench).collect()))
    whole = sorted(map(repr, contamination(docs, bench).collect()))
    monkeypatch.setattr(decontaminate, "PART_CHARS", 50)
    assert len([*decontaminate.read_items(bench)]) > 5
    assert sorted(map(repr, contamination(docs, bench).collect())) == whole and len(whole) == len(texts) + 2
    assert sorted(map(repr, drop_contaminated(docs, bench).collect())) == kept
