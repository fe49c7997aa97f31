import re
from collections import defaultdict

from linkgauge.llm import common
from linkgauge.llm.linetemplates import CONSTANT, LEAD, MIN_TOKENS, drop_lines, drop_recurring, templates


def mask(line):
    return " ".join("<*>" if re.search("[0-9]", t) else t for t in re.split(r"[ \t\n\x0b\f\r]+", line.strip(" \t\n\x0b\f\r")) if t)


def brute(rows, min_docs=3):
    """Documents are counted by id, each once for a token or template; all rows without an id are one document."""
    docs, first = defaultdict(set), {}
    for i, text in rows:
        for line in {mask(x) for x in text.split("\n")} if text is not None else ():
            if len(line.split(" ")) >= MIN_TOKENS:
                docs[line].add(i)
                first[line] = min((x for x in (i, first.get(line)) if x is not None), default=None)
    leaf = {line: (len(line.split(" ")), *line.split(" ")[:LEAD]) for line in docs}
    in_leaf, steady, by_template = defaultdict(list), defaultdict(set), defaultdict(list)
    for line in docs:
        in_leaf[leaf[line]].append(line)
        for at, token in enumerate(line.split(" ")):
            steady[leaf[line], at, token] |= docs[line]
    for line in docs:
        tokens = [t if len(steady[leaf[line], at, t]) >= min_docs else "<*>" for at, t in enumerate(line.split(" "))]
        if len(in_leaf[leaf[line]]) == 1:
            tokens = line.split(" ")
        elif sum(t != "<*>" for t in tokens) < CONSTANT * len(tokens):
            continue
        by_template[" ".join(tokens)].append(line)
    out = {}
    for lines in by_template.values():
        if len(set().union(*[docs[x] for x in lines])) >= min_docs:
            least = min((first[x] for x in lines if first[x] is not None), default=None)
            out |= dict.fromkeys(lines, least)
    return ["\n".join(x for x in text.split("\n") if mask(x) not in out or out[mask(x)] == i) if text is not None else None for i, text in rows]


def rows():
    out = [(i, f"Page {i} of the big report\nown line number {'abc'[i % 3]}x{i} only\nAll rights are reserved here by {['Ann', 'Bob', 'Cy', 'Dee'][i % 4]}{'q' * i} now") for i in range(9)]
    out += [(20, "a b c"), (21, "a b c"), (22, "a b c"), (23, None), (24, ""), (None, "Page 77 of the big report\nfresh words stand in this"), (25, "Page 1 of  the big\treport ")]
    out += [(30 + i, "the cat sat on the mat today") for i in range(5)] + [(40, "the cat sat alone in some box"), (41, "x " * 50_000)]
    return [*out, out[3], out[3]]


def test_against_brute_force(spark):
    df = spark.createDataFrame([(a, b, 3, "x") for a, b in rows()], "doc_id long, text string, n_chars int, line string").repartition(4)
    got = sorted(((r.doc_id, r.text) for r in drop_recurring(df).collect()), key=repr)
    assert got == sorted(zip([r[0] for r in rows()], brute(rows()), strict=True), key=repr)
    kept = drop_lines(df)
    assert kept.columns == df.columns and kept.dtypes == df.dtypes
    ids = {r.doc_id for r in kept.collect()}
    assert {30, 23, 24, 40, 41} <= ids and not ids & {31, 32, 33, 34, 25}
    assert {r.template for r in templates(df).collect()} >= {"Page <*> of the big report", "All rights are reserved here by <*> now"}


def test_same_result_with_a_full_sieve(spark, monkeypatch):
    df = spark.createDataFrame(rows(), "doc_id long, text string").repartition(3)
    sent = sorted(map(tuple, drop_recurring(df).collect()), key=repr)
    monkeypatch.setattr(common, "SIEVE_BITS", 1)
    assert sorted(map(tuple, drop_recurring(df).collect()), key=repr) == sent


def test_empty(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert drop_lines(none).count() == 0
    assert drop_recurring(spark.createDataFrame([(1, None)], "doc_id long, text string")).first()["_dropped"] == 0


def test_lines_of_numbers_go_only_where_they_recur_as_they_stand(spark):
    tables = [(i, f"{i}.2 3.{i} 5 {i + 6}") for i in range(5)]
    same = [(10 + i, "Call  555 0100 or 555 0199 now") for i in range(4)] + [(20, "Call 555 0100 by 555 0177 today"), (21, "<*> <*> <*> <*>"), (None, "Call 555 0100 or 555 0199 now")]
    same += [(24 + i, "<*> <*> <*> <*> x") for i in range(3)]
    twice = [(30, "Dial 1 2 3 4 5"), (30, "Dial 1 2 3 4 5"), (31, "Dial 1 2 3 4 5\nDial  1 2 3 4 5")]
    got = [(r.doc_id, r.text, r["_dropped"]) for r in drop_recurring(spark.createDataFrame(tables + same + twice, "doc_id long, text string").repartition(3)).collect()]
    expected = [(i, "", 1) if i is None or i in (11, 12, 13, 25, 26) else (i, text, 0) for i, text in tables + same + twice]
    assert sorted(got, key=repr) == sorted(expected, key=repr)


def test_two_documents_are_not_enough(spark):
    red = [(1, "The cat sat on a red mat today ok\nThe cat sat on a blue mat today ok"), (2, "The cat sat on a green mat today ok")]
    alpha = [(3, "Alpha one two beta gamma delta\nAlpha one two beta gamma eps"), (4, "Alpha one two beta gamma delta")] + [(5, "Only one row of this text")] * 5
    kept = drop_recurring(spark.createDataFrame(red + alpha, "doc_id long, text string").repartition(3)).collect()
    assert all(r["_dropped"] == 0 for r in kept) and len(kept) == 9
    third = [(6, "The cat sat on a black mat today ok")]
    got = {r.doc_id: r["_dropped"] for r in drop_recurring(spark.createDataFrame(red + third, "doc_id long, text string")).collect()}
    assert got == {1: 0, 2: 1, 6: 1}
    counted = {r.template: (r.docs, r.first) for r in templates(spark.createDataFrame(red + third + third, "doc_id long, text string")).collect()}
    assert counted == {"The cat sat on a <*> mat today ok": (3, 1)}


def test_columns_of_any_name_stay(spark):
    df = spark.createDataFrame([(i, "Call us on our free line today", 7, "l", i, 1.5) for i in range(4)], "doc_id long, text string, _dropped int, _lines string, n_lines long, doc double")
    kept = drop_lines(df)
    assert kept.dtypes == df.dtypes and [tuple(r) for r in kept.collect()] == [(0, "Call us on our free line today", 7, "l", 0, 1.5)]
    assert drop_recurring(df).dtypes == [("doc_id", "bigint"), ("text", "string"), ("n_lines", "bigint"), ("doc", "double"), ("_lines", "bigint"), ("_dropped", "bigint")]
