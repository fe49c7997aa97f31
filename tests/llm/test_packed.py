import pytest

from linkgauge.llm import linetemplates, neardup
from linkgauge.llm.common import PART_ROWS, PARTS, packed, shelf, sieve


@pytest.fixture
def dealt(spark):
    """Small tables over many partitions, as check_h has them."""
    settings = {"spark.sql.shuffle.partitions": "48", "spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_partitions_follow_the_rows(spark):
    assert packed(spark.range(0, 100, 1, 48), 100).rdd.getNumPartitions() == PARTS
    assert packed(spark.range(0, 100, 1, 48), 20 * PART_ROWS + 1).rdd.getNumPartitions() == 21
    assert packed(spark.range(0, 100, 1, 48), 1000 * PART_ROWS).rdd.getNumPartitions() == 48
    assert packed(spark.range(0, 100, 1, 3), 100).rdd.getNumPartitions() == 3


def test_small_tables_are_stored_in_few_files(dealt):
    texts = ["same words in each of these lines\n" + f"item {i % 9} was sold here today {'twice' if i % 2 else 'again'}\nown line number x{i} of text {i}" for i in range(300)]
    docs = dealt.createDataFrame([*enumerate(texts)], "doc_id long, text string").repartition(48)
    gone = linetemplates.dropped_places(docs)
    assert gone.rdd.getNumPartitions() <= PARTS
    assert gone.count() == 299  # all but the first lose a line at least
    keys = dealt.range(100_000).selectExpr("xxhash64(id) key").localCheckpoint()
    assert sieve(keys, "key").rows.rdd.getNumPartitions() <= PARTS
    labels = neardup.components(dealt.createDataFrame([(i, i + 1) for i in range(200) if i % 50], "a long, b long"))
    assert labels.rdd.getNumPartitions() <= PARTS
    assert {r.node: r.label for r in labels.collect()} == {i: max(1, (i - 1) // 50 * 50 + 1) for i in range(1, 201)}


def test_classes_are_the_same_from_few_files(dealt):
    words = [f"w{i}" for i in range(60)]
    texts = [" ".join(words[:40] + [f"z{i}"]) for i in range(80)] + [" ".join(f"u{i}x{j}" for j in range(30)) for i in range(80)]
    docs = dealt.createDataFrame([*enumerate(texts)], "doc_id long, text string").repartition(48)
    with shelf(dealt) as put:
        _, nodes = neardup.node_classes(docs, neardup.LEAST, put)
        assert nodes.count() == 160
    found = neardup.classes(docs)
    assert found.rdd.getNumPartitions() <= PARTS
    assert {r.doc_id: r.class_id for r in found.collect()} == {i: 0 if i < 80 else i for i in range(160)}
