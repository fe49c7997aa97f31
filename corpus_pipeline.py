"""From raw documents to token ids: five stages, each taking the rows that the one before kept.

A stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of documents. Stages are
written as Parquet and read again between each other.

In every stage a null doc_id is a value like others, repeated rows are decided alike (near_duplicates keeps one of them), an
empty table gives an empty table, texts may have any length, and columns besides doc_id and text (and n_chars, which follows
the text) are carried through under whatever names. Null and empty texts end at the first stage, as they have no letter; the
later stages would keep them.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkgauge.llm import bpe, decontaminate, langid, linetemplates, neardup
from linkgauge.llm.common import remove_folder, shared_folder, table

#: Mean probability below which a document's language counts as unknown.
LEAST_LANGUAGE = 0.3


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language the byte network tells; texts without a letter and doubtful ones go."""
    return langid.keep_identified(docs, langid.fit(docs), LEAST_LANGUAGE)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines of recurring templates; documents that consisted of such lines alone go."""
    return linetemplates.drop_lines(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates: the one with the least doc_id."""
    return neardup.keep_first(docs)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in whose text no window of a benchmark item occurs."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, the number of tokens and the ids, checked by decoding them again."""
    rows = bpe.tokenize(docs, public_tokenizers.path("byte_bpe_50k.json"))
    return rows.select("doc_id", (F.length("token_ids") / 4).cast("long").alias("n_tokens"), "token_ids", F.sha2("token_ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [("language", language), ("lines", lines), ("near_duplicates", near_duplicates), ("benchmark", benchmark), ("tokens", tokens)]

#: The language network is trained by gradient descent, which SQL cannot express; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; what a stage keeps is written to the folder that the cluster shares, and removed when the
    next stage has been written. The last copy stays, as the result reads it."""
    docs = table(spark, sf_dir, "documents")
    folder, before = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}", None
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
        if before:
            remove_folder(spark, before)
        before = f"{folder}/{name}"
    return STAGES[-1][1](spark, docs, sf_dir)
