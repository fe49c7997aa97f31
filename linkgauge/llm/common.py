"""Small helpers that the operators of this subpackage share."""

from __future__ import annotations

import gc
import re
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows and bytes of one Arrow batch, whichever is reached first: texts may be megabytes each.
BATCH_ROWS, BATCH_BYTES = 500, 4 << 20
#: Bits of a sieve at least and at most (4 and 64 MB), and bits for each of its keys between these bounds.
SIEVE_BITS, MOST_BITS, BITS_A_KEY = 1 << 25, 1 << 29, 16
#: Partitions that packed() leaves at least, and the rows for which it leaves one more.
PARTS, PART_ROWS = 16, 50_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def held_out(doc_id: Column) -> Column:
    """True for rows that no model may learn from: crc32 of the id as text leaves 2 modulo 4. A null id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def map_batches(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema) -> DataFrame:
    """mapInArrow with batches small enough for long texts. Spark has no setting for a single plan, so the session's is set."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return df.mapInArrow(fn, schema)


def keep_rows(df: DataFrame, keep: Callable[[], Callable[[pa.RecordBatch], list[bool]]]) -> DataFrame:
    """Rows for which keep()(batch) says True, with all their columns. keep() is called once in each task."""

    def run(batches):
        decide = keep()
        for batch in batches:
            yield batch.filter(pa.array(decide(batch), pa.bool_()))

    return map_batches(df, run, df.schema)


def texts(batch: pa.RecordBatch, name: str = "text") -> list[str | None]:
    return batch.column(batch.schema.get_field_index(name)).to_pylist()


def text_bytes(batch: pa.RecordBatch, name: str = "text") -> list[bytes | None]:
    """Texts as UTF-8."""
    return batch.column(batch.schema.get_field_index(name)).cast(pa.binary()).to_pylist()


def replaced(batch: pa.RecordBatch, schema: pa.Schema, **columns: pa.Array) -> pa.RecordBatch:
    """The columns that schema names, those given here in place of the batch's own."""
    return pa.RecordBatch.from_arrays([columns[f.name] if f.name in columns else batch.column(batch.schema.get_field_index(f.name)) for f in schema], schema=schema)


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or the checkpoint folder set on the context. Only
    where both are unset and one process is driver and executor alike (a local master, as in tests) a folder of its own is
    made; on a cluster that is an error."""
    context = spark.sparkContext
    found = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not found:
        if not re.fullmatch(r"local(\[[^\]]*\])?", context.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        context.setCheckpointDir(tempfile.mkdtemp())
        found = context.getCheckpointDir()
    return found


def packed(df: DataFrame, rows: int) -> DataFrame:
    """df, to be stored, in one partition for each PART_ROWS of rows, PARTS at least, or as many as it has if these are fewer.
    rows is a bound of its own rows, or what its work grows with.

    Every stored partition is a file, and on a local file system every file starts several short processes, which share the
    executor's memory until they have begun: small tables dealt over many partitions would start thousands."""
    return df.coalesce(max(PARTS, -(-rows // PART_ROWS)))


def cut_lineage(df: DataFrame, rows: int | None = None) -> DataFrame:
    """df, written once to the shared checkpoint folder, packed if rows are given. Spark removes it there when nothing refers to it any more: it does
    so only with a setting of the context that is off by default and turned on here, unless the session sets it itself."""
    context = df.sparkSession.sparkContext
    conf, cleans = context._jsc.sc().conf(), "spark.cleaner.referenceTracking.cleanCheckpoints"
    if not conf.contains(cleans):
        conf.set(cleans, "true")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return (df if rows is None else packed(df, rows)).checkpoint()


def remove_folder(spark: SparkSession, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def release(spark: SparkSession) -> None:
    """Lets Spark remove the shuffle files of what nothing refers to any more: it does so when the driver collects its garbage,
    which a driver with little to do may not for hours."""
    gc.collect()
    spark._jvm.System.gc()


@contextmanager
def shelf(spark: SparkSession) -> Iterator[Callable[..., DataFrame]]:
    """A function that writes a table to the shared folder, packed if rows are given, and reads it back. All its tables are removed at the end, so
    what is returned from the block must not read them: it is written by cut_lineage before."""
    folder, n = f"{shared_folder(spark)}/shelf-{uuid.uuid4().hex}", 0

    def put(df: DataFrame, rows: int | None = None) -> DataFrame:
        nonlocal n
        n += 1
        (df if rows is None else packed(df, rows)).write.option("compression", "zstd").parquet(f"{folder}/{n}")
        return spark.read.schema(df.schema).parquet(f"{folder}/{n}")

    try:
        yield put
    finally:
        remove_folder(spark, folder)


def row_key(*columns: str) -> list[Column]:
    """row_a and row_b: 128 bits that stand for a row's id and text."""
    return [F.xxhash64(*columns).alias("row_a"), F.xxhash64(F.lit(7), *columns).alias("row_b")]


ROW = ["row_a", "row_b"]


class Sieve(NamedTuple):
    """A bit map of hashes as rows (bucket, bits). Rows whose bit is not set hold none of the keys, so only the others need
    to meet them in a join. Its size follows the keys up to MOST_BITS, which bounds what is sent to the tasks; beyond some
    hundred million keys it fills up and lets more and more rows through, with the same result."""

    rows: DataFrame
    size: int


def sieve(keys: DataFrame, key: str) -> Sieve:
    """Of the hashes in column key. keys is read twice, so it should have been written."""
    n = keys.count()
    size = max(SIEVE_BITS, min(MOST_BITS, 1 << (n * BITS_A_KEY).bit_length()))
    spot = keys.select((F.pmod(F.col(key), F.lit(size)) + 1).alias("spot")).distinct()
    spot = spot.select(F.bitmap_bucket_number("spot").alias("bucket"), F.bitmap_bit_position("spot").alias("at")).repartition("bucket")
    return Sieve(cut_lineage(spot.groupBy("bucket").agg(F.bitmap_construct_agg("at").alias("bits")), n), size)


def sifted(df: DataFrame, held: Sieve, key: str) -> tuple[DataFrame, DataFrame]:
    """The rows of df that may hold one of the sieve's keys, and the rows that do not."""
    spot = F.pmod(F.col(key), F.lit(held.size)) + 1
    named = held.rows.select(F.col("bucket").alias("_bucket"), F.col("bits").alias("_bits"))
    joined = df.join(F.broadcast(named), F.bitmap_bucket_number(spot) == F.col("_bucket"), "left")
    at = F.bitmap_bit_position(spot)
    byte = F.conv(F.hex(F.substr("_bits", (F.shiftright(at.cast("int"), 3) + 1), F.lit(1))), 16, 10).cast("int")
    told = F.coalesce(F.getbit(byte, (at % 8).cast("int")) == 1, F.lit(False))
    return joined.filter(told).drop("_bucket", "_bits"), joined.filter(~told).drop("_bucket", "_bits")


def sent(held: Sieve) -> Broadcast:
    """The sieve's bits for Python tasks: at most MOST_BITS, however many keys there are."""
    bits = np.zeros(-(-held.size // 32768) * 4096, np.uint8)
    for bucket, own in held.rows.toLocalIterator():
        bits[(bucket - 1) * 4096 : bucket * 4096] = np.frombuffer(bytes(own), np.uint8)
    return held.rows.sparkSession.sparkContext.broadcast(bits)


def passes(bits: np.ndarray, size: int, keys: np.ndarray) -> np.ndarray:
    """Which of the 64-bit keys the sieve lets through."""
    spot = keys.view(np.uint64) % np.uint64(size)
    return (bits[(spot >> np.uint64(3)).astype(np.int64)] >> (spot & np.uint64(7)).astype(np.uint8)) & 1 > 0
