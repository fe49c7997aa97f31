"""Tables and folders in storage that the driver and all executors share."""

from __future__ import annotations

import gc
import re
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder under spark.checkpoint.dir (or the checkpoint folder set on the context), where all executors can write.
    Only where both are unset and one process is driver and executor alike (a local master, as in tests) it is made among
    the machine's temporary ones; on a cluster that is an error."""
    context = spark.sparkContext
    shared = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not shared:
        if not re.fullmatch(r"local(\[[^\]]*\])?", context.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        shared = tempfile.mkdtemp()
    return f"{shared}/{name}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """df, computed once and kept in the shared checkpoint folder. Spark removes it there when nothing refers to it any more: it
    does so only with a setting of the context that is off by default and turned on here, unless the session sets it itself."""
    spark = df.sparkSession
    conf, cleans = spark.sparkContext._jsc.sc().conf(), "spark.cleaner.referenceTracking.cleanCheckpoints"
    if not conf.contains(cleans):
        conf.set(cleans, "true")
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_folder(spark, "checkpoints"))
    return df.checkpoint()


def stored(df: DataFrame) -> DataFrame:
    """df, computed once and written as Parquet to the shared folder: columns are packed, and what reads a few of them reads no more.
    The files stay there, as the result reads them."""
    path = shared_folder(df.sparkSession, "stored")
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Lets Spark remove the shuffle files and checkpoints of what nothing refers to any more: it does so when the driver collects
    its garbage, which a driver with little to do may not for hours."""
    gc.collect()
    spark._jvm.System.gc()


def _file_system(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder, folder.getFileSystem(spark._jsc.hadoopConfiguration())


def remove(spark: SparkSession, path: str) -> None:
    folder, system = _file_system(spark, path)
    system.delete(folder, True)


def exists(spark: SparkSession, path: str) -> bool:
    folder, system = _file_system(spark, path)
    return system.exists(folder)


def batches_in(spark: SparkSession, path: str) -> list[int]:
    """The batches that have a complete folder batch=N in path, in order; none if there is no such path."""
    folder, system = _file_system(spark, path)
    if not system.exists(folder):
        return []
    names = [s.getPath().getName() for s in system.listStatus(folder) if s.isDirectory()]
    found = sorted(int(name[6:]) for name in names if re.fullmatch("batch=[0-9]+", name))
    return [n for n in found if system.exists(_file_system(spark, f"{path}/batch={n}/_SUCCESS")[0])]


#: A day in the name of a landed file or folder.
DAY = r"(20[0-9]{2})-?([01][0-9])-?([0-3][0-9])"


def of_days(spark: SparkSession, path: str, first: str, last: str) -> list[str]:
    """The files and folders in path whose names hold a day from first to last (yyyy-mm-dd), in order: no others are read."""
    folder, system = _file_system(spark, path)
    names = [s.getPath().getName() for s in system.listStatus(folder)] if system.exists(folder) else []
    days = {name: "-".join(found.groups()) for name in names if (found := re.search(DAY, name))}
    return [f"{path}/{name}" for name in sorted(days) if first <= days[name] <= last]


@contextmanager
def workspace(spark: SparkSession, path: str) -> Iterator[Callable[[DataFrame], DataFrame]]:
    """A function that writes a table to a new folder in path and reads it back. The folder is removed at the end, so what is
    used afterwards must not read it."""
    folder, n = f"{path}/{uuid.uuid4().hex}", 0

    def put(df: DataFrame) -> DataFrame:
        nonlocal n
        n += 1
        df.write.option("compression", "zstd").parquet(f"{folder}/{n}")
        return spark.read.schema(df.schema).parquet(f"{folder}/{n}")

    try:
        yield put
    finally:
        remove(spark, folder)


def spread(df: DataFrame) -> DataFrame:
    """df dealt out to all cores where its files make fewer splits than there are cores. Large tables come in more splits
    than that and stay as they are, without an exchange."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)
