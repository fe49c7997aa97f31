"""Where scored batches go: Parquet, TSV, JDBC, the url store, reputation snapshots and text reports."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import urls
from .shared import batches_in, exists, release, remove, shared_folder, workspace

ROWS_PER_FILE = 500_000
#: Parts of a meta text, of which none may be missing.
META = ("domain", "confidence", "is_spam", "risk_score", "trust_score", "composite_score")
KEY = ("url_hash", "source")
#: Buckets of a new url store: as many as a batch's joins have partitions, or more.
BUCKETS = 200
#: Batches between two whole reputation tables, and how many of these are kept.
BASE_EVERY, KEPT_BASES = 10, 3


def write_parquet(df: DataFrame, path: str, by_model: bool = False) -> None:
    out = df.write.mode("overwrite").option("compression", "snappy").option("maxRecordsPerFile", ROWS_PER_FILE)
    (out.partitionBy("model_name") if by_model else out).parquet(path)


def write_tsv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("sep", "\t").option("header", True).csv(path)


def write_jdbc(df: DataFrame, url: str, table: str, writers: int = 32, **options: str) -> None:
    """Appends with at most `writers` connections; JSON text goes into typed columns."""
    df.repartition(writers, "url").write.format("jdbc").option("url", url).option("dbtable", table).option("batchsize", 20_000).option("stringtype", "unspecified").options(**options).mode("append").save()


def write_reputation_table(df: DataFrame, url: str, table: str, **options: str) -> None:
    """The whole reputation table in place of the database's: truncated rather than dropped, so that its columns keep their types."""
    df.write.format("jdbc").option("url", url).option("dbtable", table).option("truncate", True).option("batchsize", 20_000).options(**options).mode("overwrite").save()


def store_rows(scored: DataFrame, processed_at: str) -> DataFrame:
    """Rows of the url store: a hash of the whole url, source, state and a JSON text of the parts in META (nulls are left out),
    which scored rows hold as `meta` or one by one."""
    meta = F.col("meta") if "meta" in scored.columns else F.to_json(F.struct(*META))
    whole = F.col("url_hash") if "url_hash" in scored.columns else urls.fingerprint(F.col("url"))
    return scored.select("url", whole.alias("url_hash"), F.col("data_source").alias("source"), F.lit(processed_at).cast("timestamp").alias("processed_at"), F.lit("processed").alias("status"), F.lit(0).alias("priority"), "score", meta.alias("meta"))


def absent(rows: DataFrame, existing: DataFrame, key: tuple[str, ...] = KEY) -> DataFrame:
    """rows whose key the store does not hold, one a key (the highest score): what may be appended, however often it is tried."""
    new = rows.join(existing.select(*key), list(key), "left_anti")
    rest = [c for c in rows.columns if c not in key]
    best = new.groupBy(*key).agg(F.max(F.struct("score", *[c for c in rest if c != "score"])).alias("r"))
    return best.select(*key, *[F.col(f"r.{c}").alias(c) for c in rest]).select(*rows.columns)


def store_table(spark: SparkSession, path: str, schema: str, buckets: int = BUCKETS) -> str:
    """The store in path as a table of the session, with a partition a batch and its rows in buckets by `entry`: joins by that
    read its buckets as they lie, without exchanging them. A store that other sessions wrote is taken up with its batches;
    its number of buckets has to stay the same."""
    name = f"url_store_{hashlib.md5(path.encode()).hexdigest()[:16]}"
    if not spark.catalog.tableExists(name):
        spark.sql(f"create table {name} ({schema}, batch int) using parquet options (compression 'zstd') partitioned by (batch) clustered by (entry) into {buckets} buckets location '{path}'")
        if exists(spark, path):
            spark.sql(f"alter table {name} recover partitions")
    return name


def with_entry(rows: DataFrame, key: tuple[str, ...] = KEY) -> DataFrame:
    """Adds entry, a hash of the key in one column: buckets and joins need no more, whichever columns the key has."""
    return rows.withColumn("entry", F.sha2(F.concat_ws("\n", *key), 256))


def insert_absent(rows: DataFrame, path: str, batch_id: int, key: tuple[str, ...] = KEY, buckets: int = BUCKETS) -> None:
    """Writes the batch's new rows as their own part of the store. A replayed batch leaves its part out of the comparison and
    overwrites it, so it ends with the same rows. They are written to the shared folder before, as a table cannot be read and overwritten at
    once, and removed there afterwards."""
    spark, rows = rows.sparkSession, with_entry(rows, key)
    name = store_table(spark, path, ", ".join(f"`{c}` {kind}" for c, kind in rows.dtypes), buckets)
    with workspace(spark, shared_folder(spark, "absent")) as put:
        new = put(absent(rows, spark.table(name).filter(F.col("batch") < batch_id), ("entry",)))
        release(spark)
        spark.sql(f"insert overwrite table {name} partition (batch = {int(batch_id)}) select {', '.join(f'`{c}`' for c in rows.columns)} from {{new}}", new=new)


def latest_reputation(spark: SparkSession, path: str, before: int) -> DataFrame | None:
    """The reputation table as the batches before one left it: the newest whole table, and of each domain that changed since
    the newest row."""
    bases = [n for n in batches_in(spark, f"{path}_base") if n < before]
    changes = [n for n in batches_in(spark, path) if n < before and n > max(bases, default=-1)]
    read = lambda root, n: spark.read.parquet(f"{root}/batch={n}").withColumn("_batch", F.lit(n))
    parts = [read(f"{path}_base", n) for n in bases[-1:]] + [read(path, n) for n in changes]
    if not parts:
        return None
    if len(parts) == 1:
        return parts[0].drop("_batch")
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part, allowMissingColumns=True)
    names = [c for c in rows.columns if c not in ("domain", "_batch")]
    newest = rows.groupBy("domain").agg(F.max_by(F.struct(*names), "_batch").alias("r"))
    return newest.select("domain", "r.*")


def write_reputation(changed: DataFrame, path: str, batch_id: int, base_every: int = BASE_EVERY, kept: int = KEPT_BASES) -> None:
    """Writes the domains that a batch changed. Every base_every-th batch the whole table is written as well, and what lies before
    the last `kept` whole tables is removed: batches older than these cannot be replayed any more."""
    spark = changed.sparkSession
    changed.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")
    if (batch_id + 1) % base_every == 0:
        latest_reputation(spark, path, batch_id + 1).write.mode("overwrite").parquet(f"{path}_base/batch={batch_id}")
        bases = [n for n in batches_in(spark, f"{path}_base") if n <= batch_id]
        oldest = bases[-kept] if len(bases) >= kept else -1
        for root, old in ((path, lambda n: n <= oldest), (f"{path}_base", lambda n: n < oldest)):
            for n in filter(old, batches_in(spark, root)):
                remove(spark, f"{root}/batch={n}")


def write_report(df: DataFrame, path: str) -> None:
    """A report table as text, a line a row."""
    line = F.concat_ws("  ", *[F.concat(F.lit(f"{c}: "), F.coalesce(F.col(c).cast("string"), F.lit("-"))) for c in df.columns])
    df.select(line.alias("value")).coalesce(1).write.mode("overwrite").text(path)


def write_counts(spark: SparkSession, counts: dict[str, int], path: str, batch_id: int) -> None:
    """What was counted of a batch, as one row."""
    spark.createDataFrame([tuple(int(v) for v in counts.values())], ", ".join(f"{k} long" for k in counts)).write.mode("overwrite").parquet(f"{path}/batch={batch_id}")
