"""Readers of landed files and tables: host and keyword lists, the curated feed, the reputation table."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# fixed value: the columns of the curated feed
CURATED = "url string, source_uri string, timestamp string, user_text string, source_type string, metadata string"
#: Keywords up to which a list becomes one pattern, which every task compiles; longer lists stay tables, with the same flags.
MOST_KEYWORDS = 10_000


def read_list(spark: SparkSession, path: str, strict: bool = True) -> DataFrame:
    """(entry): the lines of a list file, trimmed and in lower case, each once, blank ones left out. A list that is missing
    or has no entry is an error if strict, and empty otherwise."""
    try:
        entries = spark.read.text(path).select(F.lower(F.trim("value")).alias("entry")).filter("entry <> ''").distinct()
    except AnalysisException as e:
        if strict or e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], "entry string")
    if strict and entries.isEmpty():
        raise ValueError(f"the list {path} has no entry")
    return entries


def read_hosts(spark: SparkSession, path: str, strict: bool = True) -> DataFrame:
    return read_list(spark, path, strict).withColumnRenamed("entry", "host")


def read_keywords(spark: SparkSession, path: str, strict: bool = True) -> tuple[str, ...] | DataFrame:
    """The keywords of a list: in order, or, if they are many, as a table (entry)."""
    entries = read_list(spark, path, strict)
    found = [r.entry for r in entries.orderBy("entry").limit(MOST_KEYWORDS + 1).collect()]
    return tuple(found) if len(found) <= MOST_KEYWORDS else entries


def read_curated(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Curated rows of tab-separated files with a header, in which quotes are doubled; rows without a url are left out."""
    rows = spark.read.schema(CURATED).option("header", True).option("sep", "\t").option("escape", '"').csv(paths)
    return rows.filter(F.col("url").isNotNull() & (F.trim("url") != ""))


#: Keys that are looked at to deal a database table out to readers.
SAMPLED = 10_000


def read_reputation(spark: SparkSession, url: str, table: str, columns: list[str] | None = None, readers: int = 1, where: str | None = None, **options: str) -> DataFrame:
    """The reputation table of a database, all its columns or some, its rows or those of a condition: only these are fetched.
    With several readers the domains are read in that many ranges of about equal size, whatever their names: the ranges end at
    quantiles of SAMPLED domains, those with the least hashes."""
    source = f"(select * from {table} where {where}) r" if where else table
    if readers > 1:
        keys = spark.read.format("jdbc").option("url", url).option("dbtable", source).options(**options).load().select("domain").filter("domain is not null")
        found = sorted(r.domain for r in keys.orderBy(F.xxhash64("domain")).limit(SAMPLED).collect())
        cuts = sorted({found[len(found) * i // readers] for i in range(1, readers)}) if found else []
        quoted = ["'" + c.replace("'", "''") + "'" for c in cuts]
        name = '"domain"'
        parts = [f"{name} < {quoted[0]} or {name} is null", *[f"{name} >= {a} and {name} < {b}" for a, b in zip(quoted, quoted[1:], strict=False)], f"{name} >= {quoted[-1]}"] if quoted else ["1 = 1"]
        found = spark.read.jdbc(url, source, predicates=parts, properties=options)
    else:
        found = spark.read.format("jdbc").option("url", url).option("dbtable", source).options(**options).load()
    return found.select(*columns) if columns else found
