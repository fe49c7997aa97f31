"""Domain reputation: merging, history, ranking."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..sources.shared import cut_lineage

#: Weight of a new observation, hours until a revisit by default.
ALPHA, REVISIT = 0.1, 168


def category(score: Column) -> Column:
    return F.when(score >= 0.7, "trusted").when(score >= 0.3, "good").when(score >= -0.1, "neutral").when(score >= -0.5, "suspicious").otherwise("malicious")


def merge_partial(parts: DataFrame) -> DataFrame:
    """Partial (domain, reputation, total, malicious, benign) -> one row a domain, reputations weighted by total."""
    mean = F.sum(F.col("reputation") * F.col("total")) / F.nullif(F.sum("total"), F.lit(0))
    return parts.groupBy("domain").agg(mean.alias("reputation"), *[F.sum(c).alias(c) for c in ("total", "malicious", "benign")])


def upsert(stored: DataFrame, batch: DataFrame) -> DataFrame:
    """New reputation table from the stored one and a batch of (domain, reputation_score, total_urls_seen,
    malicious_urls_count, benign_urls_count, content_diversity_score): means move by ALPHA, counts add, a null in the
    batch leaves the stored value, a first sight is taken as it is. If either has content_volatility_score or
    predicted_revisit_interval_hours, these are merged too: the first moves, the second is replaced (REVISIT by default)."""
    optional = [c for c in ("content_volatility_score", "predicted_revisit_interval_hours") if c in stored.columns or c in batch.columns]
    stored, batch = (t.withColumns({c: F.lit(None).cast("double") for c in optional if c not in t.columns}) for t in (stored, batch))
    old, new = stored.alias("o"), batch.alias("n")
    o, n = (lambda c: F.col(f"o.{c}")), (lambda c: F.col(f"n.{c}"))
    moved = lambda c: F.coalesce(o(c) * (1 - ALPHA) + n(c) * ALPHA, n(c), o(c)).alias(c)
    added = lambda c: (F.coalesce(o(c), F.lit(0)) + F.coalesce(n(c), F.lit(0))).cast("long").alias(c)
    joined = old.join(new, F.col("o.domain") == F.col("n.domain"), "full_outer")
    return joined.select(F.coalesce(o("domain"), n("domain")).alias("domain"), moved("reputation_score"), *[added(c) for c in ("total_urls_seen", "malicious_urls_count", "benign_urls_count")], moved("content_diversity_score"), *[moved(c) if c == "content_volatility_score" else F.coalesce(n(c), o(c), F.lit(REVISIT)).cast("int").alias(c) for c in optional])


def changed(stored: DataFrame, batch: DataFrame) -> DataFrame:
    """The rows of upsert that a batch changes: those of its domains."""
    return upsert(stored.join(batch.select("domain"), "domain", "left_semi"), batch)


def history_ema(batches: DataFrame) -> DataFrame:
    """The reputation that folding a domain's batches (domain, batch, value) in order yields, in closed form."""
    w = Window.partitionBy("domain")
    numbered = batches.withColumns({"i": F.row_number().over(w.orderBy("batch")), "n": F.count("*").over(w)})
    weight = F.when(F.col("i") == 1, F.pow(F.lit(1 - ALPHA), F.col("n") - 1)).otherwise(ALPHA * F.pow(F.lit(1 - ALPHA), F.col("n") - F.col("i")))
    return numbered.groupBy("domain").agg(F.sum(weight * F.col("value")).alias("reputation_score"), F.count("*").alias("batches"))


def numbered(rows: DataFrame, order: list[Column], name: str = "rank") -> DataFrame:
    """rows numbered from 1 in a total order, without any task seeing more than its own range: rows are sorted by range and
    written once, each range numbers its own, and the ranges' sizes (one number a range) say where each begins."""
    placed = cut_lineage(rows.orderBy(*order).withColumn("_range", F.spark_partition_id()))
    sizes = placed.groupBy("_range").agg(F.count("*").alias("_n"))
    begins = sizes.select("_range", (F.sum("_n").over(Window.orderBy("_range")) - F.col("_n")).alias("_begin"))  # a row a range
    own = placed.withColumn("_own", F.row_number().over(Window.partitionBy("_range").orderBy(*order)))
    return own.join(F.broadcast(begins), "_range").withColumn(name, (F.col("_begin") + F.col("_own")).cast("int")).drop("_range", "_begin", "_own")


def ranked(table: DataFrame, limit: int | None = None, worst: bool = False, min_urls: int = 0) -> DataFrame:
    """Domains in order of reputation (then count, then name), numbered from 1. With a limit the sort keeps that many rows
    a partition; without one the table is numbered range by range."""
    rows = table.filter((F.col("total_urls_seen") >= min_urls) & F.col("reputation_score").isNotNull())
    order = [F.asc("reputation_score"), F.desc("malicious_urls_count")] if worst else [F.desc("reputation_score"), F.desc("total_urls_seen")]
    order.append(F.asc("domain"))
    named = rows.select("domain", "reputation_score", "total_urls_seen", "malicious_urls_count", category(F.col("reputation_score")).alias("category"))
    if limit is None:
        return numbered(named, order)
    return named.orderBy(*order).limit(limit).withColumn("rank", F.row_number().over(Window.orderBy(*order)))


def of_category(table: DataFrame, name: str, limit: int = 100) -> DataFrame:
    """The best of one category with their rank in the whole table: the rank is one more than the better rows counted below
    the category's own order, which needs a count of better categories and a limited sort only."""
    rows = table.filter(F.col("reputation_score").isNotNull())
    own = category(F.col("reputation_score")) == name
    order = [F.desc("reputation_score"), F.desc("total_urls_seen"), "domain"]
    best = rows.filter(own).agg(F.max("reputation_score").alias("_best"))
    ahead = rows.crossJoin(F.broadcast(best)).agg(F.count_if(F.col("reputation_score") > F.col("_best")).alias("_ahead"))
    top = rows.filter(own).orderBy(*order).limit(limit).crossJoin(F.broadcast(ahead))
    return top.select("domain", "reputation_score", "total_urls_seen", (F.row_number().over(Window.orderBy(*order)) + F.col("_ahead")).alias("rank"))


def lookup(table: DataFrame, wanted: DataFrame) -> DataFrame:
    return table.join(wanted.select(F.lower("domain").alias("domain")).distinct(), "domain", "left_semi")


def summary(table: DataFrame) -> DataFrame:
    kind = category(F.col("reputation_score"))
    known = F.col("reputation_score").isNotNull()
    bands = [F.count_if(known & (kind == k)).alias(k) for k in ("trusted", "good", "neutral", "suspicious", "malicious")]
    return table.agg(F.count("*").alias("domains"), F.avg("reputation_score").alias("avg_reputation"), F.sum("total_urls_seen").alias("urls"), F.sum("malicious_urls_count").alias("malicious_urls"), *bands)


def revisit_hours(volatility: Column) -> Column:
    return F.greatest(F.lit(1.0), 720 * (1 - F.least(volatility, F.lit(2.0)) / 2)).cast("int")
