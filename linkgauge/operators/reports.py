"""Report tables over scored URLs: overall, by source, curated benchmark, best and worst, model comparison."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Accuracy of approximate percentiles: ranks are right to one part in this many.
ACCURACY = 10_000


def _spam():
    return F.count_if(F.col("is_spam"))


def overall(rows: DataFrame, *by: str) -> DataFrame:
    """Counts, averages and percentiles of all rows, or of each value of the columns `by` (such as model_name)."""
    p = F.percentile_approx("score", F.array(F.lit(0.5), F.lit(0.75), F.lit(0.95)), ACCURACY)
    out = rows.groupBy(*by).agg(
        F.count("*").alias("total"), _spam().alias("spam"), F.avg("score").alias("avg_score"),
        F.avg("confidence").alias("avg_confidence"), F.stddev("score").alias("score_stddev"), p.alias("_p"),
    )
    # on its own: beside a distinct count, every url would get percentile buffers
    urls = rows.select(*by, "url").distinct().groupBy(*by).agg(F.count("url").alias("distinct_urls"))
    out = out.join(urls, list(by)) if by else out.crossJoin(F.broadcast(urls))
    return out.select(*by, "total", "distinct_urls", "spam", (F.col("total") - F.col("spam")).alias("not_spam"), "avg_score", "avg_confidence", "score_stddev", *[F.col("_p")[i].alias(c) for i, c in enumerate(("p50", "p75", "p95"))])


def by_source(rows: DataFrame) -> DataFrame:
    return rows.groupBy("data_source").agg(F.count("*").alias("urls"), F.avg("score").alias("avg_score"), _spam().alias("spam"))


def curated_benchmark(rows: DataFrame) -> DataFrame:
    """Share, upper percentiles and spam rates of the curated feed."""
    good = F.col("data_source") == "good_data"
    score = F.when(good, F.col("score"))
    p = F.percentile_approx(score, F.array(F.lit(0.75), F.lit(0.95)), ACCURACY)
    out = rows.agg(F.count("*").alias("_all"), F.count_if(good).alias("curated"), F.count_if(good & F.col("is_spam")).alias("_spam"), p.alias("_p"))
    rate = F.col("_spam") / F.nullif("curated", F.lit(0))
    return out.select("curated", (F.col("curated") / F.nullif("_all", F.lit(0))).alias("share"), F.col("_p")[0].alias("p75"), F.col("_p")[1].alias("p95"), rate.alias("spam_rate"), (1 - rate).alias("clean_rate"))


def extreme_urls(rows: DataFrame, best: bool = True, n: int = 10) -> DataFrame:
    """The n highest (or lowest) scores, ties by url."""
    order = F.desc("score") if best else F.asc("score")
    return rows.filter(F.col("score").isNotNull()).select("url", "score", "confidence", "domain", "data_source").orderBy(order, "url").limit(n)


def lift(rows: DataFrame) -> DataFrame:
    """Curated average against the input's, curated urls among the ten best and worst, and a grade."""
    good = F.col("data_source") == "good_data"
    means = rows.agg(F.avg(F.when(good, F.col("score"))).alias("curated_avg"), F.avg(F.when(~good, F.col("score"))).alias("input_avg"))
    top = extreme_urls(rows).agg(F.count_if(good).alias("in_top"))
    low = extreme_urls(rows, best=False).agg(F.count_if(good).alias("in_bottom"))
    gain = F.col("curated_avg") - F.col("input_avg")
    grade = F.when(gain > 0.5, "EXCELLENT").when(gain > 0.2, "GOOD").when(gain > 0, "FAIR").otherwise("POOR")
    percent = F.when(F.col("input_avg") > 0, gain / F.col("input_avg") * 100)
    return means.crossJoin(F.broadcast(top)).crossJoin(F.broadcast(low)).select("curated_avg", "input_avg", gain.alias("lift"), percent.alias("lift_percent"), "in_top", "in_bottom", grade.alias("grade"))


def frequent_domains(rows: DataFrame, n: int = 10, curated: bool = False) -> DataFrame:
    """The n domains with most urls and their share of all; of the curated feed alone if asked."""
    rows = rows.filter(F.col("data_source") == "good_data") if curated else rows
    total = rows.agg(F.count("*").alias("_total"))
    top = rows.groupBy("domain").agg(F.count("*").alias("urls")).orderBy(F.desc("urls"), "domain").limit(n)
    return top.crossJoin(F.broadcast(total)).select("domain", "urls", (F.col("urls") / F.col("_total")).alias("share"))


def paired(a: DataFrame, b: DataFrame) -> DataFrame:
    """(url, score_a, score_b, spam_a, spam_b): one row for each url that both models scored."""
    key = "url_hash" if "url_hash" in a.columns and "url_hash" in b.columns else "url"  # urls may have been cut
    one = lambda df, x: df.groupBy(key).agg(F.max("url").alias("url"), F.max("score").alias(f"score_{x}"), F.max("is_spam").alias(f"spam_{x}"))
    both = one(a, "a").join(one(b, "b").drop("url"), key) if key != "url" else a.groupBy("url").agg(F.max("score").alias("score_a"), F.max("is_spam").alias("spam_a")).join(b.groupBy("url").agg(F.max("score").alias("score_b"), F.max("is_spam").alias("spam_b")), "url")
    return both.select("url", "score_a", "score_b", "spam_a", "spam_b")


def agreement(pairs: DataFrame) -> DataFrame:
    """Confusion table of the verdicts with the scores' correlation and the agreement over all pairs."""
    stats = pairs.agg(F.corr("score_a", "score_b").alias("correlation"), F.avg((F.col("spam_a") == F.col("spam_b")).cast("double")).alias("agreement"))
    return pairs.groupBy("spam_a", "spam_b").agg(F.count("*").alias("urls")).crossJoin(F.broadcast(stats))


def differences(pairs: DataFrame, n: int = 10) -> DataFrame:
    gap = F.abs(F.col("score_a") - F.col("score_b"))
    return pairs.select("url", "score_a", "score_b", F.round(gap, 9).alias("gap")).orderBy(F.desc("gap"), "url").limit(n)


def section(table: DataFrame, name: str, order: list[Column] | None = None) -> DataFrame:
    """A report table of few rows as (section, rank, metric, value, text): a row for each of its values. Rows are ranked in
    the given order; a table without one has its only row at 1. Numbers and flags stand in value, the others in text."""
    ranked = table.withColumn("_rank", F.row_number().over(Window.orderBy(*order)) if order else F.lit(1))
    number = lambda c, kind: F.lit(None).cast("double") if kind == "string" else F.col(c).cast("double")
    text = lambda c, kind: F.col(c) if kind == "string" else F.lit(None).cast("string")
    cells = F.array(*[F.struct(F.lit(c).alias("metric"), number(c, kind).alias("value"), text(c, kind).alias("text")) for c, kind in table.dtypes])
    return ranked.select(F.lit(name).alias("section"), F.col("_rank").alias("rank"), F.explode(cells).alias("cell")).select("section", "rank", "cell.*")


def sections(rows: DataFrame) -> dict[str, DataFrame]:
    """All report tables of scored rows, each in its order."""
    most = [F.desc("urls"), F.asc("domain")]
    return {
        "overall": section(overall(rows), "overall"), "by_source": section(by_source(rows), "by_source", [F.asc("data_source")]),
        "curated_benchmark": section(curated_benchmark(rows), "curated_benchmark"), "lift": section(lift(rows), "lift"),
        "best_urls": section(extreme_urls(rows), "best_urls", [F.desc("score"), F.asc("url")]), "worst_urls": section(extreme_urls(rows, best=False), "worst_urls", [F.asc("score"), F.asc("url")]),
        "frequent_domains": section(frequent_domains(rows), "frequent_domains", most), "frequent_curated_domains": section(frequent_domains(rows, curated=True), "frequent_curated_domains", most),
    }


def summary(rows: DataFrame) -> DataFrame:
    """The whole report of scored rows as one table (section, rank, metric, value, text)."""
    return reduce(DataFrame.unionByName, sections(rows).values())


def lines(table: DataFrame, name: str, columns: list[str]) -> DataFrame:
    """A section of a written report as (rank, one column a metric), in texts: whole numbers without decimals."""
    number = F.when(F.col("value") == F.floor("value"), F.col("value").cast("bigint").cast("string")).otherwise(F.col("value").cast("string"))
    shown = table.filter(F.col("section") == name).withColumn("shown", F.coalesce("text", number))
    return shown.groupBy("rank").agg(*[F.max(F.when(F.col("metric") == c, F.col("shown"))).alias(c) for c in columns]).orderBy("rank")
