"""Domain statistics that can be merged: partial tables with sketches of distinct values and of score quantiles.

A batch leaves one row a domain: sums and counts, HyperLogLog sketches of urls and path segments, and a KLL sketch of scores.
Rows of several batches are merged by adding and uniting, in any order and in any number of steps, without going back to
the urls. Distinct counts are right within about 1.6 percent (2^12 registers) twice over, ranks of quantiles within about 1.3 percent.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

REGISTERS, K = 12, 200
#: Relative error of distinct counts and absolute error of ranks that estimates keep in all but rare cases: three deviations.
DISTINCT_ERROR, RANK_ERROR = 0.05, 0.03
DISTINCT = ("url", "segment1", "segment2")
SUMS = ("total", "spam", "score_sum", "score_squares")


def partial(rows: DataFrame) -> DataFrame:
    """One row a domain of scored rows (domain, url, segment1, segment2, score, is_spam)."""
    known = rows.filter(F.col("domain").isNotNull() & (F.col("domain") != ""))
    return known.groupBy("domain").agg(
        F.count("*").alias("total"), F.count_if("is_spam").alias("spam"), F.sum("score").alias("score_sum"), F.sum(F.col("score") * F.col("score")).alias("score_squares"),
        *[F.hll_sketch_agg(c, F.lit(REGISTERS)).alias(f"{c}_sketch") for c in DISTINCT], F.kll_sketch_agg_double("score", F.lit(K)).alias("score_sketch"),
    )


def merged(parts: DataFrame) -> DataFrame:
    """Partial rows with one row a domain."""
    return parts.groupBy("domain").agg(*[F.sum(c).alias(c) for c in SUMS], *[F.hll_union_agg(f"{c}_sketch").alias(f"{c}_sketch") for c in DISTINCT], F.kll_merge_agg_double("score_sketch").alias("score_sketch"))


def read(parts: DataFrame, quantiles: tuple[float, ...] = (0.5, 0.95)) -> DataFrame:
    """(domain, total, spam, mean_score, score_stddev, distinct_url, distinct_segment1, distinct_segment2, p50, p95) of partial rows."""
    spread = F.greatest(F.lit(0.0), F.col("score_squares") - F.col("score_sum") * F.col("score_sum") / F.col("total")) / (F.col("total") - 1)
    return parts.select(
        "domain", "total", "spam", (F.col("score_sum") / F.col("total")).alias("mean_score"), F.when(F.col("total") > 1, F.sqrt(spread)).alias("score_stddev"),
        *[F.hll_sketch_estimate(f"{c}_sketch").alias(f"distinct_{c}") for c in DISTINCT], *[F.kll_sketch_get_quantile_double("score_sketch", F.lit(q)).alias(f"p{round(q * 100)}") for q in quantiles],
    )
