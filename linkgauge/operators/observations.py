"""Features of HTTP observations and of archive captures."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import urls

# fixed values: kinds of errors, and the weights, bounds and suffixes of the three scores below
ERRORS = ("ssl", "connection", "timeout")


def security_score(url: Column, headers: Column) -> Column:
    """Of an observation's url and header map, whose keys may have any case."""
    keys = F.transform(F.map_keys(headers), lambda k: F.lower(k))
    has = lambda k, w: F.when(F.coalesce(F.array_contains(keys, k), F.lit(False)), w).otherwise(0.0)
    return F.when(F.lower(url).startswith("https://"), 0.3).otherwise(0.0) + has("strict-transport-security", 0.2) + has("x-frame-options", 0.1) + has("x-content-type-options", 0.1) + has("x-xss-protection", 0.1) + has("content-security-policy", 0.2)


def outcome(observed: DataFrame, limit: float = 10.0) -> DataFrame:
    """Adds accessible and error_class; failed requests have status 0 and no redirects, a timeout took the whole limit."""
    failed = F.col("error_type").isNotNull()
    kind = F.when(~failed, F.lit(None)).when(F.lower("error_type").isin(*ERRORS), F.lower("error_type")).otherwise("unknown")
    took = F.when(kind == "timeout", limit).when(failed, 0.0).otherwise(F.col("response_time"))
    return observed.withColumns({"accessible": ~failed, "error_class": kind, "response_time": took, "status_code": F.when(failed, 0).otherwise(F.col("status_code")), "redirect_count": F.when(failed, 0).otherwise(F.col("redirect_count"))})


def host_heuristic(host: Column) -> Column:
    plain = host.rlike(r"^(www|blog|news|support)\.")
    return F.when(urls.tld(host).isin("tk", "ml", "ga", "cf", "gq", "pw", "top"), 0.1).when((F.size(F.split(host, r"\.")) > 2) & ~plain, 0.3).otherwise(0.5)


def captures(cdx: DataFrame) -> DataFrame:
    """(url, ts, status) from index answers (url, body): a JSON array of rows of which the first is a header; short rows go."""
    rows = F.from_json("body", "array<array<string>>")
    out = cdx.select("url", F.explode(F.slice(rows, F.lit(2), F.greatest(F.size(rows) - 1, F.lit(0)))).alias("r")).filter(F.size("r") >= 3)
    return out.select("url", F.col("r")[0].alias("ts"), F.col("r")[1].alias("status"))


def earliest(snapshots: DataFrame, most: int, salts: int = 16) -> DataFrame:
    """The first `most` captures of each url by time (and then status): each of `salts` parts of a url's captures keeps its own first
    ones before they meet, so urls with very many captures do no harm."""
    order = [F.asc_nulls_last("ts"), F.asc_nulls_last("status")]
    first = lambda df, *by: df.withColumn("_n", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).filter(F.col("_n") <= most).drop("_n")
    salted = snapshots.withColumn("_salt", F.pmod(F.xxhash64(*snapshots.columns), F.lit(salts)))
    return first(first(salted, "url", "_salt").drop("_salt"), "url")


def archive_metrics(snapshots: DataFrame, now: Column, max_snapshots: int | None = None) -> DataFrame:
    """One row a url: counts, days since the first and last capture (-1 if no time is readable), captures a day; of all captures, or
    of the first max_snapshots of each url."""
    if max_snapshots is not None:
        snapshots = earliest(snapshots, max_snapshots)
    when = F.unix_timestamp(F.try_to_timestamp("ts", F.lit("yyyyMMddHHmmss")))
    good = F.coalesce(F.col("status").startswith("2"), F.lit(False))
    out = snapshots.groupBy("url").agg(F.count("*").alias("archive_count"), F.count_if(good).alias("successful"), F.count_if(~good).alias("failed"), F.min(when).alias("_first"), F.max(when).alias("_last"), F.count(when).alias("_times"))
    days = lambda c: F.coalesce(F.floor((F.unix_timestamp(now) - F.col(c)) / 86400), F.lit(-1)).cast("long")
    out = out.withColumns({"days_since_first": days("_first"), "days_since_last": days("_last")})
    per_day = F.when(F.col("days_since_first") > 0, F.col("_times") / F.col("days_since_first")).otherwise(0.0)
    return out.select("url", "archive_count", "successful", "failed", "days_since_first", "days_since_last", per_day.alias("per_day"), F.col("_last").isNotNull().alias("archived"))


def archive_trust(metrics: DataFrame) -> DataFrame:
    n, last, first, freq = (F.col(c) for c in ("archive_count", "days_since_last", "days_since_first", "per_day"))
    step = lambda *pairs: _steps(pairs)
    total = (
        step((n >= 50, 0.3), (n >= 20, 0.2), (n >= 5, 0.1)) + step((last <= 30, 0.2), (last <= 90, 0.15), (last <= 365, 0.1), (last <= 1095, 0.05))
        + step((first >= 1095, 0.2), (first >= 365, 0.15), (first >= 180, 0.1)) + F.col("successful") / n * 0.2 + step((freq > 0.1, 0.1), (freq > 0.01, 0.05))
    )
    return metrics.withColumn("archive_trust", F.when(F.col("archived"), F.least(total, F.lit(1.0))).otherwise(0.0))


def _steps(pairs) -> Column:
    out = F.when(*pairs[0])
    for pair in pairs[1:]:
        out = out.when(*pair)
    return out.otherwise(0.0)
