"""Arriving files as micro-batches: each file is scored, merged into the reputation, and inserted into the store once."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import UTC, datetime

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from ..config import PipelineConfig
from ..operators import curated, domains, enhance, links, ml, observations, pages, reports, scoring
from ..sources import sinks
from ..sources.shared import cut_lineage, release, workspace

FEED = "ts string, url string"
METHODS = ("rules", "gbt")


@dataclass(frozen=True)
class Landed:
    """What a batch reads beside the feed and the reputation; pages and requests have one row a url. Ages of captures are
    counted up to `archived_at`, which is given, so that a replay gives the same."""

    curated: DataFrame | None = None  # url, timestamp
    pages: DataFrame | None = None  # url, status_code, html
    requests: DataFrame | None = None  # url, status_code, response_time, redirect_count, error_type, etag, last_modified
    captures: DataFrame | None = None  # url, ts, status
    archived_at: str | None = None
    model: PipelineModel | None = None
    lists: dict[str, DataFrame] | None = None  # hosts by the names of scoring.LISTS
    keywords: dict[str, tuple[str, ...] | DataFrame] = field(default_factory=dict)  # nsfw and spam
    database: dict[str, str] | None = None  # url, table, and further options of the connection


def read_feed(spark: SparkSession, path: str) -> DataFrame:
    """The tab-separated feed of (time, url), without header or quoting."""
    return spark.read.schema(FEED).option("sep", "\t").option("quote", "").option("escape", "").csv(path)


def watch_feed(spark: SparkSession, folder: str, files: int = 1, names: str = "*.tsv") -> DataFrame:
    """The files of a folder as a stream, oldest first, so many a trigger; source_file names each row's file."""
    stream = spark.readStream.schema(FEED).option("sep", "\t").option("quote", "").option("escape", "").option("maxFilesPerTrigger", files).option("pathGlobFilter", names).csv(folder)
    return stream.select("ts", "url", F.col("_metadata.file_name").alias("source_file"))


def _require(config: PipelineConfig, landed: Landed) -> None:
    """Refuses a batch whose settings ask for what is not there."""
    odd = [m for m in config.methods if m not in METHODS]
    if odd or not config.methods:
        raise ValueError(f"methods are some of {METHODS}, not {config.methods}")
    if config.use_features and "rules" not in config.methods:
        raise ValueError("use_features enriches the scores of the method rules")
    needed = {"curated": config.use_curated, "lists": config.use_lists, "model": "gbt" in config.methods, "database": config.write_db} | dict.fromkeys(("pages", "requests", "captures", "archived_at"), config.use_features)
    missing = [name for name, asked in needed.items() if asked and getattr(landed, name) is None]
    if missing:
        raise ValueError(f"the settings ask for landed {', '.join(missing)}")


def _provisional(rows: DataFrame, method: str, stored: DataFrame | None, config: PipelineConfig, landed: Landed) -> DataFrame:
    """Pass 1 of a method. The trained model's scores hold no part of a reputation."""
    lists = landed.lists if config.use_lists else None
    words = [landed.keywords.get(k, ()) if config.use_lists else () for k in ("nsfw", "spam")]
    if method == "rules":
        return scoring.score_rules(rows, stored, config.profile, lists, *words)
    found = scoring.with_reputation(scoring.featured(rows, config.profile, lists, *words), None).withColumn("reputation_part", F.lit(0.0))
    return ml.judged(found, landed.model)


def enhanced_sample(rows: DataFrame, landed: Landed, reputation: DataFrame, config: PipelineConfig) -> DataFrame:
    """One url a domain of the scored rows, with what was observed of it and its enhanced score."""
    picked = enhance.sample(rows, config.sample_seed, config.max_sample, config.sample_fraction).join(rows.select("url", "domain", "score", "confidence"), ["url", "domain"])
    own = lambda table: table.join(picked.select("url"), "url", "left_semi")
    page = own(landed.pages)
    outlinks = links.outlink_scores(page, links.classify(links.extract(page), reputation))
    history = observations.archive_metrics(own(landed.captures), F.lit(landed.archived_at).cast("timestamp"))
    return enhance.enhance(picked, pages.page_features(page), outlinks, observations.outcome(own(landed.requests)), history)


def _write_reports(result: DataFrame, path: str) -> None:
    """The report as one table, and each of its sections as text, which is read from the table."""
    sinks.write_parquet(reports.summary(result), f"{path}/table")
    table = result.sparkSession.read.parquet(f"{path}/table")
    shown = {"best_urls": reports.extreme_urls(result), "worst_urls": reports.extreme_urls(result), "frequent_domains": reports.frequent_domains(result), "frequent_curated_domains": reports.frequent_domains(result)}
    shown |= {"overall": reports.overall(result), "by_source": reports.by_source(result), "curated_benchmark": reports.curated_benchmark(result), "lift": reports.lift(result)}
    for name, section in shown.items():  # of which the columns' names alone are used
        sinks.write_report(reports.lines(table, name, section.columns).drop("rank"), f"{path}/{name}")


def run_batch(batch: DataFrame, batch_id: int, out: str, config: PipelineConfig = PipelineConfig(), landed: Landed = Landed(), processed_at: str | None = None) -> DataFrame:
    """Scores one batch of the feed by each method and writes it under out: scored/batch=N, summary/batch=N (those of gbt
    under out/gbt), comparison/batch=N if both methods ran and reports are asked for, reputation/batch=N (the domains that it changed), store/batch=N, and with
    train_model model/batch=N. The reputation is that which the batches before N left, so a replay writes the same; it and the
    store follow the first method, so that no url counts twice. write_db appends the batch's new store rows to the database.
    Between its steps a batch writes to out/work, which it clears. Rows and spam are counted while the result is written, without a job of their own, and put
    down in counts/batch=N. Store rows carry processed_at, the present time unless it is given. Urls that are null are one row,
    `invalid_url`, of the result. Gives that method's result."""
    _require(config, landed)
    spark, processed_at = batch.sparkSession, processed_at or datetime.now(UTC).strftime("%Y-%m-%d %H:%M:%S")
    with workspace(spark, f"{out}/work") as keep:
        results = _scored(batch, batch_id, out, config, landed, processed_at, keep)
    release(spark)  # what the steps left, before the results are written in further forms
    for method, result in results.items():
        own = _own(out, method)
        if config.write_tsv:
            sinks.write_tsv(result, f"{own}/tsv/batch={batch_id}")
        if config.write_summary:
            _write_reports(result, f"{own}/summary/batch={batch_id}")
    if config.write_summary and len(results) == len(METHODS):
        pairs = reports.paired(results["rules"], results["gbt"])
        sinks.write_report(reports.agreement(pairs), f"{out}/comparison/batch={batch_id}/agreement")
        sinks.write_report(reports.differences(pairs), f"{out}/comparison/batch={batch_id}/differences")
    sinks.insert_absent(sinks.store_rows(results[config.methods[0]], processed_at), f"{out}/store", batch_id, buckets=config.store_buckets)
    release(spark)
    if config.write_db:
        fresh = spark.read.parquet(f"{out}/store/batch={batch_id}")  # urls that no batch before had
        sinks.write_jdbc(fresh.drop("entry"), **landed.database)
    return results[config.methods[0]]


def _own(out: str, method: str) -> str:
    return out if method == "rules" else f"{out}/{method}"


def _scored(batch: DataFrame, batch_id: int, out: str, config: PipelineConfig, landed: Landed, processed_at: str, keep) -> dict[str, DataFrame]:
    """Results by method, written with their counts, the reputation and the trained model: they read nothing that keep writes."""
    spark = batch.sparkSession
    rows = scoring.normalise_feed(batch)
    if config.use_curated:
        rows = curated.union_feeds(rows, curated.clean_curated(landed.curated))
    else:
        rows = rows.groupBy("url", "data_source").agg(*[F.min(c).alias(c) for c in ("timestamp", "source_file") if c in rows.columns])
    rows = keep(rows)  # the source is read once, so what is observed of it is counted once
    stored = sinks.latest_reputation(spark, f"{out}/reputation", batch_id) if config.read_reputation else None
    counts, results = keep(scoring.domain_counts(scoring.split_urls(rows))), {}
    for method in config.methods:
        first = scoring.frequencies(_provisional(rows, method, stored, config, landed), scoring.sent(counts))
        if not (config.use_features or config.train_model):  # which look at features
            first = first.select(*[c for c in first.columns if c in (*scoring.SECOND_PASS, *scoring.RESULT)])
        first = keep(first)
        release(spark)
        stats = keep(scoring.domain_stats(first))
        final = scoring.replaced_reputation(scoring.rescore(first, scoring.sent(stats), config.profile))
        new = stats.selectExpr("domain", "mean_score reputation_score", "total_urls total_urls_seen", "malicious malicious_urls_count", "benign benign_urls_count", "content_diversity_score")
        old = stored if stored is not None else new.limit(0)
        if config.use_features and method == "rules":
            enhanced = keep(enhanced_sample(final, landed, old, config))
            final = enhance.merge_enhanced(final, enhanced)
            changing = enhance.volatility(enhanced).selectExpr("domain", "volatility content_volatility_score", "revisit_hours predicted_revisit_interval_hours")
            new = new.join(changing, "domain", "left")
        result = scoring.conform(final, config.profile, -2.0 if method == "rules" else -3.0, processed_at)
        own = _own(out, method)
        totals = [F.count("*").alias("urls"), F.count_if("is_spam").alias("spam"), F.count_if(F.col("url") == "invalid_url").alias("without_url")]
        if config.write_parquet:
            seen = Observation(f"{method}-{batch_id}")
            sinks.write_parquet(result.observe(seen, *totals), f"{own}/scored/batch={batch_id}")
            found = seen.get
            result = spark.read.parquet(f"{own}/scored/batch={batch_id}")  # what follows reads what is written
        else:
            result = cut_lineage(result)
            found = result.agg(*totals).first().asDict()
        results[method] = result
        sinks.write_counts(spark, found, f"{own}/counts", batch_id)
        if method == config.methods[0]:
            if config.write_reputation:
                sinks.write_reputation(domains.changed(old, new), f"{out}/reputation", batch_id, config.base_every)
            if config.train_model:
                ml.save(ml.train(first, ml.targets(first)), f"{out}/model/batch={batch_id}")
    return results


class Arrivals(StreamingQueryListener):
    """What the batches of a running query brought, as it is told while they run: rows, rows without a url, and files of each."""

    def __init__(self) -> None:
        self.batches: list[dict[str, int]] = []

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        seen = event.progress.observedMetrics.get("arrivals")
        if seen is not None and seen["arrived"]:
            self.batches.append({"batch": event.progress.batchId, **seen.asDict()})

    def onQueryTerminated(self, event) -> None:
        pass


def start(spark: SparkSession, folder: str, out: str, checkpoint: str, config: PipelineConfig = PipelineConfig(), landed: Landed = Landed(), files: int = 1, names: str = "*.tsv", every: str | None = None) -> StreamingQuery:
    """Runs over all files that are there, so many a batch, and ends; started again, it takes up the new ones. With `every` (such
    as "1 minute") it goes on and looks for new files at that pace until it is stopped. A listener such as Arrivals, added to
    spark.streams, is told what each batch brought."""
    stream = watch_feed(spark, folder, files, names)
    stream = stream.observe("arrivals", F.count("*").alias("arrived"), F.count_if(F.col("url").isNull()).alias("without_url"), F.approx_count_distinct("source_file").alias("files"))
    writer = stream.writeStream.foreachBatch(lambda df, n: run_batch(df, n, out, config, landed) and None).option("checkpointLocation", checkpoint)
    return (writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)).start()
