"""Registered streaming jobs; each is run over everything available and read back as a table.

The check is the SQL of the batch question.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark import vocabulary as V
from tidemark.functions.sentiment import lexicon_scorer
from tidemark.operators import routing as RO
from tidemark.plans import views
from tidemark.plans.catalog import query
from tidemark.plans.ingest_queries import TSF, UNIFIED, VERSIONS, _archive_files, _category_rows, ARCHIVED, archive_manifest_of
from tidemark.plans.post_queries import KEYS, mean4, r4
from tidemark.plans.text_queries import ENRICHED
from tidemark.plans.views import AS_OF, LABELS, LIFECYCLE, MESSAGES, POSTS, RAW, REQUESTS, ctes
from tidemark.registry import SOURCES
from tidemark.session import scratch_dir, shuffles_dropped
from tidemark.sources import sinks as K
from tidemark.streaming import jobs as J


def _ddl(df) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)


def _landed(spark, df, name):
    """Land a frame as files (column store) and stream them in two batches, each with a file for every core."""
    path = scratch_dir(spark, name)
    cores = spark.sparkContext.defaultParallelism
    with shuffles_dropped(spark):
        df.repartition(2 * cores).write.option("compression", K.CODEC).parquet(path)
    return path, J.file_stream(spark, path, _ddl(df), file_format="parquet", files_per_batch=cores)


def _social_frame(spark, d, platform="bluesky"):
    rows = views.text_posts(spark, d).where(F.col("platform") == platform)
    return rows.select(
        F.col("id").alias("_id"), "platform", "category", "url", "source_id", "text",
        F.date_format("created_at", "yyyy-MM-dd'T'HH:mm:ssXXX").alias("created_at"),
        *[F.col(c).cast("string").alias(c) for c in ("like_count", "reply_count", "repost_count", "quote_count")],
    )


@query("r01_incremental_files", UNIFIED + " select id from unified where platform = 'bluesky'")
def incremental_files(spark, d):
    """Two runs with one checkpoint: the second one reads only the files that arrived in between."""
    rows = _social_frame(spark, d)
    path, table, checkpoint = (scratch_dir(spark, n) for n in ("r01-files", "r01-table", "r01-checkpoint"))
    for part in (0, 1):
        rows.where(F.pmod(F.xxhash64("_id"), F.lit(2)) == part).write.mode("append").parquet(path)
        stream = J.file_stream(spark, path, _ddl(rows), file_format="parquet")
        J.ingest(stream, SOURCES[0], table, checkpoint, imported_at=views.as_of())
    return spark.read.parquet(table).select("id")


@query("r02_bounded_batches", UNIFIED + " select id from unified where platform = 'mastodon'")
def bounded_batches(spark, d):
    """At most half of the files per batch until nothing is left."""
    _, stream = _landed(spark, _social_frame(spark, d, "mastodon"), "r02-files")
    table = scratch_dir(spark, "r02-table")
    J.ingest(stream, SOURCES[1], table, scratch_dir(spark, "r02-checkpoint"), imported_at=views.as_of())
    return spark.read.parquet(table).select("id")


@query("r05_late_copies", VERSIONS + "select distinct id from (select id from first_batch union all select id from second_batch)")
def late_copies(spark, d):
    """Overlapping deliveries of the same rows: recent copies are dropped by state, stored ids are not written again."""
    rows = views.posts(spark, d).selectExpr("raw_id as id", "created_at", "harvested_at", "cast(substring(raw_id, 5) as bigint) as k")
    twice = rows.where("k % 3 <> 0").unionByName(rows.where("k % 2 = 0"))
    table = scratch_dir(spark, "r05-table")

    def body(batch, _):
        K.insert_if_absent(K.with_month(batch), table)

    J.run_available(J.first_copies(_landed(spark, twice, "r05-files")[1]), body, scratch_dir(spark, "r05-checkpoint"))
    return spark.read.parquet(table).select("id")


# -------------------------------------------------------------------- archives
def _landed_archives(spark, d):
    """Archives as a stream of (path, content) rows, and their manifest; every ninth checksum is wrong.

    The manifest is stored: every batch meets it, and none reads all archives again for their checksums.
    """
    files = _archive_files(spark, d)
    named = files.select(F.concat(F.lit("/landing/"), "archive_id", F.lit(".gkg.csv.zip")).alias("path"), "archive_id", "content")
    path, stream = _landed(spark, named, "stream-archives")
    stored, listed = spark.read.parquet(path), scratch_dir(spark, "stream-manifest")
    archive_manifest_of(stored).write.parquet(listed)
    return stream, stored.select("archive_id", "content"), spark.read.parquet(listed)


def _ingested(spark, d):
    stream, _, manifest = _landed_archives(spark, d)
    table, rejects, checkpoint = (scratch_dir(spark, n) for n in ("r03-table", "r03-rejects", "r03-checkpoint"))
    J.ingest_archives(stream, manifest, table, rejects, checkpoint, collected_at=views.as_of())
    return spark.read.parquet(table), spark.read.parquet(rejects)


@query("s12_archive_stream", ARCHIVED + _category_rows() + " select concat(id, ':', cat) as _id, archive_id as gkg_file_id from rows_of")
def archive_stream(spark, d):
    return _ingested(spark, d)[0].select("_id", "gkg_file_id")


@query("r03_bad_archives_passed_over", ARCHIVED + " select distinct archive_id from arch where cast(archive_id as bigint) % 9 = 0")
def bad_archives(spark, d):
    return _ingested(spark, d)[1].select("archive_id")


@query(
    "r04_resumable_backfill",
    ARCHIVED + _category_rows() + """, counts as (select archive_id, count(*) as n from rows_of group by 1)
select a.archive_id, coalesce(n, 0) as documents from (select distinct archive_id from ok_arch) a left join counts using (archive_id)""",
)
def resumable_backfill(spark, d):
    """Runs with a budget of ten archives, one unbounded run, and one that finds nothing to do."""
    _, files, manifest = _landed_archives(spark, d)
    table, completed = scratch_dir(spark, "r04-table"), scratch_dir(spark, "r04-completed")
    for budget in (10, None, None):
        J.run_backfill(manifest, files, table, completed, max_archives=budget, collected_at=views.as_of())
    return spark.read.parquet(completed).select("archive_id", "documents")


# -------------------------------------------------------------------- enrichment
def _streamed_posts(spark, d, name):
    _, stream = _landed(spark, _social_frame(spark, d), f"{name}-files")
    raw, posts = scratch_dir(spark, f"{name}-raw"), scratch_dir(spark, f"{name}-posts")
    J.enrich_stream(stream, SOURCES[0], raw, posts, scratch_dir(spark, f"{name}-checkpoint"),
                    lexicon_scorer(V.STARTER_LEXICON), processed_at=views.as_of(), imported_at=views.as_of())
    return spark.read.parquet(raw), spark.read.parquet(posts)


@query(
    "r06_status_machine",
    ENRICHED + " select case when score < -2 then 'discarded' else 'processed' end as analysis_status, true as stamped, count(*) as n from c2 where platform = 'bluesky' group by 1",
)
def status_machine(spark, d):
    raw, _ = _streamed_posts(spark, d, "r06")
    return raw.groupBy("analysis_status", F.col("analysis_processed_at").isNotNull().alias("stamped")).agg(F.count(F.lit(1)).alias("n"))


@query(
    "r13_streaming_enrichment",
    ENRICHED + """ select concat('unified-', sha1(concat('bluesky_raw_stream|', id))) as raw_id, coalesce(t, category, 'cost_of_living') as topic, array_to_string(kw, '|') as keywords,
  score as relevance_score, case when score < -2 then 'discarded' else 'processed' end as processing_status from c2 where platform = 'bluesky'""",
)
def streaming_enrichment(spark, d):
    _, posts = _streamed_posts(spark, d, "r13")
    return posts.select("raw_id", "topic", F.array_join("matched_keywords", "|").alias("keywords"), "relevance_score", "processing_status")


def _all_streamed_posts(spark, d, name):
    """All sources, each a stream with its own checkpoint, into one pair of tables."""
    raw, posts = scratch_dir(spark, f"{name}-raw"), scratch_dir(spark, f"{name}-posts")
    for source in SOURCES:
        _, stream = _landed(spark, _social_frame(spark, d, source.name), f"{name}-{source.name}-files")
        J.enrich_stream(stream, source, raw, posts, scratch_dir(spark, f"{name}-{source.name}-checkpoint"),
                        lexicon_scorer(V.STARTER_LEXICON), processed_at=views.as_of(), imported_at=views.as_of())
    return spark.read.parquet(raw), spark.read.parquet(posts)


@query(
    "r06_status_machine_all_sources",
    ENRICHED + " select platform, case when score < -2 then 'discarded' else 'processed' end as analysis_status, true as stamped, count(*) as n from c2 group by 1, 2",
)
def status_machine_all_sources(spark, d):
    raw, _ = _all_streamed_posts(spark, d, "r06-all")
    return raw.groupBy("platform", "analysis_status", F.col("analysis_processed_at").isNotNull().alias("stamped")).agg(F.count(F.lit(1)).alias("n"))


LABEL_OF = "case platform " + " ".join(f"when '{s.name}' then '{s.label}'" for s in SOURCES) + " end"


@query(
    "r13_streaming_enrichment_all_sources",
    ENRICHED + f""" select concat('unified-', sha1(concat({LABEL_OF}, '|', id))) as raw_id, platform, coalesce(t, category, 'cost_of_living') as topic, array_to_string(kw, '|') as keywords,
  score as relevance_score, case when score < -2 then 'discarded' else 'processed' end as processing_status from c2""",
)
def streaming_enrichment_all_sources(spark, d):
    _, posts = _all_streamed_posts(spark, d, "r13-all")
    return posts.select("raw_id", "platform", "topic", F.array_join("matched_keywords", "|").alias("keywords"), "relevance_score", "processing_status")


STALE = f"(coalesce(analysis_status, '') = 'processing' and analysis_started_at < timestamp '{AS_OF}' - interval 120 minutes)"


@query(
    "r07_reclaim_stale",
    ctes(POSTS, RAW) + f"""select case when {STALE} then 'pending' else analysis_status end as analysis_status,
  case when {STALE} then null else analysis_started_at end is null as not_started, count(*) as n from raw_posts group by 1, 2""",
)
def reclaim_stale(spark, d):
    rows = J.reclaim_stale(views.raw_posts(spark, d), views.as_of())
    return rows.groupBy("analysis_status", F.col("analysis_started_at").isNull().alias("not_started")).agg(F.count(F.lit(1)).alias("n"))


@query(
    "r14_topic_trend",
    ctes(POSTS, LABELS) + f"""select strftime(created_at, '%Y-%m') as period, topic as cost_category, category_label, {KEYS}, {mean4()} as avg_sentiment,
  count(*) filter (where sentiment_label = 'positive') as positive_count, count(*) filter (where sentiment_label = 'neutral') as neutral_count,
  count(*) filter (where sentiment_label = 'negative') as negative_count, {r4("count(*) filter (where sentiment_label = 'positive') / count(*)")} as positive_ratio,
  {r4("count(*) filter (where sentiment_label = 'neutral') / count(*)")} as neutral_ratio, {r4("count(*) filter (where sentiment_label = 'negative') / count(*)")} as negative_ratio
  from posts join labels_of on topic = cost_category group by 1, 2, 3""",
)
def topic_trend(spark, d):
    _, stream = _landed(spark, views.posts(spark, d), "r14-files")
    table = scratch_dir(spark, "r14-table")
    J.topic_trend(stream, table, scratch_dir(spark, "r14-sightings"), scratch_dir(spark, "r14-checkpoint"))
    return J.trend_rows(spark, table)


# ------------------------------------------------------------- windows, messages
@query(
    "r10_window_counts",
    ctes(REQUESTS) + """select client, route, strftime(time_bucket(interval 1 hour, ts), '%Y-%m-%d %H:%M:%S') as window_start, count(*) as requests, count(*) > 1 as over_limit
  from requests group by 1, 2, 3""",
)
def window_counts(spark, d):
    """Two batches of files, each with requests of all times."""
    _, requests = _landed(spark, views.requests(spark, d).select("client", "route", "ts"), "r10-files")
    table = scratch_dir(spark, "r10-table")
    J.count_windows(requests, table, scratch_dir(spark, "r10-checkpoint"), seconds=3600, limit=1)
    return spark.read.parquet(table).select("client", "route", F.date_format("window_start", TSF).alias("window_start"), "requests", "over_limit")


@query(
    "r10_window_counts_batch",
    ctes(REQUESTS) + """select client, route, strftime(time_bucket(interval 60 seconds, ts), '%Y-%m-%d %H:%M:%S') as window_start, count(*) as requests, count(*) > 600 as over_limit
  from requests group by 1, 2, 3""",
)
def window_counts_batch(spark, d):
    return RO.window_counts(views.requests(spark, d)).withColumn("window_start", F.date_format("window_start", TSF))


ROUTES = ctes(MESSAGES) + """, routed as (select *, coalesce(kind, 'poison_message') as k,
  case when coalesce(kind, '') <> 'nlp_batch' or (failed and attempts + 1 >= 3) then 'dead_letter' when failed then 'retry' else 'done' end as route,
  case when kind = 'nlp_batch' and failed then attempts + 1 else attempts end as next_attempts,
  case when coalesce(kind, '') <> 'nlp_batch' then 'poison_message' when failed and attempts + 1 >= 3 then 'max_attempts_exceeded' end as reason from messages)"""


@query("r08_retry_and_dead_letters", ROUTES + " select event_id, k as kind, route, next_attempts, reason from routed")
def retry_and_dead_letters(spark, d):
    _, stream = _landed(spark, views.messages(spark, d), "r08-files")
    table = scratch_dir(spark, "r08-table")
    J.route_stream(stream, table, scratch_dir(spark, "r08-checkpoint"), F.col("failed"))
    return spark.read.parquet(table).select("event_id", "kind", F.col("route").cast("string").alias("route"), "next_attempts", "reason")


@query("r08_running_attempts", ctes(MESSAGES) + "select cast(event_id as varchar) as message_id, attempts from messages where kind is not null")
def running_attempts(spark, d):
    _, stream = _landed(spark, views.messages(spark, d), "r08b-files")
    table = scratch_dir(spark, "r08b-table")
    J.running_attempts(stream, table, scratch_dir(spark, "r08b-checkpoint"))
    return spark.read.parquet(table).select("message_id", "attempts")


@query("r09_poison_messages", ctes(MESSAGES) + "select event_id, payload as raw_payload from messages where kind is null")
def poison_messages(spark, d):
    return RO.decode_messages(views.messages(spark, d)).where(F.col("kind") == "poison_message").select("event_id", "raw_payload")


RUNS = ctes(LIFECYCLE) + """, runs as (select run_id, job_name, min(emitted_at) filter (where status = 'started') as s,
  max(emitted_at) filter (where status <> 'started') as e, max(status) filter (where status <> 'started') as st, max(duration_ms) as duration_ms from lifecycle group by 1, 2)
select run_id, job_name, strftime(s, '%Y-%m-%d %H:%M:%S') as started_at, strftime(e, '%Y-%m-%d %H:%M:%S') as ended_at, duration_ms,
  coalesce(st, case when s < timestamp '2024-01-31 12:00:00' - interval 120 minutes then 'lost' else 'running' end) as status from runs"""


def _run_times(df):
    return df.withColumn("started_at", F.date_format("started_at", TSF)).withColumn("ended_at", F.date_format("ended_at", TSF))


@query("r11_job_runs", RUNS)
def job_runs(spark, d):
    as_of = F.lit("2024-01-31 12:00:00").cast("timestamp")
    return _run_times(RO.job_runs(views.lifecycle_events(spark, d), as_of))


@query("r11_job_runs_stream", RUNS)
def job_runs_stream(spark, d):
    """Starts and ends arrive in different batches."""
    _, stream = _landed(spark, views.lifecycle_events(spark, d), "r11-files")
    table = scratch_dir(spark, "r11-table")
    J.pair_runs(stream, table, scratch_dir(spark, "r11-checkpoint"))
    as_of = F.lit("2024-01-31 12:00:00").cast("timestamp")
    return _run_times(RO.finished_runs(spark.read.parquet(table), as_of))
