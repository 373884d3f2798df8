"""Streaming jobs. File sources, checkpoints and idempotent keyed writes replace hand-kept state.

`foreachBatch` bodies use the same operators as batch jobs, so a stream gives the batch result. A batch
that is replayed after a failure writes the same rows again, which the keyed sinks ignore.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.functions import numbers as N
from tidemark.functions import strings as S
from tidemark.functions import times
from tidemark.functions.sentiment import Scorer
from tidemark.operators.enrich import enrich
from tidemark.operators.filters import PostFilter, filter_posts
from tidemark.operators.metrics import LABELS, category, document_key, with_label
from tidemark.operators.routing import MAX_ATTEMPTS, decode_messages, merge_runs, route_messages, run_parts
from tidemark.registry import SourceSpec
from tidemark.session import shuffles_dropped
from tidemark.sources import archives as AR
from tidemark.sources import sinks as K
from tidemark.sources.streams import unify


def file_stream(spark: SparkSession, path: str, schema: str, *, file_format: str = "json",
                files_per_batch: int | None = None, glob: str | None = None) -> DataFrame:
    """New files under a folder. The checkpoint of the query remembers which were read: the first run
    reads everything there is, later runs what has arrived since."""
    reader = spark.readStream.format(file_format).schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(path)


def archive_stream(spark: SparkSession, path: str, *, files_per_batch: int = 2) -> DataFrame:
    """Landed archive files, a few per batch."""
    schema = "path string, modificationTime timestamp, length bigint, content binary"
    return file_stream(spark, path, schema, file_format="binaryFile", files_per_batch=files_per_batch, glob="*.zip")


def run_available(df: DataFrame, body: Callable[[DataFrame, int], None], checkpoint: str, *, mode: str = "append") -> StreamingQuery:
    """Process everything available in batches, then stop; run again for what arrives later."""
    query = (
        df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).foreachBatch(body).start()
    )
    query.awaitTermination()
    return query


def first_copies(stream: DataFrame, key: str = "id", *, hours: int = 2) -> DataFrame:
    """The stream without rows whose key arrived in the last `hours` already.

    The watermark runs on the time of arrival, so that no row is ever late and the state holds the keys of that span
    only. Older copies pass and are met by the keyed sink.
    """
    arrived = stream.withColumn("_arrived", F.current_timestamp()).withWatermark("_arrived", f"{hours} hours")
    return arrived.dropDuplicatesWithinWatermark([key]).drop("_arrived")


# -------------------------------------------------------------------- ingest
def ingest(stream: DataFrame, source: SourceSpec, table: str, checkpoint: str, **options) -> StreamingQuery:
    """Raw stream to the unified table. Overlapping deliveries and late copies are harmless: the id is
    derived from the row, and an id that is stored is not written again."""

    def body(batch: DataFrame, _: int) -> None:
        K.insert_if_absent(K.with_month(unify(batch, source, **options)), table)

    return run_available(stream, body, checkpoint)


def enrich_stream(stream: DataFrame, source: SourceSpec, raw_table: str, post_table: str, checkpoint: str,
                  scorer: Scorer, *, processed_at: Column | None = None, **options) -> StreamingQuery:
    """Raw stream to processed posts in one step: insert raw rows, label them, write status back.

    One query owns its input, so no row needs to be claimed. A batch is cached once, with its raw columns and its results side
    by side, so that no text is moved to meet its status; shuffle files go with the write that made them.
    """

    def body(batch: DataFrame, _: int) -> None:
        raw = unify(batch, source, **options)
        with shuffles_dropped(raw.sparkSession):
            rows = enrich(raw, scorer, processed_at=processed_at, keep=[c for c in raw.columns if c != "text"]).persist()
            try:
                results = rows.select(F.col("raw_id").alias("id"), F.col("processing_status").alias("status"), "processed_at")
                own = rows.select(*[F.col("raw_text" if c == "text" else f"_raw.{c}").alias(c) for c in raw.columns],
                                  F.col("processing_status").alias("_status"), F.col("processed_at").alias("_processed_at"))
                stamped = K.with_results(own, results, own=("_status", "_processed_at"))
                K.insert_if_absent(K.with_month(stamped), raw_table, cached=True)
                K.upsert(K.with_month(rows.drop("_raw")), post_table, key="raw_id", cached=True)
            finally:
                rows.unpersist()

    return run_available(stream, body, checkpoint)


def ingest_archives(stream: DataFrame, manifest: DataFrame, table: str, rejects: str, checkpoint: str, *,
                    collected_at: Column | None = None) -> StreamingQuery:
    """Archive files to raw documents. A file with a wrong checksum is recorded and passed over, so one
    bad archive does not stop the stream."""

    def body(batch: DataFrame, _: int) -> None:
        files = batch.select(
            F.regexp_extract("path", r"/(\d{14})\.gkg\.csv\.zip$", 1).alias("archive_id"), "content"
        )
        documents = AR.archive_documents(AR.archive_lines(files), manifest, collected_at=collected_at)
        K.insert_if_absent(K.with_month(documents.withColumn("_t", times.any_time(F.col("created_at"))), "_t").drop("_t"), table, key="_id")
        bad = AR.rejected(AR.verify_archives(manifest, files))
        K.insert_if_absent(bad, rejects, key="archive_id", partition=None)

    return run_available(stream, body, checkpoint)


# ------------------------------------------------------------------ backfill
def run_backfill(manifest: DataFrame, files: DataFrame, table: str, completed: str, *,
                 max_archives: int | None = None, resume: bool = True, collected_at: Column | None = None) -> DataFrame:
    """One resumable run over the archives that are not completed, oldest first.

    A failing archive is not marked, so the next run takes it again. `max_archives` is the budget of one
    run; what is left is done by later runs. Returns (archive_id, documents) of the run.
    """
    spark = manifest.sparkSession
    pending = manifest
    if resume and K.table_exists(spark, completed):
        pending = AR.remaining_archives(manifest, spark.read.parquet(completed))
    if max_archives:
        pending = pending.orderBy("archive_time", "archive_id").limit(max_archives)
    pending = pending.persist()
    # other files are skipped before they are unpacked, however many are pending
    files = files.join(pending.select("archive_id"), "archive_id", "left_semi")
    good = AR.accepted(AR.verify_archives(pending, files))
    documents = AR.archive_documents(AR.archive_lines(files), pending, collected_at=collected_at).persist()
    try:
        stamped = documents.withColumn("_t", times.any_time(F.col("created_at")))
        K.insert_if_absent(K.with_month(stamped, "_t").drop("_t"), table, key="_id")
        counts = documents.groupBy(F.col("gkg_file_id").alias("archive_id")).agg(F.count(F.lit(1)).alias("documents"))
        done = good.select("archive_id").join(counts, "archive_id", "left").select(
            "archive_id", F.coalesce("documents", F.lit(0)).cast("bigint").alias("documents")
        ).persist()
        K.insert_if_absent(done, completed, key="archive_id", partition=None)
        return done
    finally:
        documents.unpersist()
        pending.unpersist()


def reclaim_stale(raw: DataFrame, as_of: Column, *, minutes: int = 120) -> DataFrame:
    """Rows whose processing never finished go back to waiting."""
    from tidemark.operators.filters import is_stale

    stale = is_stale(as_of, minutes)
    return raw.withColumns(
        {
            "analysis_status": F.when(stale, "pending").otherwise(F.col("analysis_status")),
            "analysis_started_at": F.when(~stale, F.col("analysis_started_at")),
        }
    )


# ------------------------------------------------------------------- windows
def add_window_counts(requests: DataFrame, batch_id: int, table: str, *, seconds: int = 60, limit: int = 600) -> None:
    """Add one batch's requests per (client, route, window) to the stored counts.

    A stored row names the batch that it last took requests from and the count `before` it, so that the batch may be
    written again, also after a failure that left only a part of the table rewritten.
    """
    counts = (
        requests.groupBy(F.window("ts", f"{seconds} seconds"), "client", "route")
        .agg(F.count(F.lit(1)).alias("requests"))
        .select("client", "route", F.col("window.start").alias("window_start"), "requests")
    )

    def part(c: str) -> Column:  # nulls and separators have ids of their own
        return F.coalesce(F.replace(F.replace(c, F.lit("\\"), F.lit("\\\\")), F.lit("|"), F.lit("\\p")), F.lit("\\n"))

    rows = counts.withColumn("id", S.digest_id("window-", part("client"), part("route"), F.col("window_start")))
    rows = rows.withColumns({"before": F.lit(0).cast("bigint"), "last_batch": F.lit(batch_id).cast("bigint")})

    def added(df: DataFrame) -> DataFrame:
        same = F.col("last_batch").eqNullSafe(F.lit(batch_id))
        before = F.coalesce(F.max(F.when(~same, F.col("requests"))), F.max(F.when(same, F.col("before"))))
        own = F.max(F.when(same, F.col("requests") - F.col("before")))
        kept = [c for c in ("client", "route", "window_start", K.MONTH) if c in df.columns]
        merged = df.groupBy("id").agg(*[F.first(c).alias(c) for c in kept], before.alias("before"), own.alias("_own"))
        return merged.withColumn("requests", F.col("before") + F.col("_own")).drop("_own").withColumns(
            {"last_batch": F.lit(batch_id).cast("bigint"), "over_limit": F.col("requests") > limit}
        )

    K.upsert(K.with_month(rows, "window_start"), table, resolve=added)


def count_windows(requests: DataFrame, table: str, checkpoint: str, *, seconds: int = 60, limit: int = 600) -> StreamingQuery:
    """Requests per (client, route, window), however late they come: each batch is counted on its own and added to
    the table, which is the only state. Counting is partial per task, so a busy client costs one row each."""

    def body(batch: DataFrame, batch_id: int) -> None:
        add_window_counts(batch, batch_id, table, seconds=seconds, limit=limit)

    return run_available(requests, body, checkpoint)


def add_measures(deltas: DataFrame, batch_id: int, table: str, *, keys: Sequence[str], measures: Sequence[str], partition: str) -> None:
    """Add one batch's sums per key to a stored table; measures may be negative, keys null.

    As in `add_window_counts` a stored row names the batch that it last took, and what each measure was `before` it.
    """
    rows = deltas.withColumns({
        "id": F.md5(F.to_json(F.struct(*keys), {"ignoreNullFields": "false"}).cast("binary")),
        "last_batch": F.lit(batch_id).cast("bigint"), **{f"before_{m}": F.lit(None).cast("bigint") for m in measures},
    })
    same = F.col("last_batch").eqNullSafe(F.lit(batch_id))

    def added(df: DataFrame) -> DataFrame:
        sums = []
        for m in measures:
            # null where nothing is stored yet, as a sum before may be negative
            before = F.coalesce(F.max(F.when(~same, F.col(m))), F.max(F.when(same, F.col(f"before_{m}"))))
            own = F.coalesce(F.max(F.when(same, F.col(m) - F.coalesce(f"before_{m}", F.lit(0)))), F.lit(0))
            sums += [before.alias(f"before_{m}"), (F.coalesce(before, F.lit(0)) + own).cast("bigint").alias(m)]
        merged = df.groupBy("id").agg(*[F.first(k, ignorenulls=True).alias(k) for k in keys], *sums)
        return merged.withColumn("last_batch", F.lit(batch_id).cast("bigint"))

    K.upsert(rows, table, partition=partition, resolve=added)


TREND_KEYS = ("period", "cost_category")
TREND_SUMS = ("document_count", "unique_document_count", "_units", "_scored", *[f"{label}_count" for label in LABELS])


def topic_trend(posts: DataFrame, table: str, sightings: str, checkpoint: str, *, period: str = "month",
                f: PostFilter = PostFilter()) -> StreamingQuery:
    """Running period x category counts, distinct documents and sentiment, in whatever order files come.

    `sightings` holds each (period, category, document key) once, with the batch that first saw it; what a batch adds to
    the distinct count is what it sighted first, so a batch that is run again adds the same. Sums are added to `table`,
    which has one row per period and category; `trend_rows` gives the chart columns.
    """
    def body(batch: DataFrame, batch_id: int) -> None:
        units = N.score_units(F.col("sentiment_score"))
        rows = filter_posts(batch, f).where(F.col("created_at").isNotNull())
        rows = rows.select("*", times.period_of(F.col("created_at"), period).alias("period"), category(), document_key(rows).alias("_document")).persist()
        try:
            seen = rows.where(F.col("_document").isNotNull()).select(*TREND_KEYS, "_document").distinct()
            seen = seen.select(*TREND_KEYS, F.md5(F.to_json(F.struct(*TREND_KEYS, "_document")).cast("binary")).alias("id"),
                               F.lit(batch_id).cast("bigint").alias("first_batch"))
            K.insert_if_absent(seen, sightings, partition="period", key_has_partition=True)
            periods = [r[0] for r in rows.select("period").distinct().collect()]
            fresh = batch.sparkSession.read.parquet(sightings).where(F.col("period").isin(periods) & (F.col("first_batch") == batch_id))
            fresh = fresh.groupBy(F.col("period").cast("string").alias("period"), "cost_category").agg(F.count(F.lit(1)).alias("unique_document_count"))
            counts = rows.groupBy(*TREND_KEYS).agg(
                F.count(F.lit(1)).alias("document_count"), F.coalesce(F.sum(units), F.lit(0)).cast("bigint").alias("_units"), F.count(units).alias("_scored"),
                *[F.count_if(F.col("sentiment_label") == label).alias(f"{label}_count") for label in LABELS],
            )
            deltas = counts.join(fresh, list(TREND_KEYS), "left").fillna(0, ["unique_document_count"])
            add_measures(deltas.select(*TREND_KEYS, *TREND_SUMS), batch_id, table, keys=TREND_KEYS, measures=TREND_SUMS, partition="period")
        finally:
            rows.unpersist()

    return run_available(posts, body, checkpoint)


def trend_rows(spark: SparkSession, table: str) -> DataFrame:
    """The stored trend with distinct counts, ratios and means, as the batch form gives them."""
    rows = spark.read.parquet(table).withColumn("period", F.col("period").cast("string"))
    unique = F.when(F.col("unique_document_count") == 0, F.col("document_count")).otherwise(F.col("unique_document_count"))
    rows = rows.withColumn("unique_document_count", unique).withColumns({
        "duplicate_ratio": N.duplicate_ratio(F.col("document_count"), F.col("unique_document_count")),
        "avg_sentiment": N.mean_score(F.col("_units"), F.col("_scored")),
        **{f"{label}_ratio": N.ratio(F.col(f"{label}_count"), F.col("document_count")) for label in LABELS},
    })
    return with_label(rows.select(
        *TREND_KEYS, "document_count", "unique_document_count", "duplicate_ratio", "avg_sentiment",
        *[f"{label}_{kind}" for kind in ("count", "ratio") for label in LABELS],
    ))


# ------------------------------------------------------------ events, messages
def pair_runs(events: DataFrame, table: str, checkpoint: str) -> StreamingQuery:
    """Start and end events to one row per run. Partial states (earliest start, latest end) are stored and
    merged: merging is order-free and repeatable, and many events of one run shrink to one row per task."""

    def month(rows: DataFrame) -> DataFrame:
        return K.with_month(rows.withColumn("_at", F.coalesce("started_at", "_end.emitted_at")), "_at").drop("_at")

    def body(batch: DataFrame, _: int) -> None:
        K.upsert(run_parts(batch), table, key="run_id", resolve=lambda rows: month(merge_runs(rows)))

    return run_available(events, body, checkpoint)


def route_stream(payloads: DataFrame, table: str, checkpoint: str, failed: Column, *, key: str = "event_id",
                 max_attempts: int = MAX_ATTEMPTS) -> StreamingQuery:
    """Decode, validate and route messages; the table has one partition per route (done, retry, dead letter)."""

    def body(batch: DataFrame, _: int) -> None:
        routed = route_messages(decode_messages(batch), failed, max_attempts=max_attempts)
        K.insert_if_absent(routed, table, key=key, partition="route")

    return run_available(payloads, body, checkpoint)


def running_attempts(messages: DataFrame, table: str, checkpoint: str) -> StreamingQuery:
    """Highest attempt number seen per message."""

    def highest(rows: DataFrame) -> DataFrame:
        return rows.groupBy("message_id").agg(F.max("attempts").alias("attempts"), F.max("bucket").alias("bucket"))

    def body(batch: DataFrame, _: int) -> None:
        decoded = decode_messages(batch).where(F.col("message_id").isNotNull())
        rows = decoded.select("message_id", "attempts", F.pmod(F.xxhash64("message_id"), F.lit(16)).cast("string").alias("bucket"))
        K.upsert(rows, table, key="message_id", partition="bucket", resolve=highest)

    return run_available(messages, body, checkpoint)


