"""State of processing: counts per status and source, freshness, errors, re-queueing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import strings as S
from tidemark.functions import times
from tidemark.operators.filters import filter_posts, is_error, is_pending, is_stale
from tidemark.operators.metrics import platform_name

STALE_MINUTES = 120


def current_status() -> Column:
    """A row without a status is waiting."""
    return F.coalesce("analysis_status", F.lit("pending"))


def source_name() -> Column:
    return S.first_filled(F.col("source_index"), F.col("platform"), F.lit("unknown"))


def _counts(as_of: Column, stale_minutes: int) -> dict[str, Column]:
    status = current_status()
    return {
        "raw_documents": F.count(F.lit(1)),
        "unprocessed_documents": F.count_if(status == "pending"),
        "processing_documents": F.count_if(status == "processing"),
        "stale_processing_documents": F.count_if(is_stale(as_of, stale_minutes)),
        "discarded_documents": F.count_if(status == "discarded"),
        "failed_documents": F.count_if(status == "error"),
    }


def processing_status(
    raw: DataFrame,
    posts: DataFrame,
    indicators: DataFrame,
    *,
    as_of: Column | None = None,
    stale_minutes: int = STALE_MINUTES,
) -> DataFrame:
    """Long form (metric, count, time, text): one scan per table, each reduced to one row first."""
    as_of = as_of if as_of is not None else F.current_timestamp()
    none_n, none_t, none_s = (F.lit(None).cast(t) for t in ("bigint", "timestamp", "string"))

    def unpivot(one: DataFrame, counts=(), times_=(), texts=()) -> DataFrame:
        entries = [F.struct(F.lit(c).alias("metric"), F.col(c).alias("count"), none_t.alias("time"), none_s.alias("text")) for c in counts]
        entries += [F.struct(F.lit(c).alias("metric"), none_n.alias("count"), F.col(c).alias("time"), none_s.alias("text")) for c in times_]
        entries += [F.struct(F.lit(c).alias("metric"), none_n.alias("count"), none_t.alias("time"), F.col(c).alias("text")) for c in texts]
        return one.select(F.inline(F.array(*entries)))

    counts = _counts(as_of, stale_minutes)
    raw_row = raw.agg(*[c.alias(n) for n, c in counts.items()], F.max("harvested_at").alias("last_harvest_at"))
    post_row = filter_posts(posts).agg(
        F.count(F.lit(1)).alias("processed_documents"),
        F.max("processed_at").alias("last_processed_at"),
        F.max("harvested_at").alias("last_processed_harvest_at"),
    )
    official = indicators.agg(
        F.count(F.lit(1)).alias("official_indicators"), F.max("period").alias("latest_official_period")
    )
    return (
        unpivot(raw_row, counts, ["last_harvest_at"])
        .unionByName(unpivot(post_row, ["processed_documents"], ["last_processed_at", "last_processed_harvest_at"]))
        .unionByName(unpivot(official, ["official_indicators"], (), ["latest_official_period"]))
        .withColumn("lag_minutes", times.minutes_since(F.col("time"), as_of))
    )


def source_status(raw: DataFrame, *, as_of: Column | None = None, stale_minutes: int = STALE_MINUTES) -> DataFrame:
    """Counts and freshness per source."""
    as_of = as_of if as_of is not None else F.current_timestamp()
    counts = _counts(as_of, stale_minutes)
    counts["document_count"] = counts.pop("raw_documents")
    return (
        raw.groupBy(source_name().alias("source_index"))
        .agg(*[c.alias(n) for n, c in counts.items()], F.max("harvested_at").alias("last_harvest_at"))
        .orderBy("source_index")
    )


def platform_freshness(posts: DataFrame) -> DataFrame:
    return (
        filter_posts(posts).groupBy(platform_name())
        .agg(
            F.max("created_at").alias("last_created_at"),
            F.max("harvested_at").alias("last_harvest_at"),
            F.max("processed_at").alias("last_processed_at"),
        )
        .orderBy("platform")
    )


def status_histogram(raw: DataFrame) -> DataFrame:
    return raw.groupBy(current_status().alias("status")).agg(F.count(F.lit(1)).alias("document_count")).orderBy("status")


def error_logs(raw: DataFrame, size: int = 50, *, function_name: str = "enrichment") -> DataFrame:
    """Newest `size` error rows in log form. A top-k: only that many rows are sorted out."""
    if size < 1:
        raise ValueError("a report needs a positive size")
    column = lambda n, t="string": F.col(n) if n in raw.columns else F.lit(None).cast(t)
    stamp = F.coalesce(column("analysis_processed_at", "timestamp"), column("harvested_at", "timestamp"))
    return (
        raw.where(is_error())
        .select(
            stamp.alias("timestamp"),
            F.lit(function_name).alias("function_name"),
            F.lit("processing").alias("stage"),
            F.col("analysis_status").alias("status"),
            F.lit("processing_error").alias("error_type"),
            F.col("id").alias("raw_id"),
            *[column(n).alias(n) for n in ("platform", "source_index", "source_es_id", "url")],
        )
        .orderBy(F.col("timestamp").desc_nulls_last(), "raw_id")
        .limit(size)
    )


def error_total(raw: DataFrame) -> DataFrame:
    return raw.agg(F.count_if(is_error()).alias("errors"))


def pending_total(raw: DataFrame, *, as_of: Column | None = None, stale_minutes: int = STALE_MINUTES) -> DataFrame:
    as_of = as_of if as_of is not None else F.current_timestamp()
    return raw.agg(F.count_if(is_pending(as_of, stale_minutes)).alias("pending"))


def requeue_errors(raw: DataFrame) -> DataFrame:
    """Rows in error go back to waiting; their error and start time are cleared."""
    failed = F.coalesce(F.col("analysis_status") == "error", F.lit(False))
    changes = {"analysis_status": F.when(failed, "pending").otherwise(F.col("analysis_status"))}
    for name in ("analysis_started_at", "analysis_error"):
        if name in raw.columns:
            changes[name] = F.when(~failed, F.col(name))
    return raw.withColumns(changes)


def harvest_summary(rows: DataFrame, matched: Column, interval: Column, *, first_run: bool) -> DataFrame:
    """Seen and matched rows per harvest interval."""
    return rows.groupBy(interval.alias("interval")).agg(
        F.count(F.lit(1)).alias("seen"), F.count_if(matched).alias("matched")
    ).withColumn("first_run", F.lit(first_run))


