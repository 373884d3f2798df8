"""Raw stream rows to the unified raw table."""

from __future__ import annotations

import functools
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import numbers as N
from tidemark.functions import strings as S
from tidemark.functions import times
from tidemark.operators.filters import keep_social
from tidemark.registry import SOURCES, SourceSpec, canonical_platform, social_platforms

COUNTERS = ("like_count", "reply_count", "repost_count", "quote_count")


def union_sources(frames: Iterable[DataFrame]) -> DataFrame:
    """UNION ALL by name; columns a source lacks are null."""
    return functools.reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def _column(df: DataFrame, name: str) -> Column:
    return F.col(name) if name in df.columns else F.lit(None).cast("string")


def _harvested_query(df: DataFrame) -> Column:
    return S.join_filled(" | ", *[S.trimmed(_column(df, c)) for c in ("category", "api_query", "search_term")])


def unify(
    df: DataFrame,
    source: SourceSpec,
    *,
    source_index: str | None = None,
    imported_at: Column | None = None,
    strict: bool = False,
    max_text_length: int | None = None,
) -> DataFrame:
    """One raw stream to `raw_posts` rows, ready for processing.

    Blank-able fields fall back along fixed chains, engagement counters exist for social rows only, and
    rows without any id are left out. Texts are kept whole unless a length is given.
    """
    imported_at = imported_at if imported_at is not None else F.current_timestamp()
    index = source_index or source.label
    text = lambda name: S.trimmed(_column(df, name).cast("string"))
    fields = sorted(c for c in df.columns if c != "_id")

    rows = df.withColumns(
        {
            "_platform": canonical_platform(F.coalesce(F.nullif(text("platform"), F.lit("")), F.lit(source.name))),
            "_es_id": S.first_filled(text("_id"), text("source_id")),
            "_query": _harvested_query(df),
        }
    ).where(F.col("_es_id").isNotNull())
    social = F.col("_platform").isin(*social_platforms())
    counters = {c: N.social_count(_column(df, c), social) for c in COUNTERS}
    created, collected = (times.any_time(_column(df, c).cast("string")) for c in ("created_at", "collected_at"))

    out = rows.select(
        S.unified_id(F.lit(index), F.col("_es_id")).alias("id"),
        F.col("_platform").alias("platform"),
        S.first_filled(text("stage"), F.lit("raw")).alias("stage"),
        F.lit(source.label).alias("source"),
        F.lit(index).alias("source_index"),
        F.col("_es_id").alias("source_es_id"),
        S.first_filled(text("source_id"), text("post_id"), F.col("_es_id")).alias("source_id"),
        *[text(c).alias(c) for c in ("category", "search_term", "api_query")],
        F.col("_query").alias("harvested_query"),
        text("instance").alias("instance"),
        S.first_filled(text("author_handle"), text("author_display_name"), text("domain"), F.lit("unknown")).alias("author"),
        text("author_handle").alias("author_handle"),
        text("author_display_name").alias("author_display_name"),
        F.coalesce(S.first_filled(text("instance"), text("domain")), F.lit("")).alias("location_hint"),
        S.compact(_column(df, "text"), max_text_length).alias("text"),
        F.coalesce(S.first_filled(text("url"), text("gkg_url")), F.lit("")).alias("url"),
        F.coalesce(created, collected, imported_at).alias("created_at"),
        collected.alias("collected_at"),
        F.coalesce(collected, imported_at).alias("harvested_at"),
        *[n.alias(c) for c, n in counters.items()],
        social.alias("has_engagement_metrics"),
        *[text(c).alias(c) for c in ("domain", "gkg_file_id", "gkg_url", "tone")],
        F.lit("pending").alias("analysis_status"),
        F.lit(None).cast("timestamp").alias("analysis_started_at"),
        F.lit(None).cast("timestamp").alias("analysis_processed_at"),
        F.struct(*[n.alias(c) for c, n in counters.items()]).alias("engagement"),
        F.struct(
            F.lit(index).alias("source_index"),
            F.col("_es_id").alias("source_es_id"),
            F.array(*[F.lit(c) for c in fields]).alias("source_fields"),
        ).alias("payload"),
    )
    return keep_social(out, strict=strict)


def unify_all(frames: dict[str, DataFrame], sources: Sequence[SourceSpec] = SOURCES, **options) -> DataFrame:
    """All registered sources that have a frame; a source's own normaliser runs first if it has one."""
    parts = []
    for source in sources:
        if source.name in frames:
            frame = frames[source.name]
            parts.append(unify(source.normaliser(frame) if source.normaliser else frame, source, **options))
    return union_sources(parts)


def raw_record(df: DataFrame, *, platform: str, source: str, harvested_at: Column | None = None) -> DataFrame:
    """Raw rows from a feed with an `engagement` struct whose counters may carry alternative names.

    Expects source_id, text, query, created_at, author, location_hint, url, engagement.
    """
    names = {f.name for f in df.schema["engagement"].dataType.fields}

    def counter(*options: str) -> Column:
        present = [F.col(f"engagement.{o}") for o in options if o in names]
        return F.coalesce(*present, F.lit(None)).cast("bigint")

    empty = lambda c: F.coalesce(F.col(c), F.lit(""))
    counters = {
        "like_count": counter("like_count"),
        "reply_count": counter("reply_count", "replies_count"),
        "repost_count": counter("repost_count", "reblogs_count"),
        "quote_count": counter("quote_count"),
    }
    return df.select(
        S.raw_record_id(F.lit(platform), *[F.col(c) for c in ("source_id", "url", "created_at", "text")]).alias("id"),
        F.lit(platform).alias("platform"),
        F.lit("raw").alias("stage"),
        F.lit(source).alias("source"),
        "source_id",
        S.first_filled(F.col("author"), F.lit("unknown")).alias("author"),
        empty("location_hint").alias("location_hint"),
        empty("text").alias("text"),
        F.col("query").alias("harvested_query"),
        empty("url").alias("url"),
        times.any_time(F.col("created_at").cast("string")).alias("created_at"),
        (harvested_at if harvested_at is not None else F.current_timestamp()).alias("harvested_at"),
        *[n.alias(c) for c, n in counters.items()],
        F.col("engagement").isNotNull().alias("has_engagement_metrics"),
        F.lit("pending").alias("analysis_status"),
    )


