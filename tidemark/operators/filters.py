"""Row filters shared by all post queries."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import vocabulary as V
from tidemark.functions import strings as S
from tidemark.functions import times
from tidemark.functions.labels import topic_of_seed, with_relevance
from tidemark.functions.staging import staged
from tidemark.registry import group_platforms, social_platforms

TIME_FIELDS = ("created_at", "harvested_at", "processed_at")
QUALITY_MODES = ("all", "clean")
MONTH = "created_month"  # partition column of stored posts, `yyyy-MM` of created_at


def split_csv(value: str | None) -> list[str]:
    return [part.strip() for part in (value or "").split(",") if part.strip()]


def check_period(period: str) -> str:
    if period not in times.PERIOD_FORMATS:
        raise ValueError(f"period must be one of {sorted(times.PERIOD_FORMATS)}, not {period!r}")
    return period


def excluded_flags(quality: str = "all", exclude: str | None = None) -> list[str]:
    if quality not in QUALITY_MODES:
        raise ValueError(f"quality must be one of {QUALITY_MODES}, not {quality!r}")
    flags = set(split_csv(exclude))
    if quality == "clean":
        flags.update(V.DEFAULT_UNCLEAN_FLAGS)
    return sorted(flags)


@dataclass(frozen=True)
class PostFilter:
    """Arguments every post query accepts. Bad values raise here, before a plan is built."""

    platform: str | None = None
    topic: str | None = None
    source_group: str = "all"
    start: str | None = None
    end: str | None = None
    time_field: str = "created_at"
    quality: str = "all"
    exclude_quality_flags: str | None = None

    def __post_init__(self) -> None:
        if self.source_group != "all" and self.source_group not in group_platforms():
            raise ValueError(f"unknown source group {self.source_group!r}")
        if self.time_field not in TIME_FIELDS:
            raise ValueError(f"time field must be one of {TIME_FIELDS}, not {self.time_field!r}")
        excluded_flags(self.quality, self.exclude_quality_flags)


def is_processed() -> Column:
    return (F.col("processing_status") == "processed") & F.col("sentiment_score").isNotNull()


def carries_flag(flags: Sequence[str], column: str = "quality_flags") -> Column:
    """Whether the flag array shares an entry with `flags`; a null array is empty."""
    if not flags:
        return F.lit(False)
    return F.coalesce(F.arrays_overlap(F.col(column), F.array(*[F.lit(f) for f in flags])), F.lit(False))


def is_clean(flags: Sequence[str] = V.DEFAULT_UNCLEAN_FLAGS) -> Column:
    return ~carries_flag(flags)


def in_time_range(column: Column, start: str | None, end: str | None) -> Column:
    """Inclusive at both ends; a date-only end means the end of that day. Null times fall out.

    Bounds are folded to literals of the column's own type, so the scan can use them.
    """
    condition = F.lit(True)
    if start:
        condition = condition & (column >= F.to_timestamp(F.lit(start)))
    if end and len(end) == 10:
        condition = condition & (column < F.to_timestamp(F.lit(end)) + F.expr("interval 1 day"))
    elif end:
        condition = condition & (column <= F.to_timestamp(F.lit(end)))
    return condition


def in_months(start: str | None, end: str | None) -> Column:
    """The same range on the month partition, so that other partitions are not listed or read."""
    month = lambda value: times.period_of(F.to_timestamp(F.lit(value)), "month")
    condition = F.lit(True)
    if start:
        condition = condition & (F.col(MONTH) >= month(start))
    if end:
        condition = condition & (F.col(MONTH) <= month(end))
    return condition


def filter_posts(df: DataFrame, f: PostFilter = PostFilter(), *, processed_only: bool = True) -> DataFrame:
    """Processed rows that pass every given argument."""
    if processed_only:
        df = df.where(is_processed())
    if platforms := split_csv(f.platform):
        df = df.where(F.col("platform").isin(platforms))
    if topics := split_csv(f.topic):
        df = df.where(F.col("topic").isin(topics))
    if f.source_group != "all":
        df = df.where(F.col("platform").isin(group_platforms()[f.source_group]))
    if f.start or f.end:
        df = df.where(in_time_range(F.col(f.time_field), f.start, f.end))
        if f.time_field == "created_at" and MONTH in df.columns:
            df = df.where(in_months(f.start, f.end))
    if flags := excluded_flags(f.quality, f.exclude_quality_flags):
        df = df.where(~carries_flag(flags))
    return df


# ------------------------------------------------------------------- raw rows
def is_stale(as_of: Column, minutes: int = 120) -> Column:
    """Taken for processing more than `minutes` ago and not finished."""
    limit = as_of - F.make_dt_interval(mins=F.lit(minutes))
    return F.coalesce(
        (F.col("analysis_status") == "processing") & (F.col("analysis_started_at") < limit), F.lit(False)
    )


def is_pending(as_of: Column, minutes: int = 120) -> Column:
    """Never processed, waiting, or stale."""
    status = F.col("analysis_status")
    return status.isNull() | (status == "pending") | is_stale(as_of, minutes)


def is_error() -> Column:
    return F.col("analysis_status").isin("error", "failed")


def is_usable(id_column: Column, text: Column, created_at: Column | None = None,
              since: Column | None = None, until: Column | None = None) -> Column:
    """Has an id and a text and, if an interval is given, lies inside it (both ends included)."""
    keep = F.coalesce(id_column != "", F.lit(False)) & F.coalesce(text != "", F.lit(False))
    if created_at is not None:
        if since is not None:
            keep = keep & F.coalesce(created_at >= since, F.lit(False))
        if until is not None:
            keep = keep & F.coalesce(created_at <= until, F.lit(False))
    return keep


def collected_within(df: DataFrame, as_of: Column, *, lookback_hours: float | None = None,
                     start: str | None = None, end: str | None = None) -> DataFrame:
    """Windowed source scan: recently collected, created inside the (inclusive) interval."""
    if lookback_hours:
        seconds = int(lookback_hours * 3600)
        df = df.where(F.col("collected_at") >= as_of - F.make_dt_interval(secs=F.lit(seconds)))
    if start or end:
        df = df.where(in_time_range(F.col("created_at"), start, end))
    return df


def keep_social(df: DataFrame, *, text: str = "text", seed: str = "harvested_query", strict: bool = False) -> DataFrame:
    """Off by default. When strict, social rows need local context and must be relevant to their seed."""
    if not strict:
        return df
    social = F.coalesce(F.col("platform").isin(*social_platforms()), F.lit(False))
    # other rows pass unread; a social text is searched once for both questions
    df = staged(df, {"_hint_topic": topic_of_seed(F.when(social, F.col(seed))), "_social_text": F.when(social, F.col(text))})
    df = with_relevance(
        df, "_social_text", hint=F.col("_hint_topic"), trust_hint=F.col("_hint_topic").isNotNull(), name="_relevant", local_name="_local"
    )
    return df.where(~social | (F.col("_relevant") & F.col("_local"))).drop("_hint_topic", "_social_text", "_relevant", "_local")


# ----------------------------------------------------------------- indicators
def measure_like(measure: str) -> Column:
    return F.contains(S.casefold(F.col("measure")), F.lit(measure.casefold()))


def find_indicators(df: DataFrame, *, indicator: str | None = None, item_name: str | None = None,
                    size: int | None = None) -> DataFrame:
    """Exact indicator, case-insensitive part of the item name, newest period first."""
    if indicator:
        df = df.where(F.col("indicator") == indicator)
    if item_name:
        df = df.where(F.contains(S.casefold(F.col("item_name")), F.lit(item_name.casefold())))
    df = df.orderBy(F.col("period_start").desc(), "item_name", "measure", "id")
    return df.limit(size) if size else df
