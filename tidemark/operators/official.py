"""Posts against official monthly series."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import vocabulary as V
from tidemark.operators.filters import PostFilter, measure_like
from tidemark.operators.latest import last_per_key
from tidemark.operators.metrics import sentiment_trend
from tidemark.registry import candidate_dimension

Candidates = Mapping[str, Sequence[str]]


def series_of(indicators: DataFrame, measure: str) -> DataFrame:
    """One observation per (item, period) of a measure; the last one wins if there are several."""
    rows = indicators.where((F.col("indicator") == "monthly_cpi") & measure_like(measure))
    kept = last_per_key(
        rows.select("item_name", "period", "period_start", "measure", "value", "id"),
        ["item_name", "period"], [F.col("period_start"), F.col("id")],
    )
    return kept.select("item_name", "period", "measure", "value")


def list_key(candidates: Candidates = V.OFFICIAL_ITEMS, default: str = V.DEFAULT_TOPIC) -> Column:
    """Name of the candidate list a category uses: its own, else the default topic's."""
    category = F.col("cost_category")
    return F.when(category.isin(*candidates), category).otherwise(F.lit(default))


def selected_items(series: DataFrame, candidates: Candidates = V.OFFICIAL_ITEMS) -> DataFrame:
    """(list_name, item_name): the first candidate item of each list that has observations."""
    ranked = candidate_dimension(series.sparkSession, dict(candidates))
    available = series.select("item_name").distinct()
    return (
        ranked.join(available, "item_name", "left_semi")
        .groupBy(F.col("cost_category").alias("list_name"))
        .agg(F.min_by("item_name", "candidate_rank").alias("item_name"))
    )


def selected_series(indicators: DataFrame, measure: str, candidates: Candidates = V.OFFICIAL_ITEMS) -> DataFrame:
    """(list_name, item_name, period, measure, value) of each list's selected item."""
    series = series_of(indicators, measure)
    return selected_items(series, candidates).join(series, "item_name")


def official_comparison(
    posts: DataFrame,
    indicators: DataFrame,
    f: PostFilter = PostFilter(),
    *,
    measure: str = "Percentage change from previous year",
    index_measure: str = "Index numbers",
    period: str = "month",
    candidates: Candidates = V.OFFICIAL_ITEMS,
) -> DataFrame:
    """Category-months that have an official value, with the index value where there is one.

    Posts are scanned once and aggregated to category x month before any join, so every join here is
    between small tables; none is forced to broadcast.
    """
    if period != "month":
        raise ValueError("official comparison is monthly only")
    monthly = sentiment_trend(posts, f).withColumn("list_name", list_key(candidates))
    official = selected_series(indicators, measure, candidates).select(
        "list_name", "period",
        F.col("item_name").alias("official_indicator"),
        F.col("measure").alias("official_measure"),
        F.col("value").alias("official_value"),
    )
    index = selected_series(indicators, index_measure, candidates).select(
        "list_name", "period", F.col("value").alias("official_index_value")
    )
    keys = ["list_name", "period"]
    return monthly.join(official, keys).join(index, keys, "left").select(
        "period", "cost_category", "category_label", "official_indicator", "official_measure", "official_value",
        "official_index_value", "complaint_count", "document_count", "negative_ratio", "avg_sentiment",
    ).orderBy("cost_category", "period")


def comparison_coverage(
    posts: DataFrame,
    indicators: DataFrame,
    f: PostFilter = PostFilter(),
    *,
    measure: str = "Percentage change from previous year",
    candidates: Candidates = V.OFFICIAL_ITEMS,
) -> DataFrame:
    """First and last official period of the selected series, and of the overlap with the posts.

    One row per category carries its months (a bounded calendar), so posts are scanned once.
    """
    months = (
        sentiment_trend(posts, f).groupBy("cost_category").agg(F.collect_set("period").alias("_months"))
        .withColumn("list_name", list_key(candidates))
    )
    series = selected_series(indicators, measure, candidates).select("list_name", "period")
    shared = F.when(F.array_contains("_months", F.col("period")), F.col("period"))
    return months.join(series, "list_name").agg(
        F.min("period").alias("official_period_min"), F.max("period").alias("official_period_max"),
        F.min(shared).alias("overlap_period_min"), F.max(shared).alias("overlap_period_max"),
    )
