"""Post metrics: counts, shares, trends, coverage, change, volatility.

All frames returned here are aggregates whose size depends on the number of topics, platforms and
periods, never on the number of posts. Grouping always runs with map-side partial aggregation, and
distinct counts first group by (group, key), so one hot topic or platform is spread over all tasks.
Windows only run over such aggregates.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import numbers as N
from tidemark.functions import strings as S
from tidemark.functions import times
from tidemark.operators.filters import PostFilter, check_period, filter_posts, is_clean
from tidemark.registry import group_of, topic_label

LABELS = ("positive", "neutral", "negative")


def document_key(df: DataFrame) -> Column:
    """First filled of canonical id, raw id, id; null when all are blank."""
    return S.first_filled(*[F.col(c) for c in ("canonical_id", "raw_id", "id") if c in df.columns])


def unique_count(key: Column, approx: bool = False) -> Column:
    return F.approx_count_distinct(key) if approx else F.count_distinct(key)


def category() -> Column:
    return F.coalesce(F.nullif(F.col("topic"), F.lit("")), F.lit("unknown")).alias("cost_category")


def platform_name() -> Column:
    return F.coalesce(F.nullif(F.col("platform"), F.lit("")), F.lit("unknown")).alias("platform")


def with_label(df: DataFrame) -> DataFrame:
    return df.withColumn("category_label", topic_label(F.col("cost_category")))


def _measured(df: DataFrame, keys: Sequence[Column], *, unique: bool, sentiment: bool, approx: bool) -> DataFrame:
    """Grouped counts, optionally with distinct keys and sentiment, plus the derived ratios."""
    names = [name for name in df.select(*keys).columns]
    units = N.score_units(F.col("sentiment_score"))
    aggregates = [F.count(F.lit(1)).alias("document_count")]
    if unique:
        aggregates.append(unique_count(document_key(df), approx).alias("unique_document_count"))
    if sentiment:
        aggregates += [F.sum(units).alias("_units"), F.count(units).alias("_scored")]
        aggregates += [
            F.count_if(F.col("sentiment_label") == label).alias(f"{label}_count") for label in LABELS
        ]
    out = df.groupBy(*keys).agg(*aggregates)
    if unique:
        filled = F.when(F.col("unique_document_count") == 0, F.col("document_count")).otherwise(
            F.col("unique_document_count")
        )
        out = out.withColumn("unique_document_count", filled).withColumn(
            "duplicate_ratio", N.duplicate_ratio(F.col("document_count"), F.col("unique_document_count"))
        )
    if sentiment:
        out = out.withColumn("avg_sentiment", N.mean_score(F.col("_units"), F.col("_scored")))
        for label in LABELS:
            out = out.withColumn(f"{label}_ratio", N.ratio(F.col(f"{label}_count"), F.col("document_count")))
        out = out.drop("_units", "_scored")
    return with_label(out) if "cost_category" in names else out


def top_rows(df: DataFrame, top_n: int | None) -> DataFrame:
    return df.limit(top_n) if top_n else df


# ----------------------------------------------------------------- one period
def overview(df: DataFrame, f: PostFilter = PostFilter()) -> DataFrame:
    """One pass with grouping sets: a total row and one row per platform, category and label.

    Columns: section, key, document_count, negative_documents, first_created_at, last_created_at.
    """
    rows = filter_posts(df, f).select(
        platform_name(), category(), F.col("sentiment_label"), F.col("created_at")
    )
    sets = [[], ["platform"], ["cost_category"], ["sentiment_label"]]
    grouped = rows.groupingSets(sets, "platform", "cost_category", "sentiment_label").agg(
        F.grouping_id().alias("_set"),
        F.count(F.lit(1)).alias("document_count"),
        F.count_if(F.col("sentiment_label") == "negative").alias("negative_documents"),
        F.min("created_at").alias("first_created_at"),
        F.max("created_at").alias("last_created_at"),
    )
    section = (
        F.when(F.col("_set") == 7, "total")
        .when(F.col("_set") == 3, "platform")
        .when(F.col("_set") == 5, "category")
        .otherwise("sentiment")
    )
    key = (
        F.when(F.col("_set") == 3, F.col("platform"))
        .when(F.col("_set") == 5, F.col("cost_category"))
        .when(F.col("_set") == 6, F.col("sentiment_label"))
    )
    return grouped.select(
        section.alias("section"), key.alias("key"), "document_count", "negative_documents",
        "first_created_at", "last_created_at",
    ).orderBy("section", F.col("document_count").desc(), "key")


def category_counts(df: DataFrame, f: PostFilter = PostFilter(), *, approx: bool = False,
                    top_n: int | None = None) -> DataFrame:
    """Documents per category with distinct documents, duplicate ratio and share of the total."""
    out = _measured(filter_posts(df, f), [category()], unique=True, sentiment=False, approx=approx)
    # one row per category: the un-partitioned window sees a handful of rows
    total = F.sum("document_count").over(Window.partitionBy())
    out = out.withColumn("percentage", N.ratio(F.col("document_count"), total))
    out = out.withColumn("complaint_count", F.col("document_count"))
    return top_rows(out.orderBy(F.col("document_count").desc(), "cost_category"), top_n)


def category_totals(df: DataFrame, f: PostFilter = PostFilter(), *, approx: bool = False) -> DataFrame:
    rows = filter_posts(df, f)
    return rows.agg(
        F.count(F.lit(1)).alias("total_complaints"),
        unique_count(document_key(rows), approx).alias("total_unique_documents"),
    )


def duplicate_pressure(df: DataFrame, f: PostFilter = PostFilter(), *, approx: bool = False) -> DataFrame:
    totals = category_totals(df, f, approx=approx)
    return totals.select(
        F.col("total_complaints").alias("document_count"),
        F.col("total_unique_documents").alias("unique_document_count"),
        N.duplicate_ratio(F.col("total_complaints"), F.col("total_unique_documents")).alias("duplicate_ratio"),
    )


def category_sentiment(df: DataFrame, f: PostFilter = PostFilter(), *, top_n: int | None = None) -> DataFrame:
    """Sentiment per category, lowest average first (a missing average counts as 0)."""
    out = _measured(filter_posts(df, f), [category()], unique=False, sentiment=True, approx=False)
    out = out.withColumn("complaint_count", F.col("document_count"))
    return top_rows(
        out.orderBy(F.coalesce(F.col("avg_sentiment"), F.lit(0.0)), "cost_category"), top_n
    )


def platform_categories(df: DataFrame, f: PostFilter = PostFilter(), *, approx: bool = False) -> DataFrame:
    """Platform x category with the share inside the platform."""
    out = _measured(
        filter_posts(df, f), [platform_name(), category()], unique=True, sentiment=True, approx=approx
    )
    within = F.sum("document_count").over(Window.partitionBy("platform"))
    out = out.withColumn("percentage_within_platform", N.ratio(F.col("document_count"), within))
    return out.select(
        "platform", "cost_category", "category_label", F.col("document_count").alias("count"),
        "unique_document_count", "duplicate_ratio", "avg_sentiment", "percentage_within_platform",
    ).orderBy("platform", "cost_category")


# --------------------------------------------------------------------- trends
def document_trend(df: DataFrame, f: PostFilter = PostFilter(), *, period: str = "month") -> DataFrame:
    """Period x platform on the filter's time field; rows without that time are left out."""
    check_period(period)
    rows = filter_posts(df, f).where(F.col(f.time_field).isNotNull())
    return (
        rows.groupBy(times.period_of(F.col(f.time_field), period).alias("period"), platform_name())
        .agg(F.count(F.lit(1)).alias("document_count"))
        .orderBy("period", "platform")
    )


def category_trend(df: DataFrame, f: PostFilter = PostFilter(), *, period: str = "month",
                   sentiment: bool = False, approx: bool = False, extra_keys: Sequence[Column] = ()) -> DataFrame:
    """Period x category; with `sentiment` also averages and label counts."""
    check_period(period)
    rows = filter_posts(df, f).where(F.col("created_at").isNotNull())
    keys = [times.period_of(F.col("created_at"), period).alias("period"), category(), *extra_keys]
    out = _measured(rows, keys, unique=True, sentiment=sentiment, approx=approx)
    return out.withColumn("complaint_count", F.col("document_count")).orderBy("period", "cost_category")


def sentiment_trend(df: DataFrame, f: PostFilter = PostFilter(), *, period: str = "month",
                    approx: bool = False) -> DataFrame:
    return category_trend(df, f, period=period, sentiment=True, approx=approx)


def category_share(df: DataFrame, f: PostFilter = PostFilter(), *, period: str = "month") -> DataFrame:
    """Share of each category inside its period."""
    out = category_trend(df, f, period=period)
    total = F.sum("complaint_count").over(Window.partitionBy("period"))
    return out.withColumn("percentage", N.ratio(F.col("complaint_count"), total)).orderBy(
        "period", "cost_category"
    )


def media_coverage(df: DataFrame, f: PostFilter = PostFilter(quality="clean"), *, period: str = "month") -> DataFrame:
    """Sentiment trend of the media group with a coverage count."""
    media = PostFilter(**{**f.__dict__, "source_group": "media"})
    return sentiment_trend(df, media, period=period).withColumn("coverage_count", F.col("document_count"))


def fill_gaps(trend: DataFrame, first: str, last: str, categories: Sequence[str]) -> DataFrame:
    """Add zero rows for months without documents, for a known list of categories."""
    spark = trend.sparkSession
    months = spark.range(1).select(
        F.explode(F.sequence(F.to_date(F.lit(f"{first}-01")), F.to_date(F.lit(f"{last}-01")),
                             F.expr("interval 1 month"))).alias("_d")
    )
    grid = months.select(
        F.date_format("_d", "yyyy-MM").alias("period"),
        F.explode(F.array(*[F.lit(c) for c in categories])).alias("cost_category"),
    )
    return (
        grid.join(trend, ["period", "cost_category"], "left")
        .fillna(0, subset=[c for c in trend.columns if c.endswith("_count")])
        .orderBy("period", "cost_category")
    )


# ------------------------------------------------------------ change over time
def latest_periods(periods: DataFrame, count: int = 24) -> DataFrame:
    """The latest observed periods with their position, oldest first. Top-k first: at most `count` rows sort."""
    kept = periods.select("period").distinct().orderBy(F.col("period").desc()).limit(count)
    return kept.withColumn("position", F.row_number().over(Window.orderBy("period")).cast("bigint"))


def yoy_change(df: DataFrame, f: PostFilter = PostFilter()) -> DataFrame:
    """Latest 24 observed months: the first twelve against the rest, per category."""
    check_period("month")
    rows = filter_posts(df, f).where(F.col("created_at").isNotNull())
    monthly = rows.groupBy(times.period_of(F.col("created_at"), "month").alias("period"), category()).agg(
        F.count(F.lit(1)).alias("n")
    )
    kept = F.broadcast(latest_periods(monthly))  # at most 24 rows
    placed = monthly.join(kept, "period", "left")
    out = placed.groupBy("cost_category").agg(
        F.coalesce(F.sum(F.when(F.col("position") <= 12, F.col("n"))), F.lit(0)).alias("previous_period_count"),
        F.coalesce(F.sum(F.when(F.col("position") > 12, F.col("n"))), F.lit(0)).alias("current_period_count"),
    )
    growth = (F.col("current_period_count") - F.col("previous_period_count")).cast("double") / F.nullif(
        F.col("previous_period_count"), F.lit(0)
    )
    out = with_label(out.withColumn("yoy_growth", N.round4(growth)))
    return out.orderBy(F.col("yoy_growth").desc_nulls_last(), "cost_category")


def volatility(df: DataFrame, f: PostFilter = PostFilter()) -> DataFrame:
    """Population standard deviation of monthly counts over the months that have rows.

    Computed from whole-number sums: n * sum(c^2) - sum(c)^2 is exact, so order does not matter.
    """
    rows = filter_posts(df, f).where(F.col("created_at").isNotNull())
    monthly = rows.groupBy(times.period_of(F.col("created_at"), "month").alias("period"), category()).agg(
        F.count(F.lit(1)).cast("decimal(19,0)").alias("n")
    )
    out = monthly.groupBy("cost_category").agg(
        F.sum("n").alias("_s"),
        F.sum((F.col("n") * F.col("n")).cast("decimal(38,0)")).alias("_q"),
        F.count(F.lit(1)).alias("months"),
    )
    spread = F.col("months").cast("double") * F.col("_q").cast("double") - F.col("_s").cast("double") * F.col(
        "_s"
    ).cast("double")
    std = F.sqrt(F.greatest(spread, F.lit(0.0))) / F.col("months")
    out = out.select("cost_category", N.round4(std).alias("monthly_count_std"), "months")
    return with_label(out).orderBy(F.col("monthly_count_std").desc(), "cost_category")


# -------------------------------------------------------------------- quality
def quality_summary(df: DataFrame, f: PostFilter = PostFilter()) -> DataFrame:
    """Long form: section, key, document_count, clean_documents, clean_ratio.

    Sections: total, source_group, topic_source (one pass with grouping sets) and flag. The quality
    arguments of the filter do not apply.
    """
    base = PostFilter(**{**f.__dict__, "quality": "all", "exclude_quality_flags": None})
    rows = filter_posts(df, base).select(
        S.first_filled(F.col("source_group"), group_of(F.col("platform"))).alias("source_group"),
        F.coalesce(F.nullif(F.col("topic_source"), F.lit("")), F.lit("unknown")).alias("topic_source"),
        is_clean().alias("clean"),
        "quality_flags",
    )
    counts = [F.count(F.lit(1)).alias("document_count"), F.count_if("clean").alias("clean_documents")]
    grouped = rows.groupingSets([[], ["source_group"], ["topic_source"]], "source_group", "topic_source").agg(
        F.grouping_id().alias("_set"), *counts
    )
    sections = grouped.select(
        F.when(F.col("_set") == 3, "total").when(F.col("_set") == 1, "source_group").otherwise("topic_source")
        .alias("section"),
        F.coalesce("source_group", "topic_source").alias("key"),
        "document_count", "clean_documents",
    )
    flags = (
        rows.select(F.explode("quality_flags").alias("key"), "clean")
        .groupBy("key").agg(*counts)
        .select(F.lit("flag").alias("section"), "key", "document_count", "clean_documents")
    )
    return (
        sections.unionByName(flags)
        .withColumn("flagged_documents", F.col("document_count") - F.col("clean_documents"))
        .withColumn("clean_ratio", N.ratio(F.col("clean_documents"), F.col("document_count")))
        .orderBy("section", "key")
    )


def flag_histogram(df: DataFrame, f: PostFilter = PostFilter()) -> DataFrame:
    return (
        filter_posts(df, f).select(F.explode("quality_flags").alias("flag"))
        .groupBy("flag").agg(F.count(F.lit(1)).alias("document_count"))
        .orderBy("flag")
    )


def quality_comparison(df: DataFrame, f: PostFilter = PostFilter()) -> DataFrame:
    """All documents against the clean view per category, in one scan.

    Rows are first grouped by (category, document key); the two distinct counts then are plain sums.
    """
    base = PostFilter(**{**f.__dict__, "quality": "all", "exclude_quality_flags": None})
    rows = filter_posts(df, base)
    keyed = rows.groupBy(category(), document_key(rows).alias("_key")).agg(
        F.count(F.lit(1)).alias("_n"), F.count_if(is_clean()).alias("_clean")
    )
    out = keyed.groupBy("cost_category").agg(
        F.sum("_n").alias("all_document_count"),
        F.sum("_clean").alias("clean_document_count"),
        F.count("_key").alias("all_unique_document_count"),
        F.count_if(F.col("_key").isNotNull() & (F.col("_clean") > 0)).alias("clean_unique_document_count"),
    )
    for side in ("all", "clean"):
        unique, count = F.col(f"{side}_unique_document_count"), F.col(f"{side}_document_count")
        out = out.withColumn(f"{side}_unique_document_count", F.when(unique == 0, count).otherwise(unique))
    excluded = F.col("all_document_count") - F.col("clean_document_count")
    out = out.withColumn("excluded_document_count", excluded).withColumn(
        "clean_ratio", N.ratio(F.col("clean_document_count"), F.col("all_document_count"))
    )
    return with_label(out).orderBy(F.col("excluded_document_count").desc(), "cost_category")


# --------------------------------------------------------------------- rollup
def monthly_rollup(df: DataFrame, *, source_groups: Sequence[str] = ("all", "social", "media"),
                   quality: str = "clean", generated_at: Column | None = None) -> DataFrame:
    """Monthly metrics per source group, in one pass.

    Distinct counts do not add up over groups, so each row is placed in every group it belongs to
    (at most two) before grouping.
    """
    for group in source_groups:
        PostFilter(source_group=group)
    rows = filter_posts(df, PostFilter(quality=quality)).where(F.col("created_at").isNotNull())
    own = group_of(F.col("platform"))
    wanted = F.array(*[F.lit(g) for g in source_groups])
    rows = rows.withColumn("_group", F.explode(F.array_intersect(F.array(F.lit("all"), own), wanted)))
    keys = [
        times.period_of(F.col("created_at"), "month").alias("period"),
        category(),
        F.col("_group").alias("source_group"),
    ]
    out = _measured(rows, keys, unique=True, sentiment=True, approx=False).withColumn("quality", F.lit(quality))
    return out.select(
        S.digest_id("monthly-topic-", *[F.col(c) for c in ("period", "source_group", "quality", "cost_category")])
        .alias("metric_id"),
        "period",
        times.period_start(F.col("period")).alias("period_start"),
        "source_group", "quality", "cost_category", "category_label", "document_count",
        "unique_document_count", "duplicate_ratio", "negative_count", "negative_ratio", "avg_sentiment",
        (generated_at if generated_at is not None else F.current_timestamp()).alias("generated_at"),
    )


# ------------------------------------------------------------ dashboard shapes
def pivot_counts(df: DataFrame, rows: str, columns: str, values: Sequence[str], measure: Column) -> DataFrame:
    """Matrix with a fixed column list (no extra pass to find the values), empty cells 0."""
    return df.groupBy(rows).pivot(columns, list(values)).agg(measure).fillna(0).orderBy(rows)


def biggest(df: DataFrame, key: str, measure: str, count: int) -> DataFrame:
    """Top keys of a result, e.g. to restrict another one by a semi join."""
    return df.orderBy(F.col(measure).desc(), key).limit(count)


def headline(df: DataFrame, f: PostFilter = PostFilter()) -> DataFrame:
    """Finding per row: top category, most negative category, largest platform."""
    sentiment = category_sentiment(df, f)
    by_platform = (
        filter_posts(df, f).groupBy(platform_name()).agg(F.count(F.lit(1)).alias("document_count"))
    )

    def top(source: DataFrame, name: str, key: str, measure: str) -> DataFrame:
        return biggest(source, key, measure, 1).select(
            F.lit(name).alias("finding"), F.col(key).alias("key"), F.col(measure).cast("double").alias("value")
        )

    return (
        top(sentiment, "top_category", "cost_category", "document_count")
        .unionByName(top(sentiment, "most_negative_category", "cost_category", "negative_ratio"))
        .unionByName(top(by_platform, "largest_platform", "platform", "document_count"))
    )


def value_counts(df: DataFrame, *columns: str) -> DataFrame:
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias("count")).orderBy(F.col("count").desc(), *columns)


def min_max_scaled(df: DataFrame, key: str, value: str, out: str) -> DataFrame:
    """Scale a series to 0..1 per key; a constant series becomes 0. For aggregated series."""
    w = Window.partitionBy(key)
    low, high = F.min(value).over(w), F.max(value).over(w)
    scaled = (F.col(value) - low).cast("double") / F.nullif((high - low).cast("double"), F.lit(0.0))
    return df.withColumn(out, F.when(F.col(value).isNotNull(), F.coalesce(N.round4(scaled), F.lit(0.0))))


