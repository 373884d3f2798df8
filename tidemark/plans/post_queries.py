"""Registered post queries: filters, aggregates, windows, sorts and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import Window

from tidemark.functions import numbers as N
from tidemark.functions import strings as S
from tidemark.functions import times
from tidemark.operators import metrics as M
from tidemark.operators.filters import PostFilter, filter_posts, is_clean, is_processed
from tidemark.plans import views
from tidemark.plans.catalog import query
from tidemark.plans.views import LABELS, POSTS, ctes
from tidemark.registry import label_dimension, source_dimension


def r4(expression: str) -> str:
    return f"(round_even(cast({expression} as double) * 1e4, 0) / 1e4)"


def mean4(where: str = "") -> str:
    f = f" filter (where {where})" if where else ""
    return f"(round_even(cast(sum(score_milli){f} * 10 as double) / count(score_milli){f}, 0) / 1e4)"


DUP = r4("(count(*) - count(distinct canonical_id)) / count(*)")
KEYS = "count(*) as document_count, count(distinct canonical_id) as unique_document_count, " + DUP + " as duplicate_ratio"
SENT = f"""{mean4()} as avg_sentiment,
  count(*) filter (where sentiment_label = 'positive') as positive_count,
  count(*) filter (where sentiment_label = 'neutral') as neutral_count,
  count(*) filter (where sentiment_label = 'negative') as negative_count,
  {r4("count(*) filter (where sentiment_label = 'positive') / count(*)")} as positive_ratio,
  {r4("count(*) filter (where sentiment_label = 'neutral') / count(*)")} as neutral_ratio,
  {r4("count(*) filter (where sentiment_label = 'negative') / count(*)")} as negative_ratio"""
BASE = ctes(POSTS, LABELS)


def _ids(f: PostFilter):
    return lambda spark, d: filter_posts(views.posts(spark, d), f).select("raw_id")


# -------------------------------------------------------------------- filters
query("f01_processed", ctes(POSTS) + "select raw_id from posts")(_ids(PostFilter()))
query("f02_csv_in_list", ctes(POSTS) + "select raw_id from posts where platform in ('bluesky','gdelt') and topic in ('fuel','energy')")(
    _ids(PostFilter(platform=" bluesky, ,gdelt", topic="fuel,energy"))
)
query("f03_source_group", ctes(POSTS) + "select raw_id from posts where platform = 'gdelt'")(
    _ids(PostFilter(source_group="media", platform="gdelt,mastodon"))
)
query(
    "f04_time_range",
    ctes(POSTS) + "select raw_id from posts where harvested_at >= timestamp '1996-03-01' and harvested_at < timestamp '1997-04-01'",
)(_ids(PostFilter(start="1996-03-01", end="1997-03-31", time_field="harvested_at")))
query(
    "f05_exclude_flags",
    ctes(POSTS) + "select raw_id from posts where clean and not list_contains(quality_flags, 'short_text')",
)(_ids(PostFilter(quality="clean", exclude_quality_flags="short_text")))
query(
    "f06_composite",
    ctes(POSTS) + """select raw_id from posts where platform in ('bluesky','mastodon') and topic = 'housing' and clean
      and not list_contains(quality_flags, 'zero_engagement') and created_at >= timestamp '1998-01-01'
      and created_at <= timestamp '2000-06-30 12:00:00'""",
)(
    _ids(
        PostFilter(topic="housing", source_group="social", start="1998-01-01", end="2000-06-30 12:00:00",
                   quality="clean", exclude_quality_flags="zero_engagement")
    )
)


@query("f07_clean_row", ctes(POSTS) + "select clean, count(*) as document_count from posts group by 1")
def clean_rows(spark, d):
    return filter_posts(views.posts(spark, d)).groupBy(is_clean().alias("clean")).agg(
        F.count(F.lit(1)).alias("document_count")
    )


# ----------------------------------------------------------------- aggregates
@query(
    "a01_overview",
    BASE + """
, parts as (
  select 'total' as section, null as key, * from (select count(*) as document_count,
    count(*) filter (where sentiment_label = 'negative') as negative_documents,
    min(created_at) as a, max(created_at) as b from posts)
  union all select 'platform', platform, count(*), count(*) filter (where sentiment_label = 'negative'), min(created_at), max(created_at) from posts group by platform
  union all select 'category', topic, count(*), count(*) filter (where sentiment_label = 'negative'), min(created_at), max(created_at) from posts group by topic
  union all select 'sentiment', sentiment_label, count(*), count(*) filter (where sentiment_label = 'negative'), min(created_at), max(created_at) from posts group by sentiment_label)
select section, key, document_count, negative_documents, strftime(a, '%Y-%m-%d %H:%M:%S') as first_created_at,
  strftime(b, '%Y-%m-%d %H:%M:%S') as last_created_at from parts""",
)
def overview(spark, d):
    out = M.overview(views.posts(spark, d))
    for c in ("first_created_at", "last_created_at"):
        out = out.withColumn(c, F.date_format(c, "yyyy-MM-dd HH:mm:ss"))
    return out


@query(
    "a02_category_counts",
    BASE + f""", g as (select topic as cost_category, {KEYS} from posts group by 1)
select g.*, document_count as complaint_count, category_label,
  {r4("document_count / sum(document_count) over ()")} as percentage from g join labels_of using (cost_category)""",
)
def category_counts(spark, d):
    return M.category_counts(views.posts(spark, d))


@query(
    "a02_category_totals",
    BASE + "select count(*) as total_complaints, count(distinct canonical_id) as total_unique_documents from posts where clean",
)
def category_totals(spark, d):
    return M.category_totals(views.posts(spark, d), PostFilter(quality="clean"))


CATEGORY_SENTIMENT = BASE + f"""select topic as cost_category, category_label, count(*) as document_count,
  count(*) as complaint_count, {SENT} from posts join labels_of on topic = cost_category"""


@query("a03_category_sentiment", CATEGORY_SENTIMENT + " group by 1, 2")
def category_sentiment(spark, d):
    return M.category_sentiment(views.posts(spark, d))


@query("a03_category_sentiment_social_clean", CATEGORY_SENTIMENT + " where source_group = 'social' and clean group by 1, 2")
def category_sentiment_social(spark, d):
    return M.category_sentiment(views.posts(spark, d), PostFilter(source_group="social", quality="clean"))


@query(
    "a04_document_trend",
    BASE + "select strftime(harvested_at, '%Y-%m-%d') as period, platform, count(*) as document_count from posts group by 1, 2",
)
def document_trend(spark, d):
    return M.document_trend(views.posts(spark, d), PostFilter(time_field="harvested_at"), period="day")


TREND = """select strftime(created_at, '%Y-%m') as period, topic as cost_category, category_label,
  count(*) as complaint_count, """


@query("a05_category_trend", BASE + TREND + KEYS + " from posts join labels_of on topic = cost_category group by 1, 2, 3")
def category_trend(spark, d):
    return M.category_trend(views.posts(spark, d))


@query("a06_sentiment_trend", BASE + TREND + KEYS + ", " + SENT + " from posts join labels_of on topic = cost_category group by 1, 2, 3")
def sentiment_trend(spark, d):
    return M.sentiment_trend(views.posts(spark, d))


@query(
    "a07_category_share",
    BASE + ", t as (" + TREND + KEYS + " from posts join labels_of on topic = cost_category group by 1, 2, 3) "
    + f"select *, {r4('document_count / sum(document_count) over (partition by period)')} as percentage from t",
)
def category_share(spark, d):
    return M.category_share(views.posts(spark, d))


@query(
    "a08_quality_summary",
    BASE + f""", parts as (
  select 'total' as section, null as key, count(*) as n, count(*) filter (where clean) as c from posts
  union all select 'source_group', source_group, count(*), count(*) filter (where clean) from posts group by 2
  union all select 'topic_source', topic_source, count(*), count(*) filter (where clean) from posts group by 2
  union all select 'flag', f, count(*), count(*) filter (where clean) from (select unnest(quality_flags) as f, clean from posts) group by 2)
select section, key, n as document_count, c as clean_documents, n - c as flagged_documents, {r4("c / n")} as clean_ratio from parts""",
)
def quality_summary(spark, d):
    return M.quality_summary(views.posts(spark, d), PostFilter(quality="clean"))


@query(
    "a09_quality_comparison",
    BASE + f"""select topic as cost_category, category_label, count(*) as all_document_count,
  count(*) filter (where clean) as clean_document_count, count(*) filter (where not clean) as excluded_document_count,
  {r4("count(*) filter (where clean) / count(*)")} as clean_ratio,
  count(distinct canonical_id) as all_unique_document_count,
  count(distinct canonical_id) filter (where clean) as clean_unique_document_count
  from posts join labels_of on topic = cost_category group by 1, 2""",
)
def quality_comparison(spark, d):
    return M.quality_comparison(views.posts(spark, d))


@query(
    "a10_media_coverage",
    BASE + TREND + "count(*) as coverage_count, " + KEYS + ", " + SENT
    + " from posts join labels_of on topic = cost_category where source_group = 'media' and clean group by 1, 2, 3",
)
def media_coverage(spark, d):
    return M.media_coverage(views.posts(spark, d))


PLATFORM_CATEGORIES = BASE + f""", g as (select platform, topic as cost_category, category_label, {KEYS}, {mean4()} as avg_sentiment
  from posts join labels_of on topic = cost_category group by 1, 2, 3)
select platform, cost_category, category_label, document_count as count, unique_document_count, duplicate_ratio, avg_sentiment,
  {r4("document_count / sum(document_count) over (partition by platform)")} as percentage_within_platform from g"""


@query("a11_platform_categories", PLATFORM_CATEGORIES)
def platform_categories(spark, d):
    return M.platform_categories(views.posts(spark, d))


MONTHLY = """, monthly as (select strftime(created_at, '%Y-%m') as period, topic as cost_category, count(*) as n
  from posts group by 1, 2)"""


@query(
    "a13_yoy_change",
    BASE + MONTHLY + f""",
kept as (select period, row_number() over (order by period) as position from
  (select distinct period from monthly order by period desc limit 24)),
sides as (select cost_category, coalesce(sum(n) filter (where position <= 12), 0) as p,
  coalesce(sum(n) filter (where position > 12), 0) as c from monthly left join kept using (period) group by 1)
select cost_category, category_label, cast(p as bigint) as previous_period_count, cast(c as bigint) as current_period_count,
  {r4("(c - p) / nullif(p, 0)")} as yoy_growth from sides join labels_of using (cost_category)""",
)
def yoy_change(spark, d):
    return M.yoy_change(views.posts(spark, d))


@query(
    "a14_volatility",
    BASE + MONTHLY + f""" select cost_category, category_label, {r4("stddev_pop(n)")} as monthly_count_std, count(*) as months
  from monthly join labels_of using (cost_category) group by 1, 2""",
)
def volatility(spark, d):
    return M.volatility(views.posts(spark, d))


@query(
    "a18_monthly_rollup",
    BASE + f""", placed as (select *, unnest(['all', source_group]) as grp from posts where clean),
g as (select strftime(created_at, '%Y-%m') as period, grp as source_group, topic as cost_category, category_label, {KEYS},
  count(*) filter (where sentiment_label = 'negative') as negative_count,
  {r4("count(*) filter (where sentiment_label = 'negative') / count(*)")} as negative_ratio, {mean4()} as avg_sentiment
  from placed join labels_of on topic = cost_category group by 1, 2, 3, 4)
select *, concat('monthly-topic-', sha1(concat_ws('|', period, source_group, 'clean', cost_category))) as metric_id,
  concat(period, '-01') as period_start, 'clean' as quality from g""",
)
def monthly_rollup(spark, d):
    out = M.monthly_rollup(views.posts(spark, d)).drop("generated_at")
    return out.withColumn("period_start", F.date_format("period_start", "yyyy-MM-dd"))


@query(
    "a21_duplicate_pressure",
    BASE + "select " + KEYS + " from posts",
)
def duplicate_pressure(spark, d):
    return M.duplicate_pressure(views.posts(spark, d))


@query("a22_flag_histogram", BASE + "select f as flag, count(*) as document_count from (select unnest(quality_flags) as f from posts) group by 1")
def flag_histogram(spark, d):
    return M.flag_histogram(views.posts(spark, d))


@query(
    "a26_period_platform_matrix",
    BASE + """select strftime(created_at, '%Y-%m') as period, count(*) filter (where platform = 'bluesky') as bluesky,
  count(*) filter (where platform = 'gdelt') as gdelt, count(*) filter (where platform = 'mastodon') as mastodon
  from posts group by 1""",
)
def period_platform_matrix(spark, d):
    trend = M.document_trend(views.posts(spark, d))
    return M.pivot_counts(trend, "period", "platform", ["bluesky", "gdelt", "mastodon"], F.sum("document_count"))


@query(
    "a26_platform_category_mean_matrix",
    PLATFORM_CATEGORIES.replace("select platform, cost_category, category_label, document_count", "\n, m as (select platform, cost_category, category_label, document_count")
    + """) select platform, coalesce(max(avg_sentiment) filter (where cost_category = 'housing'), 0) as housing,
  coalesce(max(avg_sentiment) filter (where cost_category = 'fuel'), 0) as fuel from m group by 1""",
)
def platform_category_matrix(spark, d):
    return M.pivot_counts(
        M.platform_categories(views.posts(spark, d)), "platform", "cost_category", ["housing", "fuel"], F.avg("avg_sentiment")
    )


@query(
    "a26_period_totals",
    BASE + "select strftime(created_at, '%Y-%m') as period, count(*) as document_count from posts group by 1",
)
def period_totals(spark, d):
    return M.document_trend(views.posts(spark, d)).groupBy("period").agg(F.sum("document_count").alias("document_count"))


@query(
    "a27_headline",
    BASE + f""", c as (select topic, count(*) as n, {r4("count(*) filter (where sentiment_label = 'negative') / count(*)")} as neg
  from posts group by 1), p as (select platform, count(*) as n from posts group by 1)
select * from (select 'top_category' as finding, topic as key, cast(n as double) as value from c order by n desc, topic limit 1)
union all select * from (select 'most_negative_category', topic, neg from c order by neg desc, topic limit 1)
union all select * from (select 'largest_platform', platform, cast(n as double) from p order by n desc, platform limit 1)""",
)
def headline(spark, d):
    return M.headline(views.posts(spark, d))


@query(
    "a28_value_counts",
    BASE + "select platform, processing_status, count(*) as count from all_posts group by 1, 2",
)
def value_counts(spark, d):
    return M.value_counts(views.posts(spark, d), "platform", "processing_status")


@query(
    "a29_processing_rate",
    BASE + f"""select count(*) as raw_documents, count(*) filter (where processing_status = 'processed') as processed_documents,
  {r4("count(*) filter (where processing_status = 'processed') / count(*)")} as processing_rate,
  {r4("count(*) filter (where processing_status = 'processed' and sentiment_label = 'negative') / count(*) filter (where processing_status = 'processed')")} as negative_share
  from all_posts""",
)
def processing_rate(spark, d):
    done = is_processed()
    return views.posts(spark, d).agg(
        F.count(F.lit(1)).alias("raw_documents"),
        F.count_if(done).alias("processed_documents"),
        F.count_if(done & (F.col("sentiment_label") == "negative")).alias("_n"),
    ).select(
        "raw_documents", "processed_documents",
        N.ratio(F.col("processed_documents"), F.col("raw_documents")).alias("processing_rate"),
        N.ratio(F.col("_n"), F.col("processed_documents")).alias("negative_share"),
    )


# -------------------------------------------------------------------- windows
@query("w01_share_of_period", BASE + MONTHLY + f"""select period, cost_category,
  {r4("n / sum(n) over (partition by period)")} as percentage from monthly""")
def share_of_period(spark, d):
    return M.category_share(views.posts(spark, d)).select("period", "cost_category", "percentage")


@query("w02_share_of_platform", BASE + f"""select platform, topic as cost_category,
  {r4("count(*) / sum(count(*)) over (partition by platform)")} as percentage_within_platform from posts group by 1, 2""")
def share_of_platform(spark, d):
    return M.platform_categories(views.posts(spark, d)).select("platform", "cost_category", "percentage_within_platform")


@query("w03_share_of_total", BASE + f"""select topic as cost_category,
  {r4("count(*) / sum(count(*)) over ()")} as percentage from posts where platform = 'gdelt' group by 1""")
def share_of_total(spark, d):
    return M.category_counts(views.posts(spark, d), PostFilter(source_group="media")).select("cost_category", "percentage")


@query("w05_latest_periods", BASE + MONTHLY + """select period, row_number() over (order by period) as position from
  (select distinct period from monthly order by period desc limit 24)""")
def latest_periods(spark, d):
    return M.latest_periods(M.category_trend(views.posts(spark, d)))


@query(
    "w08_min_max_scaled",
    BASE + MONTHLY + f"""select period, cost_category, n as document_count,
  coalesce({r4("(n - min(n) over w) / nullif(max(n) over w - min(n) over w, 0)")}, 0) as scaled from monthly
  window w as (partition by cost_category)""",
)
def min_max_scaled(spark, d):
    trend = M.category_trend(views.posts(spark, d)).select("period", "cost_category", "document_count")
    return M.min_max_scaled(trend, "cost_category", "document_count", "scaled")


# ------------------------------------------------------- sorts, limits, top-k
# The compare ignores row order, so each sort is checked through its rank.
def _ranked(df, *order):
    return df.withColumn("rank", F.row_number().over(Window.orderBy(*order)).cast("bigint"))


@query("o01_counts_desc", BASE + """select topic as cost_category, count(*) as document_count,
  row_number() over (order by count(*) desc, topic) as rank from posts group by 1""")
def counts_desc(spark, d):
    out = M.category_counts(views.posts(spark, d)).select("cost_category", "document_count")
    return _ranked(out, F.col("document_count").desc(), "cost_category")


@query("o02_sentiment_asc", BASE + f"""select topic as cost_category, row_number() over (order by coalesce({mean4()}, 0), topic) as rank
  from posts group by 1""")
def sentiment_asc(spark, d):
    out = M.category_sentiment(views.posts(spark, d)).select("cost_category", "avg_sentiment")
    return _ranked(out, F.coalesce("avg_sentiment", F.lit(0.0)), "cost_category").drop("avg_sentiment")


@query("o03_period_then_key", BASE + """select strftime(created_at, '%Y-%m') as period, platform,
  row_number() over (order by strftime(created_at, '%Y-%m'), platform) as rank from posts group by 1, 2""")
def period_then_key(spark, d):
    return _ranked(M.document_trend(views.posts(spark, d)).select("period", "platform"), "period", "platform")


@query("o04_excluded_desc", BASE + """select topic as cost_category, count(*) filter (where not clean) as excluded_document_count,
  row_number() over (order by count(*) filter (where not clean) desc, topic) as rank from posts group by 1""")
def excluded_desc(spark, d):
    out = M.quality_comparison(views.posts(spark, d)).select("cost_category", "excluded_document_count")
    return _ranked(out, F.col("excluded_document_count").desc(), "cost_category")


@query("o06_bounded_sample", BASE + "select raw_id from posts order by raw_id limit 9999")
def bounded_sample(spark, d):
    """Sampling operator: rows are taken in key order."""
    from tidemark.operators.keywords import bounded_sample as sample

    return sample(filter_posts(views.posts(spark, d)), 9999, "raw_id").select("raw_id")


@query(
    "o07_cap_per_source",
    BASE + """select platform, raw_id from (select platform, raw_id,
  row_number() over (partition by platform order by created_at desc, raw_id) as r from posts) where r <= 40""",
)
def cap_per_source(spark, d):
    from tidemark.operators.latest import newest_per_group

    return newest_per_group(
        filter_posts(views.posts(spark, d)), ["platform"], [F.col("created_at").desc(), F.col("raw_id")], 40
    ).select("platform", "raw_id")


@query("o08_top_rows", BASE + "select topic as cost_category, count(*) as document_count from posts group by 1 order by 2 desc, 1 limit 3")
def top_rows(spark, d):
    return M.category_counts(views.posts(spark, d), top_n=3).select("cost_category", "document_count")


# ------------------------------------------------------------- set operations
@query(
    "u01_union_all_sources",
    ctes(POSTS) + "select raw_id as id, platform, cast(null as varchar) as topic from all_posts where platform <> 'gdelt' union all select raw_id, platform, topic from all_posts where platform = 'gdelt'",
)
def union_sources(spark, d):
    from tidemark.sources.streams import union_sources as union

    all_posts = views.posts(spark, d).withColumnRenamed("raw_id", "id")
    frames = [
        all_posts.where(F.col("platform") == p).select("id", "platform", *(["topic"] if p == "gdelt" else []))
        for p in ("bluesky", "mastodon", "gdelt")
    ]
    return union(frames).select("id", "platform", "topic")


@query("u02_group_expansion", BASE + "select unnest(['all', source_group]) as source_group, count(*) as document_count from posts group by 1")
def group_expansion(spark, d):
    """Each row counted in every rollup group it belongs to."""
    rollup = M.monthly_rollup(views.posts(spark, d), quality="all")
    return rollup.groupBy("source_group").agg(F.sum("document_count").alias("document_count"))


@query("u03_distinct_periods", BASE + "select distinct strftime(created_at, '%Y-%m') as period from posts")
def distinct_periods(spark, d):
    return filter_posts(views.posts(spark, d)).select(times.period_of(F.col("created_at"), "month").alias("period")).distinct()


@query(
    "u05_array_overlap",
    ctes(POSTS) + "select raw_id, list_has_any(quality_flags, ['short_text','metadata_heavy']) as overlaps from posts",
)
def array_overlap(spark, d):
    from tidemark.operators.filters import carries_flag

    return filter_posts(views.posts(spark, d)).select(
        "raw_id", carries_flag(["short_text", "metadata_heavy"]).alias("overlaps")
    )


@query(
    "u06_sorted_union",
    ctes(POSTS) + "select raw_id, array_to_string(list_sort(list_distinct(list_concat(quality_flags, [platform, topic]))), '|') as tags from posts",
)
def sorted_union(spark, d):
    return filter_posts(views.posts(spark, d)).select(
        "raw_id",
        F.array_join(S.sorted_set(F.concat("quality_flags", F.array("platform", "topic"))), "|").alias("tags"),
    )


# ----------------------------------------------------- joins on post results
@query(
    "j05_counts_with_sentiment",
    BASE + f"""select topic as cost_category, category_label, count(*) as document_count_counts, count(*) as document_count_sentiment,
  {mean4()} as avg_sentiment, {DUP} as duplicate_ratio from posts join labels_of on topic = cost_category group by 1, 2""",
)
def counts_with_sentiment(spark, d):
    """Two results side by side; shared columns get a suffix."""
    posts = views.posts(spark, d)
    keys = ["cost_category", "category_label"]
    left = M.category_counts(posts).select(*keys, F.col("document_count").alias("document_count_counts"), "duplicate_ratio")
    right = M.category_sentiment(posts).select(*keys, F.col("document_count").alias("document_count_sentiment"), "avg_sentiment")
    return left.join(right, keys)


@query(
    "j08_biggest_categories",
    BASE + """select strftime(created_at, '%Y-%m') as period, topic as cost_category, count(*) as document_count from posts
  where topic in (select topic from posts group by 1 order by count(*) desc, topic limit 3) group by 1, 2""",
)
def biggest_categories(spark, d):
    posts = views.posts(spark, d)
    top = M.biggest(M.category_counts(posts), "cost_category", "document_count", 3)
    trend = M.category_trend(posts).select("period", "cost_category", "document_count")
    return trend.join(F.broadcast(top.select("cost_category")), "cost_category", "left_semi")


@query(
    "j09_source_lookup",
    ctes(POSTS) + """select raw_id, source_group as registry_group, case platform when 'gdelt' then 'gdelt_gkg_raw' else concat(platform, '_raw_stream') end as source_label
  from all_posts""",
)
def source_lookup(spark, d):
    posts = views.posts(spark, d)
    return posts.join(source_dimension(spark), "platform", "left").select("raw_id", "registry_group", "source_label")


@query("j10_topic_lookup", BASE + "select raw_id, category_label from all_posts join labels_of on topic = cost_category")
def topic_lookup(spark, d):
    return views.posts(spark, d).join(label_dimension(spark), "topic", "left").select(
        "raw_id", F.coalesce("known_label", S.title_of(F.col("topic"))).alias("category_label")
    )


@query(
    "p11_topic_label",
    ctes(POSTS) + """select case topic when 'housing' then 'Housing / Rent' when 'fuel' then 'Fuel Card' when 'energy' then 'Unknown'
    else concat(upper(left(topic, 1)), substring(topic, 2)) end as category_label, count(*) as n from all_posts group by 1""",
)
def topic_labels(spark, d):
    from tidemark.registry import topic_label

    key = F.expr("case topic when 'fuel' then 'fuel_card' when 'energy' then '' else topic end")
    return (
        views.posts(spark, d).groupBy(topic_label(key, {"housing": "Housing / Rent"}).alias("category_label"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


@query(
    "j04_all_against_clean",
    BASE + """select topic as cost_category, count(*) as all_document_count, count(*) filter (where clean) as clean_document_count
  from posts group by 1""",
)
def all_against_clean(spark, d):
    """Both sides in one scan instead of a join of two results."""
    return M.quality_comparison(views.posts(spark, d)).select("cost_category", "all_document_count", "clean_document_count")
