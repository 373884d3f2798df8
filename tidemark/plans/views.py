"""Adapter views: the library's tables built from the driver's tables, once per engine.

The Spark side is a DataFrame, the check side a list of common table expressions for DuckDB. Both
state the same integer expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import spread

AS_OF = "2001-08-10 00:00:00"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def as_of() -> Column:
    return F.lit(AS_OF).cast("timestamp")


def ctes(*parts: str) -> str:
    return "with " + ",\n".join(part.strip() for part in parts) + "\n"


# ---------------------------------------------------------------------- posts
def posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Processed posts from orders."""
    return table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey as k", "o_custkey as c", "o_orderdate as d", "o_totalprice as p",
        "case o_orderstatus when 'F' then 'bluesky' when 'O' then 'mastodon' else 'gdelt' end as platform",
        "case left(o_orderpriority, 1) when '1' then 'housing' when '2' then 'groceries' when '3' then 'fuel' "
        "when '4' then 'energy' else 'transport' end as topic",
    ).selectExpr(
        "concat('raw-', cast(k as string)) as raw_id",
        "platform",
        "case platform when 'gdelt' then 'media' else 'social' end as source_group",
        "topic",
        "case when k % 5 = 0 then 'harvest_category_fallback' else 'text_keywords' end as topic_source",
        "concat('canonical-', sha1(concat(platform, '|', cast(c as string)))) as canonical_id",
        "cast(d as timestamp) as created_at",
        "cast(timestampadd(HOUR, cast(k % 72 as int), d) as timestamp) as harvested_at",
        "cast(timestampadd(MINUTE, cast(k % 72 as int) * 60 + 30, d) as timestamp) as processed_at",
        "case when k % 23 = 0 then 'discarded' when k % 29 = 0 then 'error' else 'processed' end as processing_status",
        "case when k % 23 = 0 or k % 29 = 0 then null else cast(round(p * 100) as bigint) % 2001 - 1000 end as score_milli",
        "array_compact(array("
        "case when platform = 'gdelt' and k % 10 = 0 then 'metadata_heavy' end,"
        "case when platform = 'gdelt' and k % 15 = 0 then 'weak_australia_context' end,"
        "case when platform <> 'gdelt' and k % 7 = 0 then 'zero_engagement' end,"
        "case when k % 11 = 0 then 'short_text' end)) as quality_flags",
    ).selectExpr(
        "*",
        "score_milli / 1000.0D as sentiment_score",
        "case when score_milli <= -50 then 'negative' when score_milli >= 50 then 'positive' "
        "when score_milli is not null then 'neutral' end as sentiment_label",
    )


POSTS = """
base as (
  select o_orderkey as k, o_custkey as c, o_orderdate as d, o_totalprice as p,
    case o_orderstatus when 'F' then 'bluesky' when 'O' then 'mastodon' else 'gdelt' end as platform,
    case left(o_orderpriority, 1) when '1' then 'housing' when '2' then 'groceries' when '3' then 'fuel'
      when '4' then 'energy' else 'transport' end as topic
  from orders),
scored as (
  select concat('raw-', cast(k as varchar)) as raw_id, k, platform, topic,
    case platform when 'gdelt' then 'media' else 'social' end as source_group,
    case when k % 5 = 0 then 'harvest_category_fallback' else 'text_keywords' end as topic_source,
    concat('canonical-', sha1(concat(platform, '|', cast(c as varchar)))) as canonical_id,
    d as created_at,
    d + to_hours(cast(k % 72 as int)) as harvested_at,
    d + to_minutes(cast(k % 72 as int) * 60 + 30) as processed_at,
    case when k % 23 = 0 then 'discarded' when k % 29 = 0 then 'error' else 'processed' end as processing_status,
    case when k % 23 = 0 or k % 29 = 0 then null else cast(round(p * 100) as bigint) % 2001 - 1000 end as score_milli,
    list_filter([
      case when platform = 'gdelt' and k % 10 = 0 then 'metadata_heavy' end,
      case when platform = 'gdelt' and k % 15 = 0 then 'weak_australia_context' end,
      case when platform <> 'gdelt' and k % 7 = 0 then 'zero_engagement' end,
      case when k % 11 = 0 then 'short_text' end], lambda x: x is not null) as quality_flags
  from base),
all_posts as (
  select *, score_milli / 1000.0 as sentiment_score,
    case when score_milli <= -50 then 'negative' when score_milli >= 50 then 'positive'
      when score_milli is not null then 'neutral' end as sentiment_label,
    not list_has_any(quality_flags, ['metadata_heavy', 'weak_australia_context']) as clean
  from scored),
posts as (
  select * from all_posts where processing_status = 'processed' and sentiment_score is not null)
"""

LABELS = """
labels_of as (
  select * from (values ('housing', 'Housing / Rent'), ('groceries', 'Groceries'), ('fuel', 'Fuel'),
    ('energy', 'Electricity / Utilities'), ('transport', 'Transport')) as t(cost_category, category_label))
"""


# ------------------------------------------------------------------ raw posts
def raw_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw posts with five processing states, from orders."""
    return posts(spark, sf_dir).selectExpr(
        "raw_id as id", "cast(substring(raw_id, 5) as bigint) as k", "platform",
        "concat(platform, '_raw_stream') as source_index", "created_at", "harvested_at",
    ).selectExpr(
        "*",
        "case k % 10 when 0 then 'pending' when 1 then 'processing' when 2 then 'discarded' when 3 then 'error' "
        "when 4 then null else 'processed' end as analysis_status",
        "case when k % 10 = 1 then cast(timestampadd(MINUTE, cast(k % 300 as int), harvested_at) as timestamp) end "
        "as analysis_started_at",
    )


RAW = """
raw_posts as (
  select raw_id as id, k, platform, concat(platform, '_raw_stream') as source_index, created_at, harvested_at,
    case k % 10 when 0 then 'pending' when 1 then 'processing' when 2 then 'discarded' when 3 then 'error'
      when 4 then null else 'processed' end as analysis_status,
    case when k % 10 = 1 then harvested_at + to_minutes(cast(k % 300 as int)) end as analysis_started_at
  from scored)
"""


# ----------------------------------------------------------------- indicators
def indicators(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two monthly measures per item, from lineitem. `Rents` has no yearly change (fallback case)."""
    items = table(spark, sf_dir, "lineitem").groupBy(
        F.date_format("l_shipdate", "yyyy-MM").alias("period"),
        F.expr("case l_returnflag when 'A' then 'Rents' when 'N' then 'Automotive fuel' else 'Electricity' end")
        .alias("item_name"),
    ).agg(
        F.expr("sum(cast(round(l_extendedprice * 100) as bigint))").alias("price_units"),
        F.expr("sum(cast(round(l_discount * 100) as bigint))").alias("discount_units"),
        F.expr("count(1)").alias("n"),
    )
    measures = items.selectExpr(
        "period", "item_name",
        "inline(array("
        "struct('Index numbers' as measure, price_units / n / 100000.0D as value),"
        "struct('Percentage change from previous year' as measure, discount_units / n as value)))",
    )
    return measures.where("not (item_name = 'Rents' and measure like 'Percentage%')").selectExpr(
        "concat('cpi-', sha1(concat_ws('|', item_name, measure, period))) as id",
        "'monthly_cpi' as indicator", "measure", "item_name", "period",
        "cast(to_date(concat(period, '-01')) as timestamp) as period_start", "value",
    )


INDICATORS = """
items as (
  select strftime(l_shipdate, '%Y-%m') as period,
    case l_returnflag when 'A' then 'Rents' when 'N' then 'Automotive fuel' else 'Electricity' end as item_name,
    sum(cast(round(l_extendedprice * 100) as bigint)) as price_units,
    sum(cast(round(l_discount * 100) as bigint)) as discount_units, count(*) as n
  from lineitem group by all),
indicators as (
  select period, item_name, 'Index numbers' as measure,
    cast(price_units as double) / n / cast(100000.0 as double) as value from items
  union all
  select period, item_name, 'Percentage change from previous year', cast(discount_units as double) / n
  from items where item_name <> 'Rents')
"""


# ----------------------------------------------------------------- text posts
# One sentence is added to each document so that every rule has rows to act on.
PHRASES = (
    "My rent increase in Melbourne is too expensive!",
    "Woolworths groceries and milk keep going up",
    "Petrol prices at the servo are outrageous??",
    "The electricity bill shock hurts, not good",
    "Myki fares and parking in Sydney",
    "Coffee at the cafe is very good but pricey",
    "GP gap fee and Medicare bulk billing worries",
    "A new fridge, washing machine and sofa: sale now on",
    "Inflation and the cost-of-living crisis in Australia!!",
    "Wages are not great, no pay rise",
    "HECS debt and student debt repayments",
    "School fees and childcare fees are rising in Perth",
    "Europe runs low on jet fuel this summer",
    "That song lives rent free in my mind",
    "Register for the school ranking webinar, buy now",
    "Housing affordability: no-grounds evictions in Tasmania",
    "A West End musical about a landlord in Brisbane",
    "TAX_FNCACT; WB_678; a; b; c; d; e food prices in Australia",
    "See https://example.org/x #rent @someone <b>rents</b> rising",
    "Can't afford the mortgage stress in Canberra",
    "Nothing to see here",
    "Trump and the American power bill",
    "extremely bad, worst year, hopeless power prices in nsw",
    "public  transport cost australia: train fare",
)


def text_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw posts with whole texts, from documents."""
    phrases = F.array(*[F.lit(p) for p in PHRASES])
    return (
        spread(table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "text"), "doc_id")
        .select(
            "doc_id", "lang", "source",
            F.concat(F.col("text"), F.lit(" "), F.element_at(phrases, (F.col("doc_id") % 24 + 1).cast("int"))).alias("text"),
        )
        .selectExpr(
            "*",
            "concat('raw-', cast(doc_id as string)) as id",
            "case doc_id % 3 when 0 then 'bluesky' when 1 then 'mastodon' else 'gdelt' end as platform",
            "case when doc_id % 4 = 0 then 'groceries' when doc_id % 4 = 1 then 'fuel' end as category",
            "case when doc_id % 6 = 5 then '' else concat('https://', source, '.example.org/', cast(doc_id % 700 as string)) end as url",
            "doc_id % 5 as like_count", "doc_id % 2 as reply_count",
            "case when doc_id % 3 = 0 then null else doc_id % 4 end as repost_count", "0L as quote_count",
            "concat(source, '-', cast(doc_id % 800 as string)) as source_id",
            "concat(source, '_raw_stream') as source_index",
            "timestampadd(HOUR, cast(doc_id % 9000 as int), timestamp'2025-01-01 00:00:00') as created_at",
        )
    )


TEXT = """
phrases as (select [{}] as p),
text_posts as (
  select doc_id, lang, source, concat(text, ' ', p[cast(doc_id % 24 + 1 as int)]) as text,
    concat('raw-', cast(doc_id as varchar)) as id,
    case doc_id % 3 when 0 then 'bluesky' when 1 then 'mastodon' else 'gdelt' end as platform,
    case when doc_id % 4 = 0 then 'groceries' when doc_id % 4 = 1 then 'fuel' end as category,
    case when doc_id % 6 = 5 then '' else concat('https://', source, '.example.org/', cast(doc_id % 700 as varchar)) end as url,
    doc_id % 5 as like_count, doc_id % 2 as reply_count,
    case when doc_id % 3 = 0 then null else doc_id % 4 end as repost_count, 0 as quote_count,
    concat(source, '-', cast(doc_id % 800 as varchar)) as source_id,
    concat(source, '_raw_stream') as source_index,
    timestamp '2025-01-01 00:00:00' + to_hours(cast(doc_id % 9000 as int)) as created_at
  from documents, phrases)
""".format(", ".join("'" + p.replace("'", "''") + "'" for p in PHRASES))


# --------------------------------------------------------------- event tables
def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Request log from events."""
    return table(spark, sf_dir, "events").selectExpr(
        "event_id", "cast(user_id as string) as client", "event_type as route", "cast(ts as timestamp) as ts",
        "value as duration_ms", "case when event_type = 'error' then 500 else 200 end as status",
    )


REQUESTS = """
requests as (
  select event_id, cast(user_id as varchar) as client, event_type as route, ts, value as duration_ms,
    case when event_type = 'error' then 500 else 200 end as status
  from events)
"""


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Queue payloads as text, from events; some are not JSON, some not objects."""
    return table(spark, sf_dir, "events").selectExpr(
        "event_id",
        "case when event_id % 19 = 0 then concat('not json ', props) when event_id % 23 = 0 then '[1, 2]' "
        "else to_json(named_struct('message_id', cast(event_id as string), 'kind', "
        "if(event_id % 17 = 0, 'unknown', 'nlp_batch'), 'attempts', event_id % 4)) end as payload",
        "event_id % 7 = 0 as failed",
    )


MESSAGES = """
messages as (
  select event_id,
    case when event_id % 19 = 0 or event_id % 23 = 0 then null
      when event_id % 17 = 0 then 'unknown' else 'nlp_batch' end as kind,
    case when event_id % 19 = 0 then concat('not json ', props) when event_id % 23 = 0 then '[1, 2]'
      else concat('{"message_id":"', event_id, '","kind":"', case when event_id % 17 = 0 then 'unknown' else 'nlp_batch' end,
        '","attempts":', event_id % 4, '}') end as payload,
    case when event_id % 19 = 0 or event_id % 23 = 0 then 0 else event_id % 4 end as attempts,
    event_id % 7 = 0 as failed
  from events)
"""


def lifecycle_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Job events: every run has a start and most have an end, from events."""
    base = table(spark, sf_dir, "events").selectExpr(
        "event_id", "concat('run-', cast(event_id as string)) as run_id", "concat('job-', event_type) as job_name",
        "cast(ts as timestamp) as ts", "value",
    )
    return base.selectExpr(
        "run_id", "job_name",
        "inline(array("
        "struct(if(event_id % 13 = 0, 'skipped', 'started') as status, ts as emitted_at, cast(null as double) as duration_ms),"
        "struct(case when event_id % 13 = 0 or event_id % 11 = 0 then 'none' when event_id % 5 = 0 then 'failed' else 'succeeded' end as status,"
        " timestampadd(SECOND, cast(event_id % 90 as int), ts) as emitted_at, value as duration_ms)))",
    ).where("status <> 'none'").selectExpr("concat(run_id, '-', status) as event_id", "*")


LIFECYCLE = """
lifecycle as (
  select concat('run-', event_id) as run_id, concat('job-', event_type) as job_name,
    case when event_id % 13 = 0 then 'skipped' else 'started' end as status, ts as emitted_at,
    cast(null as double) as duration_ms from events
  union all
  select concat('run-', event_id), concat('job-', event_type),
    case when event_id % 5 = 0 then 'failed' else 'succeeded' end, ts + to_seconds(cast(event_id % 90 as int)), value
  from events where event_id % 13 <> 0 and event_id % 11 <> 0)
"""
