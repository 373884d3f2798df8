"""Registered queries on raw state, indicators, logs and messages."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import official as OF
from tidemark.operators import profile as PR
from tidemark.operators import routing as RO
from tidemark.operators import status as ST
from tidemark.operators.filters import find_indicators, is_error, is_pending, is_stale, measure_like
from tidemark.operators.metrics import min_max_scaled
from tidemark.plans import views
from tidemark.plans.catalog import query
from tidemark.plans.post_queries import mean4, r4
from tidemark.plans.views import AS_OF, INDICATORS, LABELS, LIFECYCLE, MESSAGES, POSTS, RAW, REQUESTS, ctes

RAWBASE = ctes(POSTS, RAW)
CUT = f"timestamp '{AS_OF}' - interval 120 minutes"
STALE = f"(coalesce(analysis_status, '') = 'processing' and analysis_started_at < {CUT})"
PENDING = f"(analysis_status is null or analysis_status = 'pending' or {STALE})"
TSF = "yyyy-MM-dd HH:mm:ss"


def _text_times(df, *columns):
    for c in columns:
        df = df.withColumn(c, F.date_format(c, TSF))
    return df


def _raw(spark, d):
    return views.raw_posts(spark, d)


# ----------------------------------------------------------------- raw state
@query("f09_pending_rows", RAWBASE + f"select id from raw_posts where {PENDING}")
def pending_rows(spark, d):
    return _raw(spark, d).where(is_pending(views.as_of())).select("id")


@query("f10_stale_rows", RAWBASE + f"select count(*) as stale, count(*) filter (where {STALE}) as stale_processing from raw_posts where analysis_status = 'processing'")
def stale_rows(spark, d):
    rows = _raw(spark, d).where(F.col("analysis_status") == "processing")
    return rows.agg(F.count(F.lit(1)).alias("stale"), F.count_if(is_stale(views.as_of())).alias("stale_processing"))


@query("f14_error_rows", RAWBASE + "select id from raw_posts where analysis_status in ('error', 'failed')")
def error_rows(spark, d):
    return _raw(spark, d).where(is_error()).select("id")


@query(
    "a16_processing_status",
    ctes(POSTS, RAW, INDICATORS) + f""", parts as (
  select 'raw_documents' as metric, count(*) as count, cast(null as timestamp) as time, cast(null as varchar) as text from raw_posts
  union all select 'unprocessed_documents', count(*) filter (where coalesce(analysis_status, 'pending') = 'pending'), null, null from raw_posts
  union all select 'processing_documents', count(*) filter (where analysis_status = 'processing'), null, null from raw_posts
  union all select 'stale_processing_documents', count(*) filter (where {STALE}), null, null from raw_posts
  union all select 'discarded_documents', count(*) filter (where analysis_status = 'discarded'), null, null from raw_posts
  union all select 'failed_documents', count(*) filter (where analysis_status = 'error'), null, null from raw_posts
  union all select 'last_harvest_at', null, max(harvested_at), null from raw_posts
  union all select 'processed_documents', count(*), null, null from posts
  union all select 'last_processed_at', null, max(processed_at), null from posts
  union all select 'last_processed_harvest_at', null, max(harvested_at), null from posts
  union all select 'official_indicators', count(*), null, null from indicators
  union all select 'latest_official_period', null, null, max(period) from indicators)
select metric, count, text, strftime(time, '%Y-%m-%d %H:%M:%S') as time,
  round_even((epoch_us(timestamp '{AS_OF}') - epoch_us(time)) / 6e7 * 100, 0) / 100 as lag_minutes from parts""",
)
def processing_status(spark, d):
    out = ST.processing_status(_raw(spark, d), views.posts(spark, d), views.indicators(spark, d), as_of=views.as_of())
    return _text_times(out, "time")


@query(
    "a16_source_status",
    RAWBASE + f"""select source_index, count(*) as document_count,
  count(*) filter (where coalesce(analysis_status, 'pending') = 'pending') as unprocessed_documents,
  count(*) filter (where analysis_status = 'processing') as processing_documents,
  count(*) filter (where {STALE}) as stale_processing_documents,
  count(*) filter (where analysis_status = 'discarded') as discarded_documents,
  count(*) filter (where analysis_status = 'error') as failed_documents,
  strftime(max(harvested_at), '%Y-%m-%d %H:%M:%S') as last_harvest_at from raw_posts group by 1""",
)
def source_status(spark, d):
    return _text_times(ST.source_status(_raw(spark, d), as_of=views.as_of()), "last_harvest_at")


@query(
    "a16_platform_freshness",
    RAWBASE + """select platform, strftime(max(created_at), '%Y-%m-%d %H:%M:%S') as last_created_at,
  strftime(max(harvested_at), '%Y-%m-%d %H:%M:%S') as last_harvest_at, strftime(max(processed_at), '%Y-%m-%d %H:%M:%S') as last_processed_at
  from posts group by 1""",
)
def platform_freshness(spark, d):
    return _text_times(
        ST.platform_freshness(views.posts(spark, d)), "last_created_at", "last_harvest_at", "last_processed_at"
    )


ERRORS = RAWBASE + """select strftime(harvested_at, '%Y-%m-%d %H:%M:%S') as timestamp, 'enrichment' as function_name, 'processing' as stage,
  analysis_status as status, 'processing_error' as error_type, id as raw_id, platform, source_index,
  cast(null as varchar) as source_es_id, cast(null as varchar) as url from raw_posts where analysis_status in ('error', 'failed')"""


@query("a17_error_logs", ERRORS + " order by harvested_at desc, id limit 500")
def error_logs(spark, d):
    return _text_times(ST.error_logs(_raw(spark, d), 500), "timestamp")


@query("a17_error_total", RAWBASE + "select count(*) as errors from raw_posts where analysis_status in ('error', 'failed')")
def error_total(spark, d):
    return ST.error_total(_raw(spark, d))


@query("p09_error_projection", ERRORS + " order by harvested_at desc, id limit 1")
def error_projection(spark, d):
    return _text_times(ST.error_logs(_raw(spark, d), 1), "timestamp")


@query("a20_status_histogram", RAWBASE + "select coalesce(analysis_status, 'pending') as status, count(*) as document_count from raw_posts group by 1")
def status_histogram(spark, d):
    return ST.status_histogram(_raw(spark, d))


@query("a23_pending_total", RAWBASE + f"select count(*) as pending from raw_posts where {PENDING}")
def pending_total(spark, d):
    return ST.pending_total(_raw(spark, d), as_of=views.as_of())


@query(
    "a23_requeue_errors",
    RAWBASE + """select case when analysis_status = 'error' then 'pending' else analysis_status end as analysis_status,
  analysis_started_at is null as not_started, count(*) as n from raw_posts group by 1, 2""",
)
def requeue_errors(spark, d):
    rows = ST.requeue_errors(_raw(spark, d))
    return rows.groupBy("analysis_status", F.col("analysis_started_at").isNull().alias("not_started")).agg(
        F.count(F.lit(1)).alias("n")
    )


@query(
    "a24_harvest_summary",
    RAWBASE + "select strftime(harvested_at, '%Y-%m-%d') as interval, count(*) as seen, count(*) filter (where platform = 'gdelt') as matched, true as first_run from raw_posts group by 1",
)
def harvest_summary(spark, d):
    return ST.harvest_summary(
        _raw(spark, d), F.col("platform") == "gdelt", F.date_format("harvested_at", "yyyy-MM-dd"), first_run=True
    )


# ------------------------------------------------------------------- profiles
@query(
    "a19_profile_summary",
    RAWBASE + """, f as (select unnest(['analysis_started_at', 'analysis_status', 'created_at', 'harvested_at', 'id', 'k', 'platform', 'source_index']) as c)
select 'rows' as item, count(*) as value, null as low, null as high from raw_posts
union all select 'field:' || c, row_number() over (order by c) - 1, null, null from f
union all select 'range:created_at', null, strftime(min(created_at), '%Y-%m-%d %H:%M:%S'), strftime(max(created_at), '%Y-%m-%d %H:%M:%S') from raw_posts
union all select 'range:harvested_at', null, strftime(min(harvested_at), '%Y-%m-%d %H:%M:%S'), strftime(max(harvested_at), '%Y-%m-%d %H:%M:%S') from raw_posts""",
)
def profile_summary(spark, d):
    return _text_times(PR.profile_summary(_raw(spark, d)), "low", "high")


TERMS = """, pairs as (select 'platform' as field, platform as value from raw_posts union all select 'analysis_status', analysis_status from raw_posts
  union all select 'source_index', source_index from raw_posts),
counted as (select field, value, count(*) as document_count from pairs where value is not null group by 1, 2)"""


@query("a19_top_terms", RAWBASE + TERMS + """ select field, value, document_count from
  (select *, row_number() over (partition by field order by document_count desc, value) as r from counted) where r <= 12""")
def top_terms(spark, d):
    return PR.top_terms(_raw(spark, d))


@query("w09_top_terms_per_field", RAWBASE + TERMS + """ select field, value, document_count from
  (select *, row_number() over (partition by field order by document_count desc, value) as r from counted) where r <= 2""")
def top_terms_per_field(spark, d):
    return PR.top_terms(_raw(spark, d), top_n=2)


@query(
    "p13_samples",
    "select doc_id, lang, case when length(text) > 220 then concat(left(text, 219), '...') else text end as text from documents order by doc_id limit 50",
)
def samples(spark, d):
    """A display report of fifty rows; shortening is its purpose."""
    return PR.samples(views.table(spark, d, "documents"), ["doc_id", "lang", "text"], 50, "doc_id")


@query(
    "a25_latency_summary",
    ctes(REQUESTS) + """, r as (select *, row_number() over (partition by route order by duration_ms) - 1 as i, count(*) over (partition by route) as n from requests)
select route, count(*) as count, count(*) filter (where status >= 400) as failure_count,
  round_even(sum(cast(round_even(duration_ms * 1e6, 0) as bigint)) / 1e6 / count(*) * 1000, 0) / 1000 as average_duration,
  round_even(max(duration_ms) filter (where i = cast(round_even((n - 1) * 0.95, 0) as bigint)) * 1000, 0) / 1000 as p95_duration,
  round_even(max(duration_ms) * 1000, 0) / 1000 as max_duration from r group by 1""",
)
def latency_summary(spark, d):
    return PR.latency_summary(views.requests(spark, d))


@query("a25_status_counts", ctes(REQUESTS) + "select route, cast(status as varchar) as status, count(*) as count from requests group by 1, 2")
def status_counts(spark, d):
    return PR.status_counts(views.requests(spark, d))


# -------------------------------------------------------- official comparison
CANDIDATES = {"housing": ("Rents", "Electricity"), "fuel": ("Automotive fuel", "Transport"), "energy": ("Electricity",),
              "cost_of_living": ("All groups CPI", "Electricity")}
OFFICIAL = ctes(POSTS, LABELS, INDICATORS) + f""", cand as (select * from (values ('housing', 0, 'Rents'), ('housing', 1, 'Electricity'),
  ('fuel', 0, 'Automotive fuel'), ('fuel', 1, 'Transport'), ('energy', 0, 'Electricity'),
  ('groceries', 0, 'All groups CPI'), ('groceries', 1, 'Electricity'), ('transport', 0, 'All groups CPI'), ('transport', 1, 'Electricity'))
  as c(cost_category, rank, item_name)),
pct as (select * from indicators where contains(lower(measure), 'percentage change from previous year')),
idx as (select * from indicators where contains(lower(measure), 'index numbers')),
pick_pct as (select cost_category, arg_min(item_name, rank) as item_name from cand where item_name in (select item_name from pct) group by 1),
pick_idx as (select cost_category, arg_min(item_name, rank) as item_name from cand where item_name in (select item_name from idx) group by 1),
m as (select strftime(created_at, '%Y-%m') as period, topic as cost_category, category_label, count(*) as complaint_count, count(*) as document_count,
  {r4("count(*) filter (where sentiment_label = 'negative') / count(*)")} as negative_ratio, {mean4()} as avg_sentiment
  from posts join labels_of on topic = cost_category group by 1, 2, 3)"""


@query(
    "a12_official_comparison",
    OFFICIAL + """ select m.*, pct.item_name as official_indicator, pct.measure as official_measure, pct.value as official_value, idx.value as official_index_value
  from m join pick_pct on m.cost_category = pick_pct.cost_category join pct on pct.item_name = pick_pct.item_name and pct.period = m.period
  left join pick_idx on m.cost_category = pick_idx.cost_category left join idx on idx.item_name = pick_idx.item_name and idx.period = m.period""",
)
def official_comparison(spark, d):
    return OF.official_comparison(views.posts(spark, d), views.indicators(spark, d), candidates=CANDIDATES)


@query(
    "a12_comparison_coverage",
    OFFICIAL + """ select min(pct.period) as official_period_min, max(pct.period) as official_period_max,
  min(m.period) as overlap_period_min, max(m.period) as overlap_period_max
  from pick_pct join pct using (item_name) left join m on m.cost_category = pick_pct.cost_category and m.period = pct.period""",
)
def comparison_coverage(spark, d):
    return OF.comparison_coverage(views.posts(spark, d), views.indicators(spark, d), candidates=CANDIDATES)


JOINED = OFFICIAL + """, o as (select m.period, m.cost_category, complaint_count, pct.value as official_value, idx.value as official_index_value
  from m join pick_pct on m.cost_category = pick_pct.cost_category join pct on pct.item_name = pick_pct.item_name and pct.period = m.period
  left join pick_idx on m.cost_category = pick_idx.cost_category left join idx on idx.item_name = pick_idx.item_name and idx.period = m.period)"""


def _comparison(spark, d):
    return OF.official_comparison(views.posts(spark, d), views.indicators(spark, d), candidates=CANDIDATES)


@query("j01_metrics_with_official", JOINED + " select period, cost_category, official_value from o")
def metrics_with_official(spark, d):
    return _comparison(spark, d).select("period", "cost_category", "official_value")


@query("j02_metrics_with_index", JOINED + " select period, cost_category, official_index_value from o")
def metrics_with_index(spark, d):
    return _comparison(spark, d).select("period", "cost_category", "official_index_value")


RANKED = OFFICIAL + " select cost_category, item_name from pick_pct where cost_category in (select topic from posts)"


def _picked(spark, d):
    topics = views.posts(spark, d).select(F.col("topic").alias("cost_category")).distinct()
    series = OF.series_of(views.indicators(spark, d), "Percentage change from previous year")
    picked = OF.selected_items(series, CANDIDATES)
    return topics.withColumn("list_name", OF.list_key(CANDIDATES)).join(picked, "list_name").drop("list_name")


query("j03_ranked_fallback", RANKED)(_picked)
query("w06_first_available", RANKED)(_picked)


@query(
    "a27_comparison_findings",
    JOINED + " select count(*) as comparison_rows, count(distinct cost_category) as categories, min(period) as first_period, max(period) as last_period from o",
)
def comparison_findings(spark, d):
    return _comparison(spark, d).agg(
        F.count(F.lit(1)).alias("comparison_rows"), F.count_distinct("cost_category").alias("categories"),
        F.min("period").alias("first_period"), F.max("period").alias("last_period"),
    )


@query(
    "w08_scaled_comparison",
    JOINED + f""" select period, cost_category, coalesce({r4("(official_value - min(official_value) over w) / nullif(max(official_value) over w - min(official_value) over w, 0)")}, 0) as scaled
  from o window w as (partition by cost_category)""",
)
def scaled_comparison(spark, d):
    rows = _comparison(spark, d).select("period", "cost_category", "official_value")
    return min_max_scaled(rows, "cost_category", "official_value", "scaled").drop("official_value")


@query(
    "a30_correlations",
    JOINED + """ select 'complaint_count' as left, 'official_value' as right, round(corr(complaint_count, official_value), 6) as correlation from o
  union all select 'complaint_count', 'official_index_value', round(corr(complaint_count, official_index_value), 6) from o
  union all select 'official_value', 'official_index_value', round(corr(official_value, official_index_value), 6) from o""",
)
def correlations(spark, d):
    out = PR.correlations(_comparison(spark, d), ["complaint_count", "official_value", "official_index_value"])
    return out.withColumn("correlation", F.round("correlation", 6))


@query(
    "f16_find_indicators",
    ctes(INDICATORS) + "select item_name, measure, period, value from indicators where contains(lower(item_name), 'fuel') order by period desc, item_name, measure limit 100",
)
def find(spark, d):
    return find_indicators(views.indicators(spark, d), indicator="monthly_cpi", item_name="Fuel", size=100).select(
        "item_name", "measure", "period", "value"
    )


@query("f17_measure_like", ctes(INDICATORS) + "select item_name, period, value from indicators where contains(lower(measure), 'percentage')")
def measure(spark, d):
    return views.indicators(spark, d).where(measure_like("PERCENTAGE")).select("item_name", "period", "value")


@query(
    "o05_series_order",
    ctes(INDICATORS) + "select item_name, period, row_number() over (partition by item_name order by period) as rank from indicators where measure = 'Index numbers'",
)
def series_order(spark, d):
    from pyspark.sql import Window

    series = OF.series_of(views.indicators(spark, d), "Index numbers")
    rank = F.row_number().over(Window.partitionBy("item_name").orderBy("period"))
    return series.select("item_name", "period", rank.cast("bigint").alias("rank"))


# ------------------------------------------------------------------ event logs
@query(
    "w10_window_positions",
    ctes(REQUESTS) + """, w as (select event_id, strftime(time_bucket(interval 1 hour, ts), '%Y-%m-%d %H:%M:%S') as window_start,
  row_number() over (partition by client, route, time_bucket(interval 1 hour, ts) order by ts, event_id) as position from requests)
select *, position <= 1 as allowed, greatest(1 - position, 0) as remaining from w""",
)
def window_positions(spark, d):
    rows = RO.window_positions(views.requests(spark, d), seconds=3600, limit=1)
    return _text_times(rows, "window_start").select("event_id", "window_start", "position", "allowed", "remaining")


LOGGED = ctes(LIFECYCLE) + ", logged as (select concat(run_id, '-', status) as event_id, * from lifecycle)"


@query("w11_recent_events", LOGGED + "select event_id, status from logged order by emitted_at desc, event_id limit 50")
def recent_events(spark, d):
    return RO.recent_events(views.lifecycle_events(spark, d), 50).select("event_id", "status")


@query(
    "r12_retention",
    LOGGED + "select event_id from logged where emitted_at > timestamp '2024-01-31 12:00:00' - interval 24 hours",
)
def retention(spark, d):
    as_of = F.lit("2024-01-31 12:00:00").cast("timestamp")
    return RO.retained_events(views.lifecycle_events(spark, d), as_of).select("event_id")


@query(
    "e42_json_with_poison",
    ctes(MESSAGES) + "select event_id, coalesce(kind, 'poison_message') as kind, attempts, case when kind is null then payload end as raw_payload from messages",
)
def json_with_poison(spark, d):
    return RO.decode_messages(views.messages(spark, d)).select("event_id", "kind", "attempts", "raw_payload")
