"""Fixed schemas as DDL text. Readers always pass one; nothing is inferred."""

from __future__ import annotations

ENGAGEMENT = "struct<like_count:bigint,reply_count:bigint,repost_count:bigint,quote_count:bigint>"
PAYLOAD = "struct<source_index:string,source_es_id:string,source_fields:array<string>>"

RAW_STREAM = """
    _id string, platform string, stage string, source_id string, post_id string, category string,
    search_term string, api_query string, instance string, author_handle string,
    author_display_name string, text string, url string, created_at string, collected_at string,
    like_count string, reply_count string, repost_count string, quote_count string,
    domain string, gkg_file_id string, gkg_url string, tone string
"""

RAW_POSTS = f"""
    id string, platform string, stage string, source string, source_index string,
    source_es_id string, source_id string, category string, search_term string, api_query string,
    harvested_query string, instance string, author string, author_handle string,
    author_display_name string, location_hint string, text string, url string,
    created_at timestamp, collected_at timestamp, harvested_at timestamp,
    like_count bigint, reply_count bigint, repost_count bigint, quote_count bigint,
    has_engagement_metrics boolean, domain string, gkg_file_id string, gkg_url string,
    tone string, analysis_status string, analysis_started_at timestamp,
    analysis_processed_at timestamp, engagement {ENGAGEMENT}, payload {PAYLOAD}
"""

POSTS = """
    raw_id string, canonical_id string, source_index string, source_es_id string,
    platform string, source_group string, created_at timestamp, harvested_at timestamp,
    processed_at timestamp, text string, raw_text string, category string,
    harvest_category string, topic string, topic_source string, matched_keywords array<string>,
    sentiment_label string, sentiment_score double, model_name string, model_version string,
    processor_version string, processing_status string, like_count bigint, reply_count bigint,
    repost_count bigint, quote_count bigint, url string, relevance_score int,
    quality_flags array<string>
"""

INDICATORS = """
    id string, source string, dataflow string, indicator string, series_key string,
    measure_code string, measure string, item_code string, item_name string,
    adjustment_code string, adjustment string, region_code string, region string,
    frequency_code string, frequency string, period string, period_start timestamp, value double,
    unit_code string, unit string, created_at timestamp, harvested_at timestamp, notes string,
    raw_row map<string,string>
"""

MONTHLY_METRICS = """
    metric_id string, period string, period_start timestamp, source_group string, quality string,
    cost_category string, category_label string, document_count bigint,
    unique_document_count bigint, duplicate_ratio double, negative_count bigint,
    negative_ratio double, avg_sentiment double, generated_at timestamp
"""

SOCIAL_SEARCH = """
    category string, query string, collected_at string,
    post struct<uri:string,cid:string,
                record:struct<text:string,createdAt:string>,
                author:struct<handle:string,displayName:string>,
                likeCount:bigint,replyCount:bigint,repostCount:bigint,quoteCount:bigint>
"""

SOCIAL_STATUS = """
    category string, query string, collected_at string,
    status struct<id:string,uri:string,url:string,content:string,created_at:string,
                  account:struct<acct:string,username:string,display_name:string>,
                  favourites_count:bigint,replies_count:bigint,reblogs_count:bigint>
"""

TAXONOMY_CSV = "topic string, keywords string, example_question string"

LIFECYCLE_EVENTS = """
    event_id string, run_id string, job_name string, status string, emitted_at timestamp,
    duration_ms double, payload string, error string
"""
