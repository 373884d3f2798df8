"""Hand-computed cases for post queries, and invariants."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators import metrics as M
from tidemark.operators import official as OF
from tidemark.operators import routing as RO
from tidemark.operators import status as ST
from tidemark.operators.filters import PostFilter, filter_posts, find_indicators
from tidemark.operators.latest import last_per_key
from tidemark.operators.profile import nearest_rank
from tidemark.plans import views
from tidemark.registry import local_table

T = dt.datetime


@pytest.fixture(scope="module")
def posts(spark):
    schema = (
        "raw_id string, canonical_id string, platform string, source_group string, topic string, topic_source string, "
        "created_at timestamp, harvested_at timestamp, processed_at timestamp, sentiment_score double, "
        "sentiment_label string, processing_status string, quality_flags array<string>"
    )
    day = lambda m, d: T(2025, m, d)
    rows = [
        ("p1", "canonical-1", "gdelt", "media", "housing", "text_keywords", day(9, 15), day(9, 16), day(9, 17), -0.4, "negative", "processed", ["metadata_heavy"]),
        ("p2", "canonical-1", "bluesky", "social", "housing", "text_keywords", day(9, 20), day(9, 21), day(9, 22), -0.3, "negative", "processed", []),
        ("p3", "canonical-3", "mastodon", "social", "groceries", "harvest_category_fallback", day(10, 10), day(10, 11), day(10, 12), 0.2, "positive", "processed", None),
        ("p4", None, "mastodon", "social", "housing", None, day(9, 21), day(9, 21), None, None, None, "discarded", None),
    ]
    return spark.createDataFrame(rows, schema)


@pytest.fixture(scope="module")
def indicators(spark):
    schema = "id string, indicator string, measure string, item_name string, period string, period_start timestamp, value double"
    rows = [
        ("1", "monthly_cpi", "Percentage change from previous year", "Rents", "2025-09", T(2025, 9, 1), 6.2),
        ("2", "monthly_cpi", "Index numbers", "Rents", "2025-09", T(2025, 9, 1), 120.4),
    ]
    return spark.createDataFrame(rows, schema)


def by(df, key):
    return {r[key]: r for r in df.collect()}


def test_counts(posts):
    assert M.category_totals(posts).first()["total_complaints"] == 3
    row = by(M.category_counts(posts), "cost_category")["housing"]
    assert (row["document_count"], row["unique_document_count"], row["duplicate_ratio"]) == (2, 1, 0.5)
    assert row["category_label"] == "Housing / Rent"


def test_sentiment(posts):
    row = by(M.category_sentiment(posts), "cost_category")["housing"]
    assert (row["avg_sentiment"], row["negative_ratio"]) == (-0.35, 1.0)


def test_clean(posts):
    assert M.category_totals(posts, PostFilter(quality="clean")).first()["total_complaints"] == 2
    row = by(M.quality_comparison(posts), "cost_category")["housing"]
    assert (row["all_document_count"], row["clean_document_count"], row["excluded_document_count"]) == (2, 1, 1)
    pressure = M.duplicate_pressure(posts).first()
    assert (pressure["document_count"], pressure["unique_document_count"], pressure["duplicate_ratio"]) == (3, 2, 0.3333)
    assert by(M.flag_histogram(posts), "flag")["metadata_heavy"]["document_count"] == 1


def test_trends_and_shares(posts):
    trend = {(r["period"], r["cost_category"]): r for r in M.category_trend(posts).collect()}
    assert trend[("2025-09", "housing")]["document_count"] == 2
    media = M.media_coverage(posts, PostFilter()).collect()
    assert [(r["period"], r["coverage_count"]) for r in media] == [("2025-09", 1)]
    share = {(r["platform"], r["cost_category"]): r for r in M.platform_categories(posts).collect()}
    assert share[("bluesky", "housing")]["percentage_within_platform"] == 1.0


def test_gaps(posts):
    filled = M.fill_gaps(M.category_trend(posts), "2025-08", "2025-10", ["housing"]).collect()
    assert [(r["period"], r["document_count"]) for r in filled] == [("2025-08", 0), ("2025-09", 2), ("2025-10", 0)]


def test_official(posts, indicators):
    row = OF.official_comparison(posts, indicators).collect()
    assert [(r["cost_category"], r["official_indicator"], r["official_value"], r["official_index_value"]) for r in row] == [
        ("housing", "Rents", 6.2, 120.4)
    ]
    coverage = OF.comparison_coverage(posts, indicators).first()
    assert coverage["overlap_period_max"] == "2025-09"
    with pytest.raises(ValueError):
        OF.official_comparison(posts, indicators, period="day")
    assert find_indicators(indicators, item_name="RENT", size=1).count() == 1


def test_status(spark):
    rows = [
        ("r1", "gdelt_gkg_raw_full", "processed", None, T(2025, 9, 16)),
        ("r2", "mastodon_raw_stream", "pending", None, T(2025, 9, 17)),
        ("r3", "mastodon_raw_stream", "discarded", None, T(2025, 9, 18)),
        ("r4", "gdelt_gkg_raw_full", "processing", T(2025, 9, 19), T(2025, 9, 19)),
    ]
    raw = spark.createDataFrame(
        rows, "id string, source_index string, analysis_status string, analysis_started_at timestamp, harvested_at timestamp"
    ).withColumn("platform", F.lit(None).cast("string"))
    as_of = F.lit("2025-10-01").cast("timestamp")
    sources = by(ST.source_status(raw, as_of=as_of), "source_index")
    assert sources["mastodon_raw_stream"]["unprocessed_documents"] == 1
    assert sources["gdelt_gkg_raw_full"]["processing_documents"] == 1
    assert sources["gdelt_gkg_raw_full"]["stale_processing_documents"] == 1
    assert ST.pending_total(raw, as_of=as_of).first()["pending"] == 2


def test_bad_arguments():
    for bad in ({"source_group": "radio"}, {"time_field": "seen_at"}, {"quality": "best"}):
        with pytest.raises(ValueError):
            PostFilter(**bad)
    with pytest.raises(ValueError):
        M.category_trend(None, period="week")


def test_yoy_with_few_periods(posts):
    rows = by(M.yoy_change(posts), "cost_category")
    assert rows["housing"]["previous_period_count"] == 2 and rows["housing"]["yoy_growth"] == -1.0


def test_invariants(spark, small_dir):
    posts = views.posts(spark, small_dir)
    total = filter_posts(posts).count()
    assert filter_posts(posts, PostFilter(quality="clean")).count() <= total
    counts = M.category_counts(posts).agg(F.sum("document_count"), F.sum("percentage")).first()
    assert counts[0] == total and abs(counts[1] - 1) < 1e-3
    shares = M.category_share(posts).groupBy("period").agg(F.sum("percentage").alias("s")).agg(F.max(F.abs(F.col("s") - 1))).first()[0]
    assert shares < 2e-3
    assert M.category_counts(posts).where("unique_document_count > document_count").count() == 0
    approx = M.category_counts(posts, approx=True).collect()
    assert len(approx) == 5


# ------------------------------------------------------------------ hot groups
def test_hot_key_last_write(spark):
    """A third of all rows share one key: the result is whole and no window gathers the key."""
    rows = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id")).alias("key"), F.col("id").alias("version")
    )
    out = last_per_key(rows, ["key"], [F.col("version")])
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan
    assert out.count() == 20_001
    assert out.where("key = -1").first()["version"] == 29_997


def test_hot_group_positions_and_ranks(spark):
    rows = spark.range(9_000).select(
        F.col("id").alias("event_id"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("c"), (F.col("id") % 500).cast("string"))).alias("client"),
        F.lit("r").alias("route"),
        F.timestamp_seconds(F.lit(1_700_000_000) + F.pmod(F.col("id") * 7, F.lit(180))).alias("ts"),
        F.pmod(F.col("id") * 7919, F.lit(1009)).cast("double").alias("ms"),
    )
    got = {r["event_id"]: r["position"] for r in RO.window_positions(rows).collect()}
    brute: dict = {}
    for r in sorted(rows.collect(), key=lambda r: (r["ts"], r["event_id"])):
        slot = (r["client"], int(r["ts"].timestamp()) // 60)
        brute.setdefault(slot, []).append(r["event_id"])
    assert got == {e: i + 1 for events in brute.values() for i, e in enumerate(events)}

    ranked = {r["client"]: r["value"] for r in nearest_rank(rows, ["client"], "ms", 0.95).collect()}
    values: dict = {}
    for r in rows.collect():
        values.setdefault(r["client"], []).append(r["ms"])
    for client, v in values.items():
        assert ranked[client] == sorted(v)[round((len(v) - 1) * 0.95)]


def test_nearest_rank_large_group(spark):
    """More rows than the wide bracket serves."""
    rows = spark.range(1_200_000).select(F.lit("k").alias("k"), F.pmod(F.col("id") * 48271, F.lit(1_000_003)).cast("double").alias("v"))
    for fraction in (0.0, 0.5, 0.95, 1.0):
        got = nearest_rank(rows, ["k"], "v", fraction).first()["value"]
        want = rows.orderBy("v").offset(round(1_199_999 * fraction)).first()["v"]
        assert got == want


def test_nearest_rank_every_size(spark):
    """Groups of 1 to 260 rows, a hot key, a value that makes up most of a group, null keys and null values."""
    draw = random.Random(5)
    rows = [(f"g{n}", float(draw.randint(0, n))) for n in range(1, 261) for _ in range(n)]
    rows += [("hot", float(draw.randint(0, 5000))) for _ in range(20_000)]
    rows += [("tie", 7.0)] * 5000 + [("tie", float(i)) for i in range(300)]
    rows += [(None, 3.0), (None, 1.0), ("none", None), ("g5", None)]
    table = spark.createDataFrame(rows, "k string, v double").repartition(4)
    groups: dict = {}
    for k, v in rows:
        if v is not None:
            groups.setdefault(k, []).append(v)
    for fraction in (0.0, 0.5, 0.95, 1.0):
        got = {r["k"]: r["value"] for r in nearest_rank(table, ["k"], "v", fraction).collect()}
        assert got == {k: sorted(v)[round((len(v) - 1) * fraction)] for k, v in groups.items()}
    assert nearest_rank(table.limit(0), ["k"], "v", 0.5).count() == 0


def test_dimensions_are_joined_alike_at_every_size(spark):
    from tidemark import registry

    for rows in (2, 5000):
        table = registry.dimension(spark, {"a": list(range(rows))})
        assert "broadcast" not in table._jdf.queryExecution().analyzed().toString().lower()
        assert table.count() == rows
    assert local_table(spark, {"a": [1]}).count() == 1
