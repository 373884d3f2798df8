"""Plan shape: push-down, pruning, single scans, no shuffle in enrichment."""

from __future__ import annotations

import pytest

from tidemark.functions import sentiment as SE
from tidemark import vocabulary as V
from tidemark.operators import metrics as M
from tidemark.operators.enrich import enrich
from tidemark.operators.filters import PostFilter, filter_posts
from tidemark.plans import views
from tidemark.sources import sinks as K
from tidemark.sources import store as ST


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module", autouse=True)
def whole_plan_text(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", "100000")


@pytest.fixture(scope="module")
def stored_posts(spark, small_dir, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("posts") / "posts")
    K.replace_table(K.with_month(views.posts(spark, small_dir)), path)
    return path


def test_filters_and_columns_reach_the_scan(spark, stored_posts):
    f = PostFilter(platform="bluesky,gdelt", start="1997-01-01", end="1997-06-30")
    text = plan(M.category_sentiment(spark.read.parquet(stored_posts), f))
    assert "In(platform, [bluesky,gdelt])" in text
    assert "GreaterThanOrEqual(created_at" in text and "LessThan(created_at" in text
    scan = next(line for line in text.splitlines() if "FileScan" in line)
    assert "created_month#" in scan.split("PartitionFilters:")[1].split("PushedFilters")[0]
    schema = scan.split("ReadSchema:")[1]
    assert "canonical_id" not in schema and "raw_id" not in schema and "sentiment_score" in schema


def test_month_partitions_are_pruned(spark, stored_posts):
    df = ST.read_table(spark, stored_posts, partition="created_month", values=["1997-01"])
    assert "created_month" in plan(df).split("PartitionFilters:")[1].split("PushedFilters")[0]
    assert df.count() > 0


def test_counts_shuffle_after_partial_aggregation(spark, stored_posts):
    text = plan(M.category_sentiment(spark.read.parquet(stored_posts)))
    assert text.index("partial_count") > text.index("Exchange hashpartitioning")  # below it in the tree
    assert text.count("FileScan") == 1


def test_partition_filter_keeps_the_edges(spark, stored_posts):
    stored = spark.read.parquet(stored_posts)
    for start, end in (("1997-01-15", "1997-03-31"), ("1997-02-01T05:00:00+10:00", "1997-03-31T20:00:00-10:00")):
        f = PostFilter(start=start, end=end)
        with_month = filter_posts(stored, f).count()
        assert with_month == filter_posts(stored.drop("created_month"), f).count() > 0


def test_official_comparison_scans_posts_once(spark, stored_posts, small_dir):
    from tidemark.operators.official import comparison_coverage, official_comparison

    posts = spark.read.parquet(stored_posts)
    for operator in (official_comparison, comparison_coverage):
        text = plan(operator(posts, views.indicators(spark, small_dir)))
        assert sum("FileScan" in line and "processing_status" in line for line in text.splitlines()) == 1


def test_enrichment_has_no_shuffle(spark, stored_posts, small_dir):
    raw = views.text_posts(spark, small_dir).repartition(2)  # what lies below the marker is the source's own
    text = plan(enrich(raw, SE.lexicon_scorer(V.STARTER_LEXICON)))
    above = text[: text.index("REPARTITION_BY_NUM")]
    assert "SortMergeJoin" not in above and "HashJoin" not in above and above.count("Exchange") <= 1
    assert "EvalPython" not in text
