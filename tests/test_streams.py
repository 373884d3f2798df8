"""Streams over files that arrive out of order, twice, or after a restart."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.operators import metrics as M
from tidemark.sources import sinks as K
from tidemark.streaming import jobs as J

POSTS = """canonical_id string, raw_id string, id string, platform string, source_group string, topic string, created_at timestamp,
 harvested_at timestamp, processed_at timestamp, sentiment_label string, sentiment_score double, processing_status string, quality_flags array<string>"""


def _post(n: int, key: str | None, topic: str | None, month: int, score: float) -> tuple:
    at = dt.datetime(2025, month, 3)
    label = "negative" if score < 0 else "positive"
    return (key, None, None, "bluesky", "social", topic, at, at, at, label, score, "processed", [])


@pytest.fixture
def landed(spark, tmp_path):
    """Batches of posts; later files hold earlier months, and copies of documents seen before."""
    batches = [
        [_post(0, "a", "housing", 5, 0.5), _post(1, "b", "housing", 5, -0.25), _post(2, "a", "housing", 5, 0.5)],
        [_post(3, "a", "housing", 5, -0.5), _post(4, "c", None, 3, -0.75), _post(5, None, "energy", 3, 0.1)],
        [_post(6, "c", "unknown", 3, 0.25), _post(7, "d", "housing", 4, 0.5), _post(8, "b", "housing", 5, -1.0), _post(9, None, "energy", 3, 0.1)],
    ]
    path = str(tmp_path / "posts")

    def land(i: int) -> None:
        spark.createDataFrame(batches[i], POSTS).coalesce(1).write.mode("append").parquet(path)

    return path, land, lambda: spark.createDataFrame([row for rows in batches for row in rows], POSTS)


def _rows(df):
    return sorted(map(repr, df.select(*sorted(df.columns)).collect()))


def test_trend_of_files_out_of_order(spark, landed, tmp_path):
    """One run per file with one checkpoint gives the batch answer, distinct documents included."""
    path, land, everything = landed
    places = [str(tmp_path / n) for n in ("trend", "sightings", "checkpoint")]
    for i in range(3):
        land(i)
        J.topic_trend(J.file_stream(spark, path, POSTS, file_format="parquet"), *places)
    got, expected = J.trend_rows(spark, places[0]), M.sentiment_trend(everything())
    assert got.columns and set(got.columns) <= set(expected.columns)
    assert _rows(got) == _rows(expected.select(*got.columns))
    housing = {r["period"]: r for r in got.where("cost_category = 'housing'").collect()}
    assert (housing["2025-05"]["document_count"], housing["2025-05"]["unique_document_count"]) == (5, 2)


def test_a_batch_that_runs_again_adds_nothing(spark, tmp_path):
    path = str(tmp_path / "sums")
    rows = lambda *r: spark.createDataFrame(list(r), "period string, k string, n long, u long")
    add = lambda df, batch: J.add_measures(df, batch, path, keys=["period", "k"], measures=["n", "u"], partition="period")
    add(rows(("1", "a", 2, -5)), 0)
    for _ in range(3):
        add(rows(("1", "a", 3, -7), ("2", None, 1, 0)), 1)
    add(rows(("1", "a", 1, 20)), 2)
    got = {(r["k"], r["n"], r["u"]) for r in spark.read.parquet(path).collect()}
    assert got == {("a", 6, 8), (None, 1, 0)}


def test_recent_copies_are_dropped_by_state(spark, tmp_path):
    """Copies in one file, in the next one, and after a restart from the checkpoint never reach the sink."""
    path, checkpoint = str(tmp_path / "in"), str(tmp_path / "checkpoint")
    reached: list[list[str]] = []

    def run(ids: list[str]) -> None:
        spark.createDataFrame([(i,) for i in ids], "id string").coalesce(1).write.mode("append").parquet(path)
        stream = J.first_copies(J.file_stream(spark, path, "id string", file_format="parquet"))
        J.run_available(stream, lambda batch, _: reached.append(sorted(r["id"] for r in batch.collect())), checkpoint)

    run(["a", "b", "a"])
    run(["b", "c"])
    run(["a", "c", "d", "d"])
    assert [ids for ids in reached if ids] == [["a", "b"], ["c"], ["d"]]


def test_write_accounting_counts_copies_and_rejects(spark, tmp_path):
    path = str(tmp_path / "table")
    at = dt.datetime(2025, 1, 2)
    batch = K.with_month(spark.createDataFrame([("a", at), ("b", at), ("b", at)], "id string, created_at timestamp"))
    nameless = K.with_month(spark.createDataFrame([(None, at), (None, at), ("b", at), ("c", at)], "id string, created_at timestamp"))
    counts = lambda df: tuple(df.select("attempted", "written", "skipped", "rejected").first())
    assert counts(K.insert_if_absent(batch, path)) == (3, 2, 1, 0)
    assert counts(K.insert_if_absent(nameless, path, key_has_partition=True)) == (4, 1, 1, 2)
    assert counts(K.insert_if_absent(nameless, path)) == (4, 0, 2, 2)
    assert sorted(r["id"] for r in spark.read.parquet(path).collect()) == ["a", "b", "c"]
    K.upsert(nameless, path)
    assert spark.read.parquet(path).where(F.col("id").isNull()).count() == 0
    empty = batch.limit(0)
    assert counts(K.insert_if_absent(empty, path)) == (0, 0, 0, 0)


def test_lookups_read_only_the_batch_partitions(spark, tmp_path):
    path = str(tmp_path / "table")
    row = lambda i, month: (i, dt.datetime(2025, month, 1))
    schema = "id string, created_at timestamp"
    K.insert_if_absent(K.with_month(spark.createDataFrame([row("a", 1), row("b", 2)], schema)), path)
    # a file of another month that can't be read shows that it is not looked at
    (tmp_path / "table" / "created_month=2025-03").mkdir()
    (tmp_path / "table" / "created_month=2025-03" / "part-0.parquet").write_bytes(b"not parquet at all")
    late = K.with_month(spark.createDataFrame([row("a", 1), row("c", 2)], schema))
    out = K.insert_if_absent(late, path, key_has_partition=True).first()
    assert (out["written"], out["skipped"]) == (1, 1)
