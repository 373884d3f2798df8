"""Findings of the fourth round."""

from __future__ import annotations

import time

from pyspark.sql import functions as F

from tidemark.plans import stream_queries
from tidemark.session import scratch_dir, shuffles_dropped
from tidemark.sources import sinks as K

SCHEMA = "id string, v int, created_month string"


def _rows(spark, path):
    return sorted(map(tuple, spark.read.parquet(path).select("id", "v", F.col("created_month").cast("string")).collect()), key=str)


def _files(path):
    return {str(p) for p in path.rglob("*.parquet")}


def test_new_keys_leave_stored_files_alone(spark, tmp_path):
    """each batch wrote all months that it had rows of again, with the texts of all batches before it."""
    path = tmp_path / "t"
    upsert = lambda *rows: K.upsert(spark.createDataFrame(list(rows), SCHEMA), str(path))
    upsert(("a", 1, "2024-01"), ("b", 1, "2024-02"), ("c", 1, "2024-03"))
    first = _files(path)
    upsert(("d", 1, "2024-01"), ("e", 1, "2024-02"), ("e", 1, "2024-02"))
    assert first < _files(path)
    second = _files(path)
    # one changed row that stays, one that moves, new rows beside them and elsewhere, copies, and a row without a key
    upsert(("a", 2, "2024-01"), ("c", 2, "2024-04"), ("f", 1, "2024-01"), ("g", 1, "2024-02"), ("g", 1, "2024-02"), ("b", 1, "2024-02"), (None, 1, "2024-02"))
    kept = {f for f in second if "created_month=2024-02" in f}
    assert len(kept) == 2 and kept < _files(path) and not any(f in _files(path) for f in second - kept)
    assert _rows(spark, str(path)) == [("a", 2, "2024-01"), ("b", 1, "2024-02"), ("c", 2, "2024-04"), ("d", 1, "2024-01"),
                                       ("e", 1, "2024-02"), ("f", 1, "2024-01"), ("g", 1, "2024-02")]
    assert [p.name for p in tmp_path.iterdir()] == ["t"]


def test_tables_and_landed_files_are_stored_small(spark, tmp_path):
    """texts were stored four times in the default codec, which by itself is as much as the disk limit."""
    path = str(tmp_path / "t")
    K.insert_if_absent(spark.createDataFrame([("a", 1, "2024-01")], SCHEMA), path)
    landed, _ = stream_queries._landed(spark, spark.range(10), "landed-small")
    for place in (path, landed):
        names = [r[0] for r in spark.read.parquet(place).select(F.input_file_name()).collect()]
        assert names and all(".zstd." in name for name in names)


def test_shuffle_files_go_with_their_command(spark, tmp_path):
    """they stayed until the driver collected its garbage, those of all batches beside each other."""
    blocks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffled():
        files = blocks.getAllFiles()
        return {n for i in range(files.size()) if (n := files.apply(i).getName()).endswith(".data") and n.startswith("shuffle_")}

    before = shuffled()
    with shuffles_dropped(spark):
        spark.range(100_000).repartition(4).write.parquet(str(tmp_path / "out"))
    for _ in range(50):
        if not shuffled() - before:
            break
        time.sleep(0.2)
    assert not shuffled() - before
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"
    assert spark.read.parquet(str(tmp_path / "out")).count() == 100_000


def test_rows_are_gathered_by_key_only_where_a_key_comes_again(spark, tmp_path):
    """every row was, with its text, to look for copies, for its result and for stored keys."""
    rows = spark.range(1000).select(F.col("id").cast("string").alias("id"), F.lit("pending").alias("analysis_status"))
    again = spark.range(3).select(F.col("id").cast("string").alias("id"))
    likely, other = K.told_apart(rows, again, "id")
    assert {"0", "1", "2"} <= {r["id"] for r in likely.collect()} and likely.count() + other.count() == 1000 and likely.count() < 50
    assert "hashpartitioning(id" not in other._jdf.queryExecution().executedPlan().toString()
    # integer keys of other widths have other hashes
    assert K.told_apart(spark.range(3), spark.range(3).selectExpr("cast(id as int) as id"), "id")[1].count() == 0

    raw = spark.createDataFrame([("a", "x", 1), ("b", "y", 1), ("b", "z", 2), (None, "y", 3)], "id string, status string, at int")
    raw = raw.select("id", F.lit("pending").alias("analysis_status"), F.col("status").alias("_status"), F.timestamp_seconds("at").alias("_at"))
    results = raw.select("id", F.col("_status").alias("status"), F.col("_at").alias("processed_at"))
    joined = K.with_results(raw.drop("_status", "_at"), results)
    stamped = K.with_results(raw, results, own=("_status", "_at"))
    assert sorted(map(str, joined.collect())) == sorted(map(str, stamped.select(*joined.columns).collect()))
    assert sorted(r["analysis_status"] for r in stamped.collect()) == ["pending", "x", "z", "z"]


def test_insert_meets_copies_and_stored_keys(spark, tmp_path):
    path = str(tmp_path / "t")
    insert = lambda *rows: K.insert_if_absent(spark.createDataFrame(list(rows), SCHEMA), path).first().asDict()
    insert(("a", 1, "2024-01"), ("b", 1, "2024-02"))
    counts = insert(("b", 2, "2024-03"), ("c", 1, "2024-01"), ("d", 1, "2024-01"), ("d", 1, "2024-01"), (None, 1, "none"), ("a", 1, "2024-01"), ("a", 3, "2024-01"))
    assert counts == {"attempted": 7, "written": 2, "rejected": 1, "skipped": 4}
    assert _rows(spark, path) == [("a", 1, "2024-01"), ("b", 1, "2024-02"), ("c", 1, "2024-01"), ("d", 1, "2024-01")]


def test_copies_in_a_stream_are_stored_once(spark):
    """Raw rows that come twice in one batch and again in the next give one raw row and one post."""
    from tidemark import vocabulary as V
    from tidemark.functions.sentiment import lexicon_scorer
    from tidemark.registry import SOURCES
    from tidemark.streaming import jobs as J

    source, checkpoint = scratch_dir(spark, "twice-files"), scratch_dir(spark, "twice-checkpoint")
    raw, posts = scratch_dir(spark, "twice-raw"), scratch_dir(spark, "twice-posts")
    schema = "_id string, text string, created_at string, category string"
    at = "2025-01-02T00:00:00Z"
    rows = [("1", "My rent increase in Melbourne is too expensive", at, "fuel"), ("1", "My rent increase in Melbourne is too expensive", at, "fuel"),
            ("2", "Petrol prices are outrageous", at, None), ("3", "x", "2025-03-01T00:00:00Z", None)]
    found = []
    for batch in (rows, rows[:3] + [("4", "Groceries keep going up", at, None)]):
        spark.createDataFrame(batch, schema).coalesce(1).write.mode("append").parquet(source)
        J.enrich_stream(J.file_stream(spark, source, schema, file_format="parquet"), SOURCES[0], raw, posts, checkpoint,
                        lexicon_scorer(V.STARTER_LEXICON), processed_at=F.timestamp_seconds(F.lit(1_700_000_000)),
                        imported_at=F.timestamp_seconds(F.lit(1_600_000_000)))
        stored = spark.read.parquet(raw).collect()
        statuses = {r["id"]: r["analysis_status"] for r in stored}
        assert len(statuses) == len(stored) and all(r["analysis_processed_at"] for r in stored)
        enriched = spark.read.parquet(posts).collect()
        assert sorted((r["raw_id"], r["processing_status"]) for r in enriched) == sorted(statuses.items())
        assert {r["source_es_id"]: r["text"] for r in stored} == {r["source_es_id"]: r["raw_text"] for r in enriched}
        found.append(len(stored))
    assert found == [3, 4]
