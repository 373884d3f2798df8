"""Findings of the third round."""

from __future__ import annotations

import hashlib
import io
import zipfile

import pyarrow as pa
from pyspark.sql import functions as F

from tidemark import vocabulary as V
from tidemark.functions.labels import news_categories
from tidemark.functions.matching import WordMatcher
from tidemark.functions.sentiment import lexicon_scorer
from tidemark.plans import stream_queries
from tidemark.sources import archives as AR


def test_a_text_is_scored_once(spark):
    """F1: the score read its total seven times, and each time all words were walked again."""
    df = spark.createDataFrame([("not good!",), ("bad",), ("",), (None,)], "t string").repartition(1)
    scored = df.select("t", lexicon_scorer(V.STARTER_LEXICON)(F.col("t")).alias("s"))
    assert scored._jdf.queryExecution().optimizedPlan().toString().count("without doubt") == 1
    scores = {r["t"]: r["s"] for r in scored.collect()}
    assert scores["not good!"] < 0 and scores["bad"] < 0 and scores[""] == scores[None] == 0


def test_each_streamed_batch_has_work_for_all_cores(spark):
    """a batch held files for half of the cores only."""
    from tidemark.plans.stream_queries import _landed
    from tidemark.session import scratch_dir
    from tidemark.streaming import jobs as J

    files, rows = [], []

    def body(batch, _):
        files.append(batch.select(F.input_file_name()).distinct().count())
        rows.append(batch.count())

    _, stream = _landed(spark, spark.range(10_000), "files-per-batch")
    J.run_available(stream, body, scratch_dir(spark, "files-per-batch-checkpoint"))
    assert files == [spark.sparkContext.defaultParallelism] * 2
    assert sum(rows) == 10_000


def test_python_batches_of_large_values_are_small(spark):
    """F5, F6, F8, F10, F13, F14: batches of archives grew with the input up to 64 MB."""
    import pandas as pd

    def sizes(batches):
        for batch in batches:
            yield pd.DataFrame({"n": [batch["v"].map(len).sum()]})

    rows = spark.range(48).repartition(1).select(F.repeat(F.lit("x"), F.lit(1 << 20)).alias("v"))
    held = [r["n"] for r in rows.mapInPandas(sizes, "n bigint").collect()]
    assert sum(held) == 48 << 20 and max(held) <= 8 << 20


def test_strict_social_searches_a_text_once(spark):
    """each text was tokenised and searched a second time for its local context, also where its row passes anyway."""
    from tidemark.operators.filters import keep_social

    texts = ["My rent increase in Melbourne is too expensive", "My rent increase is too expensive", "Nothing to see here", None]
    rows = spark.createDataFrame([(p, t) for p in ("bluesky", "gdelt", None) for t in texts], "platform string, text string")
    kept = keep_social(rows.withColumn("harvested_query", F.lit("")), strict=True)
    assert kept.columns == ["platform", "text", "harvested_query"]
    plan = kept._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Generate inline(array(struct(_r_tok") == 1 and "_k_tok" not in plan
    assert {(r["platform"], r["text"]) for r in kept.collect()} == {("bluesky", texts[0])} | {(p, t) for p in ("gdelt", None) for t in texts}


def test_an_upsert_without_news_rewrites_nothing(spark, tmp_path):
    """a batch that was stored already was merged and its partitions written again."""
    from tidemark.sources import sinks as K

    def files():
        return sorted(str(p) for p in (tmp_path / "t").rglob("*.parquet"))

    def rows():
        return sorted(map(tuple, spark.read.parquet(path).select("id", "v", "created_month").collect()), key=str)

    path, schema = str(tmp_path / "t"), "id string, v int, created_month string"
    batch = spark.createDataFrame([("a", 1, "2024-01"), ("b", None, "2024-01"), ("c", 3, "none")], schema)
    K.upsert(batch, path)
    first = files()
    K.upsert(batch, path)
    assert files() == first
    news = spark.createDataFrame([("a", 1, "2024-01"), ("b", 5, "2024-02")], schema)
    K.upsert(news, path)
    assert rows() == [("a", 1, "2024-01"), ("b", 5, "2024-02"), ("c", 3, "none")]
    batch.where("id = 'a'").write.mode("append").partitionBy("created_month").parquet(path)  # a copy from elsewhere
    K.upsert(news, path)
    assert rows() == [("a", 1, "2024-01"), ("b", 5, "2024-02"), ("c", 3, "none")]


def _zipped(body):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as archive:
        archive.writestr("a.csv", body)
    return out.getvalue()


def test_lines_of_small_archives_share_a_batch():
    """each archive made batches of its own."""
    files = [(str(i), _zipped(f"a{i}\nb\r\n" if i % 7 else "")) for i in range(100)] + [("bad", b"no zip"), ("long", _zipped("x\n" * 4_500)), ("null", None)]
    batch = pa.RecordBatch.from_arrays([pa.array([f[0] for f in files]), pa.array([f[1] for f in files], pa.binary())], names=["archive_id", "content"])
    made = list(AR._unzip(iter([batch])))
    rows = [tuple(r.values()) for b in made for r in b.to_pylist()]
    expected = [(i, hashlib.md5(c).hexdigest(), n, line) for i, c in files if c and i != "bad"
                for n, line in enumerate(zipfile.ZipFile(io.BytesIO(c)).read("a.csv").decode().split(), 1)]
    assert rows == expected
    assert len(made) == 3 and max(b.num_rows for b in made) == AR.LINES_PER_BATCH


def test_the_manifest_of_a_stream_is_stored(spark, small_dir):
    """every batch read all archives twice more for their checksums."""
    _, _, manifest = stream_queries._landed_archives(spark, small_dir)
    assert "md5(" not in manifest._jdf.queryExecution().optimizedPlan().toString()
    assert manifest.count() > 0


def test_texts_without_a_cost_and_a_local_term_are_not_cut_into_words(spark):
    """all texts were; those with both terms give the rows they gave."""
    texts = ["COST of  Living in Sydney rent", "cost-of-living, melbourne: housing rent", "Wages of vice and afforded rents", "rent in Sydney", "price of rent in WA",
             "price hike for  electricity\x0bbill in NSW, fuel and rent", "priceless rent, sydneyside", ""]
    lines = spark.createDataFrame([("20250101000000", "m", i, "\t".join([str(i), *[""] * 22, t, "", "", ""])) for i, t in enumerate(texts)], AR.ARCHIVE_LINES)
    manifest = spark.createDataFrame([("20250101000000", "m", "u")], "archive_id string, md5 string, url string")
    documents = AR.archive_documents(lines, manifest)
    rows, matcher = WordMatcher.attach(lines.select(AR.search_text(F.split("line", "\t")).alias("t"), "sequence"), F.col("t"))
    plain = rows.select(F.col("sequence").cast("string").alias("id"), F.inline(news_categories(matcher)))
    found = sorted(map(tuple, documents.select("source_id", "category", "matched_terms").collect()))
    assert found == sorted(map(tuple, plain.collect())) and {f[0] for f in found} >= {"0", "1", "4"}
    assert "Filter (exists" in documents._jdf.queryExecution().optimizedPlan().toString()
