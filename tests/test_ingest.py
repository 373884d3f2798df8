"""Sources, sinks and routing on small files."""

from __future__ import annotations

import hashlib
import io
import json
import zipfile

from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.operators import routing as RO
from tidemark.registry import SOURCES, local_table
from tidemark.sources import archives as AR
from tidemark.sources import indicators as IN
from tidemark.sources import sinks as K
from tidemark.sources import store as ST
from tidemark.sources import streams as SR
from tidemark.streaming import jobs as J


def _zip(body: bytes) -> bytes:
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as archive:
        archive.writestr("x.csv", body)
        archive.writestr("second.csv", b"ignored\n")
    return out.getvalue()


def _record(**cells) -> bytes:
    fields = [""] * 27
    for i, v in {0: "rec-1", 3: "news.example.org", 4: "https://news.example.org/1", **{int(k[1:]): v for k, v in cells.items()}}.items():
        fields[i] = v
    return "\t".join(fields).encode()


def test_manifest_range_and_kinds(spark):
    lines = [
        "10 AAA http://x/20250101000000.gkg.csv.zip",
        "11 BBB http://x/20250101001500.gkg.csv.zip",
        "12 CCC http://x/20250101001500.export.CSV.zip",
        "13 DDD http://x/20250101003000.gkg.csv.zip extra",
        "",
    ]
    manifest = AR.parse_manifest(local_table(spark, {"value": lines}))
    start, end = (F.lit(t).cast("timestamp") for t in ("2025-01-01 00:00:00", "2025-01-01 00:15:00"))
    rows = AR.archives_between(manifest, start, end).collect()
    assert [(r["archive_id"], r["md5"], r["file_size"]) for r in rows] == [("20250101001500", "bbb", 11)]


def test_archive_files_end_to_end(spark, tmp_path):
    good = _zip(_record(_7="RENT", _8="rent increase", _9="Melbourne Australia") + b"\n" + b"bad \xff bytes\tx\n")
    (tmp_path / "20250101001500.gkg.csv.zip").write_bytes(good)
    (tmp_path / "20250101003000.gkg.csv.zip").write_bytes(_zip(_record(_7="x")))
    lines = [
        f"1 {hashlib.md5(good).hexdigest().upper()} http://x/20250101001500.gkg.csv.zip",
        f"1 {'0' * 32} http://x/20250101003000.gkg.csv.zip",
    ]
    manifest = AR.parse_manifest(local_table(spark, {"value": lines}))
    (tmp_path / "20250101004500.gkg.csv.zip").write_bytes(b"no zip at all")
    files = AR.read_archive_files(spark, str(tmp_path))
    verified = AR.verify_archives(manifest, files)
    assert [r["archive_id"] for r in AR.rejected(verified).collect()] == ["20250101003000"]
    unpacked = AR.archive_lines(files)
    assert AR.keep_verified(unpacked, manifest).count() == 2
    docs = AR.archive_documents(unpacked, manifest).collect()
    assert [(d["_id"], d["category"], d["search_term"]) for d in docs] == [("rec-1:housing", "housing", "rent increase australia")]
    assert "australia" in docs[0]["matched_terms"] and docs[0]["platform"] == "gdelt"
    unified = SR.unify(AR.archive_documents(unpacked, manifest), SOURCES[2]).first()
    assert unified["like_count"] is None and unified["created_at"].isoformat() == "2025-01-01T00:15:00"


def test_backfill_resumes(spark, tmp_path):
    landed = tmp_path / "landed"
    landed.mkdir()
    lines = []
    for i, stamp in enumerate(("20250101001500", "20250101003000")):
        body = _zip(_record(_0=f"rec-{i}", _7="rent food prices", _9="Melbourne"))
        (landed / f"{stamp}.gkg.csv.zip").write_bytes(body)
        lines.append(f"1 {hashlib.md5(body).hexdigest()} http://x/{stamp}.gkg.csv.zip")
    manifest = AR.parse_manifest(local_table(spark, {"value": lines}))
    files = AR.read_archive_files(spark, str(landed))
    table, done = str(tmp_path / "table"), str(tmp_path / "done")
    first = J.run_backfill(manifest, files, table, done).collect()
    assert sorted(r["documents"] for r in first) == [2, 2]
    assert J.run_backfill(manifest, files, table, done).count() == 0
    assert J.run_backfill(manifest, files, table, done, resume=False).count() == 2
    assert spark.read.parquet(table).count() == 4


def test_damaged_archive_is_rejected_and_stays_pending(spark, tmp_path):
    landed = tmp_path / "landed"
    landed.mkdir()
    body = bytearray(_zip(_record(_7="rent food prices", _9="Melbourne") * 50))
    body[60:70] = bytes(10)
    (landed / "20250101001500.gkg.csv.zip").write_bytes(body)
    empty = io.BytesIO()
    zipfile.ZipFile(empty, "w").close()
    (landed / "20250101003000.gkg.csv.zip").write_bytes(empty.getvalue())
    lines = [
        f"1 {hashlib.md5(body).hexdigest()} http://x/20250101001500.gkg.csv.zip",
        f"1 {hashlib.md5(empty.getvalue()).hexdigest()} http://x/20250101003000.gkg.csv.zip",
    ]
    manifest = AR.parse_manifest(local_table(spark, {"value": lines}))
    files = AR.read_archive_files(spark, str(landed))
    errors = {r["archive_id"]: r["error"] for r in AR.rejected(AR.verify_archives(manifest, files)).collect()}
    assert sorted(errors) == ["20250101001500", "20250101003000"] and errors["20250101003000"] == "no member"
    assert AR.archive_lines(files).count() == 0
    table, done = str(tmp_path / "table"), str(tmp_path / "done")
    assert J.run_backfill(manifest, files, table, done).count() == 0


def test_copies_meet_one_result(spark):
    raw = spark.range(8).selectExpr("'a' as id", "'pending' as analysis_status")
    results = spark.range(8).selectExpr("'a' as id", "'processed' as status", "timestamp_seconds(id) as processed_at")
    rows = K.with_results(raw, results).collect()
    assert len(rows) == 8 and {r["analysis_status"] for r in rows} == {"processed"}


def test_upsert_takes_map_columns(spark, tmp_path):
    path = str(tmp_path / "maps")
    for version in ("1", "2"):
        rows = spark.range(3).selectExpr("cast(id as string) as id", f"map('v', '{version}') as raw_row", f"'2025-01' as {K.MONTH}")
        K.upsert(rows.union(rows), path)
    assert [r["raw_row"] for r in spark.read.parquet(path).collect()] == [{"v": "2"}] * 3


def test_attempts_may_be_text(spark):
    payloads = ['{"kind": "k", "attempts": "2"}', '{"kind": "k", "attempts": 2.0}', '{"kind": "k", "attempts": "many"}', '{"kind": "k", "attempts": 1e99}']
    rows = RO.decode_messages(local_table(spark, {"payload": payloads})).collect()
    assert [(r["kind"], r["attempts"]) for r in rows] == [("k", 2), ("k", 2), ("k", 0), ("k", 0)]


def test_indicator_csv(spark, tmp_path):
    header = "DATAFLOW,MEASURE: Measure,INDEX: Index,TSEST: Adjustment Type,REGION: Region,FREQ: Frequency,TIME_PERIOD,OBS_VALUE,UNIT_MEASURE: Unit of Measure"
    rows = [
        "CPI,1: Index numbers,10001: All groups CPI,10: Original,50: Australia,M: Monthly,2026-03,104.2,",
        "CPI,1: Index numbers,10001: All groups CPI,10: Original,50: Australia,M: Monthly,2026-04,,",
        "CPI,1: Index numbers,10001: All groups CPI,10: Original,50: Australia,Q: Quarterly,2026-Q2,105.5,",
    ]
    (tmp_path / "cpi.csv").write_text("\n".join([header, *rows]) + "\n")
    out = {r["period"]: r for r in IN.parse_indicators(IN.read_labelled_csv(spark, str(tmp_path))).collect()}
    assert set(out) == {"2026-03", "2026-Q2"}
    r = out["2026-03"]
    assert (r["measure_code"], r["item_name"], r["region"], r["frequency_code"], r["value"]) == ("1", "All groups CPI", "Australia", "M", 104.2)
    assert r["series_key"] == "1.10001.10.50.M" and r["unit"] == "" and r["raw_row"]["TIME_PERIOD"] == "2026-03"
    assert r["id"] == "abs-cpi-" + hashlib.sha1(b"abs-cpi|CPI|1|10001|10|50|M|2026-03").hexdigest()
    assert out["2026-Q2"]["period_start"].isoformat() == "2026-04-01T00:00:00"


def test_json_array_file(spark, tmp_path):
    (tmp_path / "posts.json").write_text(json.dumps([{"raw_id": "a", "quality_flags": ["x"]}, {"raw_id": "b"}], indent=1))
    rows = ST.read_json_store(spark, str(tmp_path), schemas.POSTS, whole_file=True).collect()
    assert [(r["raw_id"], r["quality_flags"]) for r in rows] == [("a", ["x"]), ("b", None)]


def test_unify_identity_and_defaults(spark):
    rows = local_table(
        spark,
        {
            "_id": ["1", "2", "", ""], "platform": ["", "gdelt_gkg", None, None], "source_id": ["s1", "", "s3", ""],
            "text": [" a  b ", "c", "d", "e"], "like_count": ["7", "7", "x", "1"], "category": ["food", "", None, None],
            "search_term": ["q", None, None, None], "created_at": ["2025-01-01T00:00:00Z", "", "nope", None],
        },
    )
    out = {r["source_es_id"]: r for r in SR.unify(rows, SOURCES[0], imported_at=F.lit("2026-01-01").cast("timestamp")).collect()}
    assert set(out) == {"1", "2", "s3"}
    assert out["1"]["id"] == "unified-" + hashlib.sha1(b"bluesky_raw_stream|1").hexdigest()
    assert (out["1"]["platform"], out["1"]["text"], out["1"]["like_count"], out["1"]["harvested_query"]) == ("bluesky", "a b", 7, "food | q")
    assert (out["2"]["platform"], out["2"]["like_count"], out["2"]["source_id"]) == ("gdelt", None, "2")
    assert out["s3"]["like_count"] == 0 and out["s3"]["created_at"].year == 2026


def _batch(spark, ids, month, version):
    df = local_table(spark, {"id": ids, "version": [version] * len(ids)})
    return df.withColumn("harvested_at", F.timestamp_seconds(F.lit(1_700_000_000 + version))).withColumn(K.MONTH, F.lit(month))


def test_insert_if_absent_is_idempotent(spark, tmp_path):
    path = str(tmp_path / "t")
    a = K.insert_if_absent(_batch(spark, ["a", "b", "b"], "2025-01", 1), path).first()
    b = K.insert_if_absent(_batch(spark, ["b", "c"], "2025-02", 2), path).first()
    c = K.insert_if_absent(_batch(spark, ["b", "c"], "2025-02", 3), path).first()
    assert [(r["attempted"], r["written"]) for r in (a, b, c)] == [(3, 2), (2, 1), (2, 0)]
    assert {r["id"]: r["version"] for r in spark.read.parquet(path).collect()} == {"a": 1, "b": 1, "c": 2}


def test_upsert_moves_rows_and_drops_empty_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    K.upsert(_batch(spark, ["a"], "2025-01", 1), path)
    K.upsert(_batch(spark, ["b"], "2025-02", 1), path)
    K.upsert(_batch(spark, ["a", "c"], "2025-03", 2), path)
    rows = {r["id"]: (r["version"], str(r[K.MONTH])) for r in spark.read.parquet(path).collect()}
    assert rows == {"a": (2, "2025-03"), "b": (1, "2025-02"), "c": (2, "2025-03")}
    assert not (tmp_path / "t" / "created_month=2025-01").exists()
    K.upsert(_batch(spark, ["a"], "2025-01", 1), path)  # an older version does not win
    assert {r["id"]: r["version"] for r in spark.read.parquet(path).collect()} == {"a": 2, "b": 1, "c": 2}


def test_routing(spark):
    payloads = [
        '{"message_id": "1", "kind": "nlp_batch", "attempts": 0}',
        '{"message_id": "2", "kind": "nlp_batch", "attempts": 2}',
        '{"message_id": "3", "kind": "other"}',
        "not json " + "x" * 3000,
        "[1, 2]",
        None,
    ]
    df = local_table(spark, {"payload": payloads, "failed": [True, True, False, False, False, False]})
    out = RO.route_messages(RO.decode_messages(df), F.col("failed")).collect()
    assert [(r["route"], r["next_attempts"], r["reason"]) for r in out] == [
        ("retry", 1, None),
        ("dead_letter", 3, "max_attempts_exceeded"),
        ("dead_letter", 0, "poison_message"),
        ("dead_letter", 0, "poison_message"),
        ("dead_letter", 0, "poison_message"),
        ("dead_letter", 0, "poison_message"),
    ]
    assert len(out[3]["raw_payload"]) == 3009


def test_late_requests_are_counted(spark, tmp_path):
    """Files out of order, days behind what was read before; the last batch written again changes nothing."""
    path, table, checkpoint = (str(tmp_path / n) for n in ("files", "table", "checkpoint"))
    schema = "client string, route string, ts timestamp"
    parts = [
        [("a", "x", "2024-01-09 10:00:05")] * 3 + [("b", "x", "2024-01-09 10:00:59")],
        [("a", "x", "2024-01-01 10:00:05"), ("a", "x", "2024-01-09 10:00:06"), ("b", "y", "2023-12-31 23:59:59")],
        [("a", "x", "2024-01-01 10:00:06"), (None, "x", "2024-01-01 10:00:06"), ("", "x", "2024-01-01 10:00:06"),
         ("c|d", "e", "2024-01-01 10:00:06"), ("c", "d|e", "2024-01-01 10:00:06"), ("a", None, "2024-01-05 00:00:00")],
    ]
    frames = [spark.createDataFrame(p, "client string, route string, t string").select("client", "route", F.col("t").cast("timestamp").alias("ts")) for p in parts]
    counts = lambda: sorted(map(repr, spark.read.parquet(table).select(
        "client", "route", F.date_format("window_start", "yyyy-MM-dd HH:mm").alias("w"), "requests", "over_limit").collect()))
    for frame in frames:
        frame.coalesce(1).write.mode("append").parquet(path)
        J.count_windows(J.file_stream(spark, path, schema, file_format="parquet"), table, checkpoint, limit=3)
    expected = spark.createDataFrame([r for p in parts for r in p], "client string, route string, t string").groupBy(
        "client", "route", F.substring("t", 1, 16).alias("w")).agg(F.count("*").alias("requests")).withColumn("over_limit", F.col("requests") > 3)
    want = sorted(map(repr, expected.collect()))
    assert counts() == want
    J.add_window_counts(frames[-1], 2, table, limit=3)  # the batch id of the third run
    assert counts() == want
