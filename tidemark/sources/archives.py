"""News archives: manifest lines, zipped tab-separated members, documents."""

from __future__ import annotations

import hashlib
import io
import struct
import zipfile
import zlib
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from tidemark import vocabulary as V
from tidemark.functions import strings as S
from tidemark.functions import times
from tidemark.functions.labels import best_phrase, news_categories
from tidemark.functions.matching import WordMatcher, contains_term
from tidemark.functions.staging import staged

LINES_PER_BATCH, CHARACTERS_PER_BATCH = 2_000, 2_000_000
ARCHIVE_LINES = "archive_id string, actual_md5 string, sequence bigint, line string"


def parse_manifest(lines: DataFrame, column: str = "value") -> DataFrame:
    """`size md5 url` lines to (archive_id, archive_time, file_size, md5, url); other lines are dropped."""
    parts = lines.select(F.split(F.trim(column), r"\s+").alias("p")).where(F.size("p") == 3)
    rows = parts.select(
        F.col("p")[0].try_cast("bigint").alias("file_size"),
        F.lower(F.col("p")[1]).alias("md5"),
        F.col("p")[2].alias("url"),
        F.regexp_extract(F.col("p")[2], r"/(\d{14})\.gkg\.csv\.zip$", 1).alias("archive_id"),
    )
    return rows.where(F.col("archive_id") != "").select(
        "archive_id", times.stamp_time(F.col("archive_id")).alias("archive_time"), "file_size", "md5", "url"
    )


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    return parse_manifest(spark.read.text(path))


def archives_between(manifest: DataFrame, start: Column, end: Column) -> DataFrame:
    """Archives in the half-open interval (start, end]."""
    return manifest.where((F.col("archive_time") > start) & (F.col("archive_time") <= end))


def remaining_archives(manifest: DataFrame, completed: DataFrame) -> DataFrame:
    """Archives not yet completed (resume point of a backfill)."""
    return manifest.join(completed.select("archive_id").distinct(), "archive_id", "left_anti")


def read_archive_files(spark: SparkSession, path: str) -> DataFrame:
    """(archive_id, content) of landed archive files; the id is taken from the file name."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gkg.csv.zip").load(path)
    return files.select(
        F.regexp_extract("path", r"/(\d{14})\.gkg\.csv\.zip$", 1).alias("archive_id"), "content"
    )


def _fault(content: bytes) -> str | None:
    """Read the first member to its end, a piece at a time; what hinders that, or None."""
    try:
        with zipfile.ZipFile(io.BytesIO(content)) as archive:
            names = archive.namelist()
            if not names:
                return "no member"
            with archive.open(names[0]) as member:
                while member.read(1 << 20):
                    pass
    except (zipfile.BadZipFile, zlib.error, struct.error, EOFError, OSError, RuntimeError, ValueError) as error:
        return f"{type(error).__name__}: {error}"
    return None


@F.pandas_udf(StringType())
def _faults(contents: pd.Series) -> pd.Series:
    return contents.map(_fault).astype(object)


def verify_archives(manifest: DataFrame, files: DataFrame) -> DataFrame:
    """Manifest rows of the landed files with their checksum, `valid` (equal, or none given) and `fault`: why
    the file cannot be unpacked, null if it can.

    Contents are reduced to checksums and faults before the join; no archive is shuffled.
    """
    sums = files.select("archive_id", F.md5("content").alias("actual_md5"), _faults("content").alias("fault"))
    return manifest.join(sums, "archive_id").withColumn(
        "valid", (F.col("md5") == "") | (F.col("md5") == F.col("actual_md5"))
    )


def accepted(verified: DataFrame) -> DataFrame:
    return verified.where("valid and fault is null").select("archive_id", "archive_time", "url")


def rejected(verified: DataFrame) -> DataFrame:
    """Archives with a wrong checksum, and those with the right one that cannot be unpacked."""
    error = F.when(~F.col("valid"), F.lit("md5 mismatch")).otherwise(F.col("fault"))
    return verified.where("not valid or fault is not null").select("archive_id", "url", "md5", "actual_md5", error.alias("error"))


def keep_verified(rows: DataFrame, manifest: DataFrame) -> DataFrame:
    """Rows whose archive is in the manifest with the checksum they were read under, with the archive's url."""
    known = manifest.select("archive_id", "md5", F.col("url").alias("archive_url"))
    joined = rows.join(known, "archive_id")
    return joined.where((F.col("md5") == "") | (F.col("md5") == F.col("actual_md5"))).drop("md5", "actual_md5")


def _unzip(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """First member of each zip, line by line; undecodable bytes are replaced. A file that cannot be read to
    its end has no lines: `verify_archives` tells why. Lines of small archives share a batch."""
    names = ["archive_id", "actual_md5", "sequence", "line"]
    held: tuple[list, ...] = ([], [], [], [])
    size = 0

    def flush() -> pa.RecordBatch:
        kinds = (pa.string(), pa.string(), pa.int64(), pa.string())
        return pa.RecordBatch.from_arrays([pa.array(values, kind) for values, kind in zip(held, kinds)], names=names)

    for batch in batches:
        for archive_id, value in zip(batch.column(0).to_pylist(), batch.column(1)):
            content = value.as_py()
            if _fault(content):
                continue
            checksum = hashlib.md5(content).hexdigest()
            with zipfile.ZipFile(io.BytesIO(content)) as archive:
                with archive.open(archive.namelist()[0]) as member:
                    text = io.TextIOWrapper(member, encoding="utf-8", errors="replace")
                    for sequence, line in enumerate(text, 1):
                        for values, item in zip(held, (archive_id, checksum, sequence, line.rstrip("\n"))):
                            values.append(item)
                        size += len(line)
                        if len(held[0]) >= LINES_PER_BATCH or size >= CHARACTERS_PER_BATCH:
                            yield flush()
                            held, size = ([], [], [], []), 0
    if held[0]:
        yield flush()


def archive_lines(files: DataFrame) -> DataFrame:
    """(archive_id, actual_md5, sequence, line) of archive files.

    Spark has no zip codec, so each task unpacks the files of its own split (their total size is bounded by
    `spark.sql.files.maxPartitionBytes`), one archive and one batch of lines at a time.
    """
    return files.select("archive_id", "content").mapInArrow(_unzip, ARCHIVE_LINES)


def search_text(fields: Column) -> Column:
    """Search text of one record: the selected fields that are filled, lower-cased and squeezed."""
    chosen = F.array(*[F.get(fields, i) for i in V.NEWS_TEXT_POSITIONS])
    filled = F.filter(chosen, lambda field: field.isNotNull() & (field != ""))
    return F.lower(S.squeeze(F.array_join(filled, " ")))


def archive_documents(lines: DataFrame, manifest: DataFrame, *, collected_at: Column | None = None) -> DataFrame:
    """Archive lines to raw stream rows, one per matched category (none if nothing matches).

    Lines are filtered where they are unpacked; only the few that match meet the manifest, which drops
    those of archives with a wrong checksum. Texts are only cut into words if they hold a cost and a local term as
    plain substrings: a squeezed text without them has no category.
    """
    rows = staged(lines, {"_f": F.split("line", "\t")})
    rows = staged(rows, {"_text": search_text(F.col("_f"))})
    for terms in (V.NEWS_COST_TERMS, V.NEWS_LOCAL_TERMS):
        rows = rows.where(contains_term(F.col("_text"), [" ".join(t.lower().split()) for t in terms]))
    rows, matcher = WordMatcher.attach(rows, F.col("_text"))
    rows = keep_verified(rows.select("*", F.inline(news_categories(matcher))), manifest)
    field = lambda i: F.coalesce(F.get("_f", F.lit(i)), F.lit(""))
    zero = F.lit(0).cast("bigint")
    return rows.select(
        F.concat_ws(":", field(0), F.col("category")).alias("_id"),
        F.lit("gdelt").alias("platform"), F.lit("raw").alias("stage"), "category",
        best_phrase(matcher, F.col("category")).alias("search_term"),
        field(0).alias("source_id"), field(4).alias("url"), field(3).alias("domain"),
        field(3).alias("author_handle"), field(3).alias("author_display_name"),
        F.col("_text").alias("text"),
        F.date_format(times.stamp_time(F.col("archive_id")), "yyyy-MM-dd'T'HH:mm:ssXXX").alias("created_at"),
        *[zero.alias(c) for c in ("like_count", "reply_count", "repost_count", "quote_count")],
        F.col("archive_id").alias("gkg_file_id"), F.col("archive_url").alias("gkg_url"),
        *[
            field(i).alias(name)
            for i, name in ((7, "themes"), (8, "v2themes"), (9, "locations"), (10, "v2locations"),
                            (11, "persons"), (13, "organizations"), (15, "tone"), (23, "all_names"))
        ],
        F.col("hits").alias("matched_terms"),
        F.date_format(
            collected_at if collected_at is not None else F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ssXXX"
        ).alias("collected_at"),
    )
