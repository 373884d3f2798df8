"""Token-id files: documents in ascending order of id, ids compressed by a context-mixing range coder.

A table of files is written by Spark's writer, so that attempts of lost executors leave nothing behind. Every row
is a segment: the ids of some whole documents as independently reset, checksummed blocks (see `range_coder`), the
documents' ids and their numbers of token ids. Files hold ranges of document ids; segments are numbered in a file.

A null text has its end id only. Null document ids come first. Repeated rows are documents of their own, in any
order among themselves. An empty table gives a table of files without rows. Damaged segments raise when read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import shuffle_width, text_or_empty, text_slices
from tidemark.llm.library_tokens import word_table
from tidemark.llm.pretokens import encode_all
from tidemark.llm.range_coder import BLOCK_IDS, LANES, compress, expand

SEGMENT_IDS = BLOCK_IDS * LANES
END_ID = 0


def write_token_files(docs: DataFrame, path: str, tokenizer: str, end_id: int = END_ID) -> None:
    """Encode every whole text, append the end id and write the files; ids of the vocabulary fit into 16 bits."""
    schema = "file int, segment int, doc_ids array<long>, lengths array<long>, n_ids long, data binary"
    names = ["file", "segment", "doc_ids", "lengths", "n_ids", "data"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, file = word_table(tokenizer), TaskContext.get().partitionId()
        doc_ids: list[int | None] = []
        parts: list[np.ndarray] = []
        lengths: list[int] = []
        held = segment = 0
        end = np.array([end_id], np.uint16)

        def flush() -> pa.RecordBatch:
            ids = np.concatenate(parts)
            return pa.RecordBatch.from_arrays(
                [pa.array([file], pa.int32()), pa.array([segment], pa.int32()), pa.array([doc_ids], pa.list_(pa.int64())),
                 pa.array([lengths], pa.list_(pa.int64())), pa.array([len(ids)], pa.int64()), pa.array([compress(ids)], pa.binary())],
                names=names,
            )

        for batch in batches:
            for piece in text_slices(batch, "text", 4_000_000):
                own = piece.column(0).to_pylist()
                for first, ids, bounds in encode_all(table, piece.column(1).to_pylist(), 4_000_000):
                    short = ids.astype(np.uint16)
                    for i, (a, b) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist())):
                        if held and held + b - a >= SEGMENT_IDS:
                            yield flush()
                            doc_ids, parts, lengths, held, segment = [], [], [], 0, segment + 1
                        doc_ids.append(own[first + i])
                        parts.extend((short[a:b], end))
                        lengths.append(b - a + 1)
                        held += b - a + 1
        if held:
            yield flush()

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    order = F.col("doc_id").asc_nulls_first()
    ranged = rows.repartitionByRange(shuffle_width(docs), order).sortWithinPartitions(order)
    ranged.mapInArrow(run, schema).write.option("compression", "uncompressed").parquet(path)


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """Per document: `doc_id`, `start`, `n_tokens`, `ids` (array of int), in the files' order of documents."""
    def unpack(ids: np.ndarray, bounds: np.ndarray) -> pa.Array:
        return pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(ids.astype(np.int32)))

    return _read(spark, path, unpack, "ids array<int>")


def read_token_checksums(spark: SparkSession, path: str) -> DataFrame:
    """As `read_token_files`, with the checksum `ids_crc32` in place of the ids."""
    def check(ids: np.ndarray, bounds: np.ndarray) -> pa.Array:
        return pa.array([zlib.crc32(ids[a:b]) for a, b in zip(bounds, bounds[1:])], pa.int64())

    return _read(spark, path, check, "ids_crc32 long")


def _read(spark: SparkSession, path: str, value, column: str) -> DataFrame:
    stored = spark.read.parquet(path)
    totals = stored.groupBy("file").agg(F.sum("n_ids").alias("n")).orderBy("file").collect()  # one row per file
    first, firsts = 0, []
    for row in totals:
        firsts.append((row["file"], first))
        first += row["n"]
    begins = spark.createDataFrame(firsts, "file int, file_start long")
    earlier = F.coalesce(F.sum("n_ids").over(Window.partitionBy("file").orderBy("segment").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    # the order of segments is worked out without their data
    heads = stored.select("file", "segment", "n_ids").withColumn("earlier", earlier).join(F.broadcast(begins), "file")
    starts = heads.select("file", "segment", (F.col("file_start") + F.col("earlier")).alias("segment_start"))
    placed = stored.join(starts, ["file", "segment"]).select("doc_ids", "lengths", "data", "segment_start")
    names = ["doc_id", "start", "n_tokens", column.split(" ")[0]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for doc_ids, lengths, data, begin in zip(*(batch.column(i) for i in range(4))):
                sizes = np.array(lengths.as_py(), np.int64)
                bounds = np.concatenate([[0], np.cumsum(sizes)])
                ids = expand(data.as_py())
                yield pa.RecordBatch.from_arrays(
                    [doc_ids.values, pa.array(begin.as_py() + bounds[:-1]), pa.array(sizes), value(ids, bounds)], names=names
                )

    return placed.mapInArrow(run, f"doc_id long, start long, n_tokens long, {column}")
