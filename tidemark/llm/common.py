"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.session import scratch_dir

# Word separators: the blank and the ASCII controls 9 to 13.
SPACES = "\t\n\x0b\x0c\r "


def text_or_empty(column: str | Column = "text") -> Column:
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit("")).cast("string")


def replaced(text: Column, characters: str, by: str) -> Column:
    """Replace single characters; byte searches, much cheaper than `translate` where most are absent."""
    for character in characters:
        text = F.replace(text, F.lit(character), F.lit(by))
    return text


def words_of(text: Column) -> Column:
    """Words `[^\\x20\\x09-\\x0D]+` of a text, in order."""
    return F.array_remove(F.split(replaced(text, SPACES.replace(" ", ""), " "), " "), "")


def saved(df: DataFrame, name: str) -> DataFrame:
    """Write a frame to the shared scratch folder and read it back: cuts the lineage for all executors."""
    path = scratch_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def shuffle_width(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def text_slices(batch: pa.RecordBatch, column: str, limit: int) -> Iterator[pa.RecordBatch]:
    """Cut a batch so that each slice holds about `limit` bytes of text; a longer text stays alone."""
    array = batch.column(batch.schema.get_field_index(column))
    offsets = np.frombuffer(array.buffers()[1], np.int32 if pa.types.is_string(array.type) else np.int64)
    offsets = offsets[array.offset : array.offset + len(array) + 1]
    start = 0
    while start < len(array):
        end = int(np.searchsorted(offsets, offsets[start] + limit, "right")) - 1
        end = min(max(end, start + 1), len(array))
        yield batch.slice(start, end - start)
        start = end


def ordered_positions(df: DataFrame, order: Sequence[str | Column], name: str, size: str | None = None) -> DataFrame:
    """Number all rows from 0 in a total order, as `position`; `size` adds the sum of that column before each row.

    Range partitions are sorted and numbered where they lie and written to the scratch folder; only one row per
    partition (its count and sum) is gathered to shift them. Rows that tie in the whole order are numbered in
    any order. The added columns are long.
    """
    width = shuffle_width(df)
    ordered = df.repartitionByRange(width, *order).sortWithinPartitions(*order)
    schema = f"{_ddl(df)}, part int, local_position long, local_start long"
    arrow_names = df.columns

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        rows, total = 0, 0
        for batch in batches:
            n = batch.num_rows
            sizes = np.zeros(n, np.int64) if size is None else batch.column(arrow_names.index(size)).to_numpy(zero_copy_only=False)
            ends = np.cumsum(sizes, dtype=np.int64)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(np.full(n, part, np.int32)), pa.array(np.arange(rows, rows + n)),
                 pa.array(total + ends - sizes)],
                names=[*arrow_names, "part", "local_position", "local_start"],
            )
            rows, total = rows + n, total + int(ends[-1]) if n else total

    numbered = saved(ordered.mapInArrow(number, schema), name)
    added = F.lit(0).cast("long") if size is None else F.sum(size)
    totals = {r["part"]: (r["n"], r["s"]) for r in numbered.groupBy("part").agg(F.count("*").alias("n"), added.alias("s")).collect()}
    first_row, first_sum, shifts = 0, 0, []
    for part in sorted(totals):
        shifts.append((part, first_row, first_sum))
        first_row, first_sum = first_row + totals[part][0], first_sum + int(totals[part][1] or 0)
    shift = df.sparkSession.createDataFrame(shifts, "part int, first_row long, first_sum long")
    joined = numbered.join(F.broadcast(shift), "part")  # one row per partition
    out = joined.withColumn("position", F.col("first_row") + F.col("local_position"))
    if size is not None:
        out = out.withColumn("start", F.col("first_sum") + F.col("local_start"))
    return out.drop("part", "local_position", "local_start", "first_row", "first_sum")


def _ddl(df: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
