"""Document stores, tables and small list files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.functions.strings import split_list


def read_json_store(spark: SparkSession, path: str, schema: str, *, whole_file: bool = False) -> DataFrame:
    """JSON documents: one object or one array of objects per line, or one array per file.

    Line files are split over tasks; with `whole_file` each file is one task's work.
    """
    return spark.read.schema(schema).option("multiLine", whole_file).json(path)


def read_table(spark: SparkSession, path: str, schema: str | None = None, *, partition: str | None = None,
               values: list[str] | None = None) -> DataFrame:
    """A Parquet table; `values` prunes to those partitions."""
    reader = spark.read.schema(schema) if schema else spark.read
    df = reader.parquet(path)
    return df.where(F.col(partition).isin(values)) if partition and values is not None else df


def read_taxonomy(spark: SparkSession, path: str) -> DataFrame:
    """`topic, keywords (;-separated), example_question` to (topic, keyword, keyword_rank)."""
    rows = spark.read.schema(schemas.TAXONOMY_CSV).option("header", True).csv(path)
    return rows.select("topic", F.posexplode(split_list(F.col("keywords"), ";")).alias("keyword_rank", "keyword"))
