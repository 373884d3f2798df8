"""Labelled indicator CSV (`code: label` cells, columns named `CODE` or `CODE: label`)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import strings as S
from tidemark.functions import times


def _resolve(df: DataFrame, code: str) -> str | None:
    return next((c for c in df.columns if c == code or c.startswith(f"{code}:")), None)


def _quoted(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def required_column(df: DataFrame, code: str) -> Column:
    name = _resolve(df, code)
    if name is None:
        raise KeyError(f"column {code!r} was not found")
    return _quoted(name)


def optional_column(df: DataFrame, code: str) -> Column:
    name = _resolve(df, code)
    return _quoted(name) if name else F.lit(None).cast("string")


def read_labelled_csv(spark: SparkSession, path: str) -> DataFrame:
    """All columns as text; the header line alone decides the names."""
    return spark.read.option("header", True).option("quote", '"').option("escape", '"').csv(path)


def parse_indicators(df: DataFrame, *, harvested_at: Column | None = None) -> DataFrame:
    """Observations to `indicators` rows; rows without a value are left out."""
    value = _quoted("OBS_VALUE")
    dataflow = F.coalesce(_quoted("DATAFLOW"), F.lit("")) if "DATAFLOW" in df.columns else F.lit("")
    empty = lambda c: F.coalesce(c, F.lit(""))
    cells = {
        "measure": required_column(df, "MEASURE"),
        "item": required_column(df, "INDEX"),
        "region": required_column(df, "REGION"),
        "frequency": required_column(df, "FREQ"),
        "adjustment": optional_column(df, "TSEST"),
        "unit": optional_column(df, "UNIT_MEASURE"),
    }
    rows = df.where(value.isNotNull() & (value != "")).select(
        dataflow.alias("dataflow"),
        required_column(df, "TIME_PERIOD").alias("period"),
        value.try_cast("double").alias("value"),
        *[empty(S.label_code(c)).alias(f"{n}_code") for n, c in cells.items()],
        *[empty(S.label_text(c)).alias(n) for n, c in cells.items()],
        F.map_from_arrays(
            F.array(*[F.lit(c) for c in df.columns]), F.array(*[_quoted(c) for c in df.columns])
        ).alias("raw_row"),
    )
    code = lambda n: F.col(f"{n}_code")
    parts = ("measure", "item", "adjustment", "region", "frequency")
    start = times.period_start(F.col("period"))
    return rows.select(
        S.digest_id("abs-cpi-", F.lit("abs-cpi"), F.col("dataflow"), *[code(p) for p in parts], F.col("period")).alias("id"),
        F.lit("abs_data_api").alias("source"),
        "dataflow",
        F.lit("monthly_cpi").alias("indicator"),
        S.join_filled(".", *[code(p) for p in parts]).alias("series_key"),
        "measure_code", "measure", "item_code", F.col("item").alias("item_name"),
        "adjustment_code", "adjustment", "region_code", "region", "frequency_code",
        S.first_filled(F.col("frequency"), code("frequency")).alias("frequency"),
        "period", start.alias("period_start"), "value", "unit_code",
        F.coalesce(S.first_filled(F.col("unit"), code("unit")), F.lit("")).alias("unit"),
        start.alias("created_at"),
        (harvested_at if harvested_at is not None else F.date_trunc("second", F.current_timestamp())).alias("harvested_at"),
        F.concat(F.lit("ABS CPI measure "), code("measure"), F.lit(", region "), code("region")).alias("notes"),
        "raw_row",
    )
