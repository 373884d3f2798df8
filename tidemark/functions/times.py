"""Time expressions. The session time zone is UTC."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

PERIOD_FORMATS = {"day": "yyyy-MM-dd", "month": "yyyy-MM"}


def iso_time(value: Column) -> Column:
    """ISO text to a timestamp; `Z` and offsets accepted, none means UTC; bad text is null."""
    return F.try_to_timestamp(F.nullif(value, F.lit("")))


def any_time(value: Column) -> Column:
    """ISO text or the compact `yyyyMMddTHHmmssZ` form."""
    compact = F.when(
        value.rlike(r"^\d{8}T\d{6}Z"),
        F.try_to_timestamp(F.substring(value, 1, 15), F.lit("yyyyMMdd'T'HHmmss")),
    )
    return F.coalesce(compact, iso_time(value))


def stamp_time(value: Column) -> Column:
    """14-digit id to a timestamp."""
    return F.when(
        value.rlike(r"^\d{14}$"), F.try_to_timestamp(value, F.lit("yyyyMMddHHmmss"))
    )


def period_of(ts: Column, period: str) -> Column:
    """`yyyy-MM-dd` or `yyyy-MM` text of a timestamp."""
    return F.date_format(ts, PERIOD_FORMATS[period])


def period_start(period: Column) -> Column:
    """First day of a month (`2025-09`), quarter (`2025-Q3`) or year (`2025`) label."""
    year = F.substring(period, 1, 4).try_cast("int")
    month = (
        F.when(period.rlike(r"^.{4}-.{2}$") & ~F.contains(period, F.lit("-Q")),
               F.substring(period, 6, 2).try_cast("int"))
        .when(F.contains(period, F.lit("-Q")),
              F.regexp_extract(period, r"-Q([1-4])$", 1).try_cast("int") * 3 - 2)
        .otherwise(F.lit(1))
    )
    return F.make_date(year, month, F.lit(1)).cast("timestamp")


def day_edge(value: Column, end: bool = False) -> Column:
    """Date-only text means the start (or the last second) of that day."""
    edge = "T23:59:59" if end else "T00:00:00"
    return iso_time(F.when(F.length(value) == 10, F.concat(value, F.lit(edge))).otherwise(value))


def months_back(as_of: Column, months: int) -> Column:
    """`as_of` minus round(months * 365 / 12) days, at least one day."""
    days = max(1, round(months * 365 / 12))
    return as_of - F.make_dt_interval(F.lit(days))


def minutes_since(ts: Column, as_of: Column) -> Column:
    """Minutes from `ts` to `as_of` at two decimals."""
    micros = F.unix_micros(as_of) - F.unix_micros(ts)
    return F.rint(micros / 6e7 * 100) / 100
