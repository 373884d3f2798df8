"""Message routing, request windows and job runs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

MESSAGE = "message_id string, kind string, attempts string, _corrupt string"
MAX_ATTEMPTS = 3
SLICE_MICROS = 10_000  # slice length of a request window


def decode_messages(df: DataFrame, payload: str = "payload") -> DataFrame:
    """JSON payloads to columns. What is not a JSON object becomes a poison message with its text.

    Attempts may be given as a number or as text; what is no number counts as none.
    """
    parsed = F.from_json(F.col(payload), MESSAGE, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"})
    out = df.withColumn("_m", parsed)
    is_object = F.coalesce(F.trim(F.col(payload)).startswith("{"), F.lit(False))
    poison = F.col("_m").isNull() | F.col("_m._corrupt").isNotNull() | ~is_object
    given = F.col("_m.attempts")
    attempts = F.coalesce(given.try_cast("bigint"), given.try_cast("double").try_cast("bigint"), F.lit(0))
    return out.select(
        *df.columns,
        F.when(~poison, F.col("_m.message_id")).alias("message_id"),
        F.when(poison, F.lit("poison_message")).otherwise(F.col("_m.kind")).alias("kind"),
        F.when(poison, F.lit(0)).otherwise(attempts).cast("bigint").alias("attempts"),
        F.when(poison, F.col(payload)).alias("raw_payload"),
    )


def route_messages(df: DataFrame, failed: Column, *, kinds: tuple[str, ...] = ("nlp_batch",),
                   max_attempts: int = MAX_ATTEMPTS) -> DataFrame:
    """Add `route`, `next_attempts` and `reason`.

    Poison and unknown kinds go to the dead letters at once; a failure is retried until its attempts
    are used up; everything else is done.
    """
    known = F.coalesce(F.col("kind").isin(*kinds), F.lit(False))
    tried = F.coalesce("attempts", F.lit(0)) + 1
    failed = F.coalesce(failed, F.lit(False))
    spent = known & failed & (tried >= max_attempts)
    return df.withColumns(
        {
            "route": F.when(~known | spent, "dead_letter").when(failed, "retry").otherwise("done"),
            "next_attempts": F.when(known & failed, tried).otherwise(F.coalesce("attempts", F.lit(0))),
            "reason": F.when(~known, "poison_message").when(spent, "max_attempts_exceeded"),
        }
    )


def window_start(ts: Column, seconds: int = 60) -> Column:
    """Start of the fixed window a timestamp falls in."""
    return F.timestamp_seconds(F.floor(F.unix_seconds(ts) / seconds) * seconds)


def window_counts(df: DataFrame, *, seconds: int = 60, limit: int = 600) -> DataFrame:
    """Requests per client, route and window, and whether the limit is passed."""
    return (
        df.groupBy("client", "route", window_start(F.col("ts"), seconds).alias("window_start"))
        .agg(F.count(F.lit(1)).alias("requests"))
        .withColumn("over_limit", F.col("requests") > limit)
    )


def window_positions(df: DataFrame, *, seconds: int = 60, limit: int = 600, key: str = "event_id") -> DataFrame:
    """Position of every request in its (client, route, window), and whether it is still allowed.

    A window is cut into slices of `SLICE_MICROS`: rows are ranked inside a slice and shifted by the
    running total of the earlier slices (a fixed number per window). So a busy client is spread over tasks.
    """
    groups = ["client", "route", "window_start"]
    rows = df.withColumn("window_start", window_start(F.col("ts"), seconds)).withColumn(
        "_slice", F.floor(F.unix_micros("ts") / SLICE_MICROS)
    )
    slices = rows.groupBy(*groups, "_slice").agg(F.count(F.lit(1)).alias("_c"))
    before = F.sum("_c").over(
        Window.partitionBy(*groups).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    )
    offsets = slices.select(*groups, "_slice", F.coalesce(before, F.lit(0)).alias("_before"))
    inside = F.row_number().over(Window.partitionBy(*groups, "_slice").orderBy("ts", key))
    placed = rows.withColumn("_inside", inside).join(offsets, [*groups, "_slice"])
    position = F.col("_before") + F.col("_inside")
    return placed.select(
        *df.columns, "window_start", position.alias("position"), (position <= limit).alias("allowed"),
        F.greatest(F.lit(limit) - position, F.lit(0)).alias("remaining"),
    )


def recent_events(df: DataFrame, limit: int = 50) -> DataFrame:
    """Newest `limit` events: a top-k."""
    if limit < 1:
        raise ValueError("a report needs a positive size")
    return df.orderBy(F.col("emitted_at").desc(), "event_id").limit(limit)


def retained_events(df: DataFrame, as_of: Column, *, hours: int = 24, length: int | None = None) -> DataFrame:
    """Retention rule of the event log: events younger than `hours`; only the newest `length` if it is given."""
    young = df.where(F.col("emitted_at") > as_of - F.make_dt_interval(hours=F.lit(hours)))
    return young if length is None else young.orderBy(F.col("emitted_at").desc(), "event_id").limit(length)


RUN_KEYS = ("run_id", "job_name")


def run_parts(events: DataFrame) -> DataFrame:
    """Partial state per run; two partial states are merged by `merge_runs`."""
    ended = F.col("status").isin("succeeded", "failed", "skipped")
    return events.groupBy(*RUN_KEYS).agg(
        F.min(F.when(F.col("status") == "started", F.col("emitted_at"))).alias("started_at"),
        F.max(F.when(ended, F.struct("emitted_at", "status", "duration_ms"))).alias("_end"),
    )


def merge_runs(parts: DataFrame) -> DataFrame:
    return parts.groupBy(*RUN_KEYS).agg(F.min("started_at").alias("started_at"), F.max("_end").alias("_end"))


def finished_runs(parts: DataFrame, as_of: Column, *, timeout_minutes: int = 120) -> DataFrame:
    """One row per run: status is the end status, `running`, or `lost` after the timeout."""
    late = F.col("started_at") < as_of - F.make_dt_interval(mins=F.lit(timeout_minutes))
    open_status = F.when(late, F.lit("lost")).otherwise(F.lit("running"))
    return parts.select(
        *RUN_KEYS, "started_at",
        F.col("_end.emitted_at").alias("ended_at"),
        F.coalesce(F.col("_end.status"), open_status).alias("status"),
        F.col("_end.duration_ms").alias("duration_ms"),
    )


def job_runs(events: DataFrame, as_of: Column, *, timeout_minutes: int = 120) -> DataFrame:
    return finished_runs(run_parts(events), as_of, timeout_minutes=timeout_minutes)
