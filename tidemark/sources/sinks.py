"""Keyed writes to Parquet tables partitioned by month.

All writes are safe to repeat: a batch that is written twice leaves the table as after the first time.
"""

from __future__ import annotations

import functools
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.operators.filters import MONTH
from tidemark.operators.latest import first_with_copies, last_per_key

# Tables hold texts, which take a third less room this way than in Spark's default.
CODEC = "zstd"
# Key marks are broadcast: at most so many whole numbers.
MARKS = 1 << 17


def with_month(df: DataFrame, ts: str = "created_at") -> DataFrame:
    """Partition column; rows without a time go to the partition `none`."""
    return df.withColumn(MONTH, F.coalesce(F.date_format(ts, "yyyy-MM"), F.lit("none")))


def table_exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def _remove(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def _remove_partitions(spark: SparkSession, path: str, partition: str, values: Sequence[str]) -> None:
    for value in values:
        _remove(spark, f"{path}/{partition}={value}")


def _write(df: DataFrame, path: str, mode: str, partition: str | None) -> None:
    """Rows are rebalanced on the partition column first: few files per partition, large ones split."""
    if partition is None:
        df.write.mode(mode).option("compression", CODEC).parquet(path)
        return
    balanced = df.hint("rebalance", F.col(partition))
    writer = balanced.write.mode(mode).option("compression", CODEC).option("partitionOverwriteMode", "dynamic").partitionBy(partition)
    writer.parquet(path)


def replace_table(df: DataFrame, path: str, *, partition: str | None = MONTH) -> None:
    """Rebuild: everything that was there is gone."""
    writer = df.hint("rebalance", F.col(partition)) if partition else df
    writer = writer.write.mode("overwrite").option("partitionOverwriteMode", "static")
    (writer.partitionBy(partition) if partition else writer).parquet(path)


def replace_partitions(df: DataFrame, path: str, *, partition: str) -> None:
    """Overwrite only the partitions that occur in `df`."""
    _write(df, path, "overwrite", partition)


def _order(df: DataFrame) -> list[Column]:
    """Write order: harvest time if there is one, then the whole row, so that the choice is definite."""
    lead = [F.col("harvested_at")] if "harvested_at" in df.columns else []
    # maps cannot be hashed; their text can
    plain = [F.to_json(F.struct(f.name)) if "map<" in f.dataType.simpleString() else F.col(f.name) for f in df.schema.fields]
    return [*lead, F.xxhash64(*plain)]


def told_apart(df: DataFrame, keys: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """The rows of `df` that may have one of the keys, and those that surely have none.

    Rows stay where they are: only the marks of the keys, a bounded number however many keys there are, are sent to them.
    Rows of the first part still have to be met with the keys themselves.
    """
    mark = lambda c: F.pmod(F.xxhash64(c), F.lit(MARKS)).alias("_mark")
    marks = F.broadcast(keys.select(mark(F.col(key).cast(df.schema[key].dataType))).distinct())
    marked = df.select("*", mark(F.col(key)))
    likely, other = (marked.join(marks, "_mark", kind).drop("_mark") for kind in ("left_semi", "left_anti"))
    return likely, other


def insert_if_absent(df: DataFrame, path: str, *, key: str = "id", partition: str | None = MONTH, key_has_partition: bool = False,
                     cached: bool = False) -> DataFrame:
    """Append the rows whose key is not in the table; the first of several rows with one key is taken.

    Returns one row: `attempted` rows came in, `written` were new, `skipped` were copies or stored already, and
    `rejected` had no key and are not stored. The stored keys are first reduced to those in the batch: when the batch is
    small Spark broadcasts it, and the table's key column is read without a shuffle. Where equal keys are always in the
    same partition (`key_has_partition`), only the partitions that occur in the batch are read. Keys are counted and met
    on their own; whole rows are gathered by key only where a key comes again or is stored (`told_apart`). `cached`: `df`
    is read from a cache already.
    """
    spark = df.sparkSession
    kept = [] if cached else [df.persist()]
    try:
        copies = df.groupBy(key).agg(F.count(F.lit(1)).alias("_copies")).persist()
        kept.append(copies)
        keys, rows = copies.where(F.col(key).isNotNull()), df.where(F.col(key).isNotNull())
        sums = copies.agg(
            F.coalesce(F.sum("_copies"), F.lit(0)).alias("attempted"),
            F.coalesce(F.sum(F.when(F.col(key).isNull(), F.col("_copies"))), F.lit(0)).alias("rejected"),
            F.count(key).alias("keys"),
            F.count_if(F.col(key).isNotNull() & (F.col("_copies") > 1)).alias("copied"),
        ).first()
        exists, known = table_exists(spark, path), 0
        special = keys.where(F.col("_copies") > 1).select(key)
        if exists:
            stored = spark.read.parquet(path)
            if partition and key_has_partition:
                stored = stored.where(F.col(partition).isin([r[0] for r in rows.select(partition).distinct().collect()]))
            seen = stored.select(key).join(keys.select(key), key, "left_semi").distinct().persist()
            kept.append(seen)
            known = seen.count()
            special = special.union(seen)
        written = sums["keys"] - known
        if written or not exists:
            fresh = rows
            if sums["copied"] or known:
                likely, fresh = told_apart(rows, special, key)
                firsts = first_with_copies(likely, [key], _order(df), "_copies").drop("_copies")
                fresh = fresh.unionByName(firsts.join(seen, key, "left_anti") if known else firsts)
            _write(fresh, path, "append", partition)
    finally:
        for frame in kept:
            frame.unpersist()
    counts = {"attempted": sums["attempted"], "written": written, "rejected": sums["rejected"],
              "skipped": sums["attempted"] - sums["rejected"] - written}
    return spark.range(1).select(*[F.lit(n).cast("bigint").alias(name) for name, n in counts.items()])


def upsert(df: DataFrame, path: str, *, key: str = "id", partition: str = MONTH,
           resolve: Callable[[DataFrame], DataFrame] | None = None, cached: bool = False) -> None:
    """Last write per key wins, or `resolve` merges the old and new rows of a key into one.

    Without `resolve`, new keys are appended, rows that are stored as they are are left out, and only the partitions that hold or
    receive another changed row are rewritten. With it, those that hold or receive a key of the batch are. Inside them only rows
    of those keys are merged; all other rows are copied. Stored rows lose ties, so writing a batch again
    changes nothing. Rows without a key are not stored. `cached`: `df` is read from a cache already.
    """
    df = df.where(F.col(key).isNotNull()) if key in df.columns else df
    kept: list[DataFrame] = []
    try:
        if resolve:
            _upsert_resolved(df, path, key, partition, resolve, kept)
        else:
            _upsert_last(df, path, key, partition, kept, cached)
    finally:
        for frame in kept:
            frame.unpersist()


def _upsert_resolved(df: DataFrame, path: str, key: str, partition: str, resolve: Callable[[DataFrame], DataFrame], kept: list[DataFrame]) -> None:
    spark = df.sparkSession
    batch = resolve(df).persist()
    kept.append(batch)
    if not table_exists(spark, path):
        _write(batch, path, "append", partition)
        return
    table, keys = spark.read.parquet(path), batch.select(key)
    holding = table.select(key, partition).join(keys, key, "left_semi").select(partition)
    # partition values of one table: a few hundred months at most
    touched = [row[0] for row in batch.select(partition).union(holding).distinct().collect()]
    if touched:
        old = table.where(F.col(partition).isin(touched))
        winners = resolve(old.join(keys, key, "left_semi").unionByName(batch, allowMissingColumns=True))
        _rewrite(old.join(keys, key, "left_anti").unionByName(winners, allowMissingColumns=True), path, partition, touched)


def _upsert_last(df: DataFrame, path: str, key: str, partition: str, kept: list[DataFrame], cached: bool) -> None:
    spark = df.sparkSession
    if not cached:
        kept.append(df.persist())
    copies = df.groupBy(key).agg(F.count(F.lit(1)).alias("_copies")).persist()
    kept.append(copies)
    special = copies.where(F.col("_copies") > 1).select(key)
    copied, holding, exists = not special.isEmpty(), [], table_exists(spark, path)
    if exists:
        table = spark.read.parquet(path)
        found = table.select(key, partition).join(copies.select(key), key, "left_semi").persist()
        kept.append(found)
        holding = [row[0] for row in found.select(partition).distinct().collect()]
    if not holding:  # new keys only: nothing that is stored is read any further
        fresh = df
        if copied:
            likely, fresh = told_apart(df, special, key)
            fresh = fresh.unionByName(last_per_key(likely, [key], _order(df)))
        if not (exists and copies.isEmpty()):
            _write(fresh, path, "append", partition)
        return
    # Spark forgets what it has cached from the files of a table when the table is written: the keys found in it are stored beside it
    beside = f"{path.rstrip('/')}-keys-{uuid.uuid4().hex}"
    try:
        found.write.parquet(beside)
        held = spark.read.parquet(beside)
        likely, fresh = told_apart(df, special.union(held.select(key)), key)
        latest = last_per_key(likely, [key], _order(df)).persist()
        kept.append(latest)
        fresh = fresh.unionByName(latest.join(held, key, "left_anti"))
        known = latest.join(held, key, "left_semi")
        changed = _changed(known, table.where(F.col(partition).isin(holding)), held, key, partition).persist()
        kept.append(changed)
        # partition values of one table: a few hundred months at most
        touched = [row[0] for row in changed.select(partition).union(changed.select("_held")).distinct().collect()]
        inside = F.coalesce(F.col(partition).isin(touched), F.lit(False))
        if touched:
            keys = changed.select(key).distinct()
            likely, others = told_apart(table.where(F.col(partition).isin(touched)), keys, key)
            ranked = likely.join(keys, key, "left_semi").withColumn("_new", F.lit(0)).unionByName(
                changed.drop("_held").withColumn("_new", F.lit(1)), allowMissingColumns=True
            )
            lead = [F.col("harvested_at")] if "harvested_at" in df.columns else []
            winners = last_per_key(ranked, [key], [*lead, F.col("_new")]).drop("_new")
            parts = [others, likely.join(keys, key, "left_anti"), winners, fresh.where(inside)]
            _rewrite(functools.reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts), path, partition, touched)
        if copies.count() > held.select(key).distinct().count():
            _write(fresh.where(~inside) if touched else fresh, path, "append", partition)
    finally:
        _remove(spark, beside)


def _changed(known: DataFrame, table: DataFrame, held: DataFrame, key: str, partition: str) -> DataFrame:
    """The rows of stored keys, each with the partitions that hold its key (`_held`), without those that are stored once and as they are."""
    if not _comparable(known, table):
        return known.join(held.withColumnRenamed(partition, "_held"), key)
    likely, _ = told_apart(table, held.select(key), key)
    stored = likely.select(key, F.col(partition).alias("_held"), F.struct(*known.columns).alias("_stored"))
    placed = known.join(stored, key).withColumn("_copies", F.count(F.lit(1)).over(Window.partitionBy(key)))
    changed = ~F.struct(*known.columns).eqNullSafe(F.col("_stored")) | (F.col("_copies") > 1)
    return placed.where(changed).select(*known.columns, "_held")


def _rewrite(rows: DataFrame, path: str, partition: str, touched: Sequence[str]) -> None:
    """Overwrite the touched partitions of a table with rows that may be read from it."""
    spark = rows.sparkSession
    rows = rows.persist()
    # a partition whose rows all moved elsewhere is not written below and must go
    left = {row[0] for row in rows.select(partition).distinct().collect()}
    _write(rows, path, "overwrite", partition)
    _remove_partitions(spark, path, partition, [value for value in touched if value not in left])
    rows.unpersist()
    spark.catalog.refreshByPath(path)


def _comparable(batch: DataFrame, table: DataFrame) -> bool:
    """Whether whole rows of both can be compared; maps cannot."""
    types = {f.name: f.dataType.simpleString() for f in table.schema.fields}
    return types == {f.name: f.dataType.simpleString() for f in batch.schema.fields} and not any("map<" in t for t in types.values())


def with_results(raw: DataFrame, results: DataFrame, *, key: str = "id", own: Sequence[str] = ()) -> DataFrame:
    """Raw rows with the status and time of their processing result, if there is one.

    `results` has (key, status, processed_at); the newest counts where a key has several, so that copies of
    a row meet one result each. `own` names the status and the time of raw rows that carry their own result: then only
    rows whose key comes again are joined, and no other row is moved.
    """
    processed_at = (
        F.col("analysis_processed_at") if "analysis_processed_at" in raw.columns else F.lit(None).cast("timestamp")
    )

    def stamped(rows: DataFrame, status: Column, at: Column) -> DataFrame:
        return rows.withColumns(
            {"analysis_status": F.coalesce(status, "analysis_status"), "analysis_processed_at": F.coalesce(at, processed_at)}
        )

    if own:
        named = F.col(key).isNotNull()
        copied = results.groupBy(key).agg(F.count(F.lit(1)).alias("_copies")).where(named & (F.col("_copies") > 1)).select(key)
        single, again = raw, None
        if not copied.isEmpty():
            likely, single = told_apart(raw, copied, key)
            again = with_results(likely.drop(*own), told_apart(results, copied, key)[0], key=key)
        single = stamped(single, *[F.when(named, F.col(c)) for c in own]).drop(*own)
        return single.unionByName(again) if again else single
    newest = F.max(F.struct("processed_at", "status"))
    new = results.groupBy(key).agg(newest.alias("_r")).select(
        F.col(key), F.col("_r.status").alias("_status"), F.col("_r.processed_at").alias("_processed_at")
    )
    return stamped(raw.join(new, key, "left"), F.col("_status"), F.col("_processed_at")).drop("_status", "_processed_at")


def stable_view(spark: SparkSession, path: str, name: str) -> DataFrame:
    """A fixed name to read a time-partitioned table by."""
    df = spark.read.parquet(path)
    df.createOrReplaceTempView(name)
    return spark.table(name)


def write_accounting(df: DataFrame, outcome: Column) -> DataFrame:
    """Rows per outcome, e.g. seen / skipped / written."""
    return df.groupBy(outcome.alias("outcome")).agg(F.count(F.lit(1)).alias("rows"))
