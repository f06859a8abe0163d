"""Transactions by operation: each one stored once, on whichever day it has now.

The key of an operation is its id alone. A later copy with another day moves the
operation: the row of the old day goes. The key index says which days can hold
the operations of a load, so only these are read, and a load of new operations
reads none.

The order of writing makes a load safe to repeat: index entries, then rows on
days that lose none, then the days that lose a row. After a failure an operation
may be stored twice; the same load, or any later one that brings the operation,
finds both rows and leaves the last one.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paymart.functions.columns import to_target_columns
from paymart.schemas import TRANSACTION_TABLE, TXN_DAY
from paymart.session import scratch_path
from paymart.sinks import feed, files, key_index
from paymart.sinks.key_index import KEY
from paymart.sinks.tables import TXN_SORT, append_by_day, overwrite_by_day, read_days

FEW = 1000  # operations of a small load: their ids go to the scans as a list


def store_operations(
    rows: DataFrame,
    path: str,
    version: Sequence[T.StructField],
    n_rows: int,
    sort_by: Sequence[str] = TXN_SORT,
    days: Sequence[dt.date] | None = None,
) -> int:
    """Put rows into the table, each operation once over all days; tells how many were inserted or replaced.

    ``rows`` are ``n_rows`` rows with distinct operations and no NULL key or day,
    read from files (they are used several times); ``days`` are theirs, where known. Of an operation's rows, new and
    stored, the one with the largest ``version`` stays, then the one with the
    largest values: the same whatever the order of loads.
    """
    spark = rows.sparkSession
    schema = T.StructType([*TRANSACTION_TABLE.fields, *version])
    names = [f.name for f in version] + [c for c in TRANSACTION_TABLE.fieldNames() if c != KEY]
    rows = to_target_columns(rows, schema.fieldNames())
    if not n_rows:
        return 0
    key_index.ensure(spark, path)
    ids = [r[0] for r in rows.select(KEY).collect()] if n_rows <= FEW else None
    entries = key_index.lookup(rows, path, ids)
    known_days = [] if entries is None else [r[0] for r in entries.select(TXN_DAY).distinct().collect()]
    if not known_days:  # nothing of this load is stored
        touched = days or [r[0] for r in rows.select(TXN_DAY).distinct().collect()]
        key_index.add(rows.select(KEY, TXN_DAY), path)
        feed.record(spark, path, touched)
        append_by_day(rows, path, TXN_DAY, sort_by, key_index.BLOOM)
        feed.record(spark, path, touched)
        return n_rows

    stored = read_days(spark, path, schema, TXN_DAY, known_days)
    if ids is not None:
        stored = stored.where(F.col(KEY).isin(ids))
    old = stored.join(rows.select(KEY), KEY, "left_semi").groupBy(KEY).agg(
        F.max(F.struct(*names)).alias("old"), F.collect_set(TXN_DAY).alias("old_days"), F.count(F.lit(1)).alias("n_old")
    )
    new = F.struct(*names)
    met = rows.join(old, KEY, "left").select(
        KEY,
        new.alias("new"),
        "old",
        F.coalesce("old_days", F.array().cast("array<date>")).alias("old_days"),
        "n_old",
        (F.col("old").isNull() | (new > F.col("old"))).alias("wins"),
    )
    changed = met.where("wins OR n_old > 1").select(
        KEY, F.when(F.col("wins"), F.col("new")).otherwise(F.col("old")).alias("row"), "old_days", "wins"
    )
    changed = changed.select(KEY, "row.*", "old_days", "wins")
    scratch, seen = scratch_path(spark, "changed-rows"), Observation()
    changed.observe(
        seen,
        F.count_if("wins").alias("n"),
        F.collect_set(TXN_DAY).alias("days"),
        F.array_distinct(F.flatten(F.collect_set("old_days"))).alias("old_days"),
    ).write.parquet(scratch)
    new_days, old_days = seen.get.get("days") or [], sorted(seen.get.get("old_days") or [])
    if not new_days:
        return 0
    changed = spark.read.schema(changed.schema).parquet(scratch)
    feed.record(spark, path, [*new_days, *old_days])
    moved_or_new = changed.where(F.col("wins") & ~F.array_contains("old_days", F.col(TXN_DAY)))
    key_index.add(moved_or_new.select(KEY, TXN_DAY), path)
    fresh = changed.select(*schema.fieldNames())
    in_old = F.col(TXN_DAY).isin(old_days)
    if set(new_days) - set(old_days):
        append_by_day(fresh.where(~in_old), path, TXN_DAY, sort_by, key_index.BLOOM)
    if old_days:
        kept = read_days(spark, path, schema, TXN_DAY, old_days).join(changed.select(KEY), KEY, "left_anti")
        merged = kept.select(*schema.fieldNames()).unionByName(fresh.where(in_old))
        left = overwrite_by_day(merged, path, TXN_DAY, sort_by, key_index.BLOOM)
        for day in set(old_days) - left:
            files.delete(spark, f"{path}/{TXN_DAY}={day.isoformat()}")
    feed.record(spark, path, [*new_days, *old_days])
    return seen.get.get("n") or 0
