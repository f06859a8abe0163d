"""Parquet tables partitioned by day, and ways to put rows into them.

Transactions are clustered by day with a rebalance, in which the adaptive plan
cuts a day that is far larger than the others into several tasks and packs
small days together, so neither a hot day nor many tiny files follow from the
partitioning.

Plain Parquet has no transactions. Appends show up when their job commits;
replacements move finished files into place at the end of the job, one
directory at a time. The rate history is replaced as a whole: a new version
folder is written and then a pointer is switched to it, so readers find the
old one or the new one. All writers but the plain appends can be run again
after a failure and then give the same table.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable, Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.types import StructType

from paymart.functions.columns import to_target_columns
from paymart.operators.filters import Day, day_literal
from paymart.operators.upsert import rows_to_insert, upsert_do_update
from paymart.schemas import (
    METRICS_BY_STATUS,
    METRICS_DAY,
    RATES,
    TRANSACTION_TABLE,
    TXN_DAY,
    TXN_KEY,
)
from paymart.session import scratch_path, shared_dir
from paymart.sinks import files
from paymart.sinks.key_index import BLOOM

TXN_SORT = ["currency_code", "status", "account_number_from"]
METRICS_SORT = ["currency_from", "status"]

# Directory of the rows that have no day, as Spark names it.
NO_DAY = "__HIVE_DEFAULT_PARTITION__"


def create_tables(
    spark: SparkSession, database: str, location: str, tables: dict[str, tuple[StructType, str]]
) -> None:
    """Day-partitioned catalogue tables below ``location``, where not there yet."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}` LOCATION '{location}'")
    for name, (schema, day_column) in tables.items():
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS `{database}`.`{name}` ({columns}) USING parquet "
            f"PARTITIONED BY (`{day_column}`) LOCATION '{location}/{name}'"
        )


def empty_table(spark: SparkSession, schema: StructType) -> DataFrame:
    return spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in schema])


def sync_catalogue(spark: SparkSession, *tables: str) -> None:
    """Make days that were written by path known to catalogue tables."""
    for name in tables:
        spark.sql(f"ALTER TABLE {name} RECOVER PARTITIONS")


def read_table(spark: SparkSession, path: str, schema: StructType, missing_ok: bool = False) -> DataFrame:
    """A stored table.

    ``missing_ok`` is for targets, which have nothing before their first load;
    then the frame is empty. Anything else that is not there is an error.
    """
    if missing_ok and not files.path_exists(spark, path):
        return empty_table(spark, schema)
    return spark.read.schema(schema).parquet(files.require_path(spark, path))


def read_rates(spark: SparkSession, path: str) -> DataFrame:
    """The current version of the rate history."""
    version = files.current_version(spark, path)
    if version is None:
        raise files.MissingInputError(f"{path} has no rates")
    return spark.read.schema(RATES).parquet(f"{path}/{version}")


def days_between(first: Day, last: Day) -> list[dt.date]:
    start, end = (dt.date.fromisoformat(str(d)[:10]) for d in (first, last))
    return [start + dt.timedelta(days=i) for i in range((end - start).days + 1)]


def read_days(
    spark: SparkSession, path: str, schema: StructType, day_column: str, days: Iterable[dt.date | None]
) -> DataFrame:
    """Some days of a stored table; the files of no other day are even listed.

    ``None`` stands for the rows without a day. Days that are not there have no
    rows, also where the table itself is still to be written.
    """
    names = files.existing(spark, path, [f"{day_column}={NO_DAY if d is None else d.isoformat()}" for d in days])
    if not names:
        return empty_table(spark, schema)
    return spark.read.schema(schema).option("basePath", path).parquet(*[f"{path}/{n}" for n in names])


def _by_day(df: DataFrame, day_column: str, sort_by: Sequence[str]) -> DataFrame:
    return df.hint("rebalance", day_column).sortWithinPartitions(day_column, *sort_by)


def append_by_day(
    df: DataFrame, path: str, day_column: str, sort_by: Sequence[str], options: Mapping[str, str] | None = None
) -> int:
    """Append and tell how many rows were written.

    The number is that of the committed files' footers, so parts of the write
    that were repeated after a lost executor count once. The files of this write
    have a name of their own.
    """
    spark, seen, name = df.sparkSession, Observation(), f"part-{uuid.uuid4().hex}"
    (
        _by_day(df, day_column, sort_by)
        .observe(seen, F.collect_set(F.coalesce(F.col(day_column).cast("string"), F.lit(NO_DAY))).alias("days"))
        .write.partitionBy(day_column)
        .options(**{**(options or {}), "mapreduce.output.basename": name})
        .mode("append")
        .parquet(path)
    )
    days = seen.get.get("days") or []
    return rows_in_files(spark, files.sizes(spark, f"{path}/{day_column}={{{','.join(days)}}}/{name}-*")) if days else 0


def rows_in_files(spark: SparkSession, paths: Iterable[str]) -> int:
    """Number of rows by the files' footers; no column is read."""
    paths = list(paths)
    return spark.read.schema("no_column INT").parquet(*paths).count() if paths else 0


def overwrite_by_day(
    df: DataFrame, path: str, day_column: str, sort_by: Sequence[str], options: Mapping[str, str] | None = None
) -> set:
    """Replace the days that occur in the rows; tells which these are."""
    written = Observation()
    (
        _by_day(df, day_column, sort_by)
        .observe(written, F.collect_set(day_column).alias("days"))
        .write.partitionBy(day_column)
        .mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .options(**(options or {}))
        .parquet(path)
    )
    return set(written.get.get("days") or [])


def to_targets(df: DataFrame, writers: Sequence[Callable[[DataFrame], int]]) -> list[int]:
    """Give the same rows to several targets.

    With more than one target the rows are first written to the shared
    checkpoint folder, so that they are computed once and a lost executor
    cannot make the targets differ.
    """
    if len(writers) > 1:
        shared_dir(df.sparkSession)
        df = df.checkpoint()
    return [write(df) for write in writers]


def append_transactions(
    df: DataFrame, *paths: str, others: Sequence[Callable[[DataFrame], int]] = ()
) -> list[int]:
    """Add transactions to each of the tables; a second run adds them again.

    ``others`` are targets of another kind, such as ``jdbc_writer``.
    """
    rows = to_target_columns(df, TRANSACTION_TABLE.fieldNames())
    stored = [lambda d, p=p: append_by_day(d, p, TXN_DAY, TXN_SORT, BLOOM) for p in paths]
    return to_targets(rows, [*stored, *others])


def load_rates(rates: DataFrame, *paths: str) -> list[int]:
    """Replace the rate history in each of the tables.

    The history comes as a whole and a day of it is small, so it is stored in
    date order instead of in a directory per day: row-group statistics then
    skip the other days. ``read_rates`` finds the version written last.
    """

    def write(df: DataFrame, path: str) -> int:
        counted, version = Observation(), files.new_version(path)
        (
            df.repartitionByRange("date_update", "currency_code", "currency_code_with")
            .sortWithinPartitions("date_update", "currency_code", "currency_code_with")
            .observe(counted, F.count(F.lit(1)).alias("n"))
            .write.parquet(f"{path}/{version}")
        )
        files.switch_version(df.sparkSession, path, version)
        return counted.get.get("n") or 0

    rows = to_target_columns(rates, RATES.fieldNames()).dropDuplicates()
    return to_targets(rows, [lambda d, p=p: write(d, p) for p in paths])


def append_metrics(metrics: DataFrame, path: str) -> int:
    """Add mart rows; a second run adds them again, ``replace_days`` does not."""
    rows = to_target_columns(metrics, METRICS_BY_STATUS.fieldNames())
    return append_by_day(rows, path, METRICS_DAY, METRICS_SORT)


def replace_days(
    df: DataFrame,
    path: str,
    first: Day,
    last: Day,
    schema: StructType = METRICS_BY_STATUS,
    day_column: str = METRICS_DAY,
    sort_by: Sequence[str] = METRICS_SORT,
) -> int:
    """Make the days ``first`` to ``last`` of a table hold exactly these rows.

    Days outside the range are neither read nor touched, and rows outside it
    are not written. A day in the range that has rows in the table but none
    here is emptied: its folder goes, after the others are in place. That takes
    one job; what is stored is only listed.
    """
    return replace_listed_days(df, path, days_between(first, last), schema, day_column, sort_by)


def replace_listed_days(
    df: DataFrame,
    path: str,
    days: Iterable[dt.date],
    schema: StructType = METRICS_BY_STATUS,
    day_column: str = METRICS_DAY,
    sort_by: Sequence[str] = METRICS_SORT,
) -> int:
    """``replace_days`` for days that need not follow one another."""
    spark, days = df.sparkSession, sorted(set(days))
    stored = files.existing(spark, path, [f"{day_column}={d.isoformat()}" for d in days])

    written = Observation()
    rows = to_target_columns(df, schema.fieldNames()).where(in_days(day_column, days))
    (
        _by_day(rows, day_column, sort_by)
        .observe(written, F.count(F.lit(1)).alias("n"), F.collect_set(day_column).alias("days"))
        .write.partitionBy(day_column)
        .mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .parquet(path)
    )
    seen = written.get
    written_days = {f"{day_column}={d.isoformat()}" for d in seen.get("days") or []}
    for name in stored:
        if name not in written_days:
            files.delete(spark, f"{path}/{name}")
    return seen.get("n") or 0


def in_days(day_column: str, days: Sequence[dt.date]) -> Column:
    """Whether a day is one of these: a range where they follow one another."""
    if days and (days[-1] - days[0]).days == len(days) - 1:
        return F.col(day_column).between(day_literal(days[0]), day_literal(days[-1]))
    return F.col(day_column).isin(list(days))


def _touched_days(rows: DataFrame, day_column: str) -> list:
    """The days a load brings: a list no longer than the calendar."""
    return [row[0] for row in rows.select(day_column).distinct().where(F.col(day_column).isNotNull()).collect()]


def insert_new(
    rows: DataFrame,
    path: str,
    schema: StructType = TRANSACTION_TABLE,
    key: Sequence[str] = TXN_KEY,
    day_column: str = TXN_DAY,
    sort_by: Sequence[str] = TXN_SORT,
    order_by: Sequence[str] = (),
    days: Sequence | None = None,
) -> int:
    """Insert rows whose key the table lacks; nothing stored is rewritten.

    The day belongs to the key. Therefore only the key columns of the days at
    hand are read, and they are the only ones that can conflict. ``days`` may
    name them where the caller knows them; otherwise the rows are asked.
    """
    spark = rows.sparkSession
    rows = to_target_columns(rows, [*schema.fieldNames(), *[c for c in order_by if c not in schema.fieldNames()]])
    if days is None:
        days = _touched_days(rows, day_column)
    stored = read_days(spark, path, schema, day_column, days)
    fresh = rows_to_insert(stored, rows, key, order_by).select(*schema.fieldNames())
    return append_by_day(fresh, path, day_column, sort_by)


def insert_or_update(
    rows: DataFrame,
    path: str,
    schema: StructType = TRANSACTION_TABLE,
    key: Sequence[str] = TXN_KEY,
    day_column: str = TXN_DAY,
    sort_by: Sequence[str] = TXN_SORT,
    order_by: Sequence[str] = (),
) -> int:
    """Insert rows, overwriting stored ones with the same key.

    Only the days at hand are rewritten. Their old files are read until the
    job commits and only then replaced, so a failing job changes nothing.
    """
    spark = rows.sparkSession
    # Rows without a day share one directory, which a write to it replaces.
    days = [None, *_touched_days(rows, day_column)]
    stored = read_days(spark, path, schema, day_column, days)
    written = Observation()
    (
        _by_day(upsert_do_update(stored, rows, key, order_by), day_column, sort_by)
        .observe(written, F.count(F.lit(1)).alias("n"))
        .write.partitionBy(day_column)
        .mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .parquet(path)
    )
    return written.get.get("n") or 0


def insert_or_newer(
    rows: DataFrame,
    path: str,
    version: Sequence[T.StructField],
    schema: StructType = TRANSACTION_TABLE,
    key: Sequence[str] = TXN_KEY,
    day_column: str = TXN_DAY,
    sort_by: Sequence[str] = TXN_SORT,
    days: Sequence | None = None,
) -> int:
    """Insert rows, overwriting a stored one with the same key if it is older.

    ``version`` are columns that are stored with the rows. Of two rows for one
    key the one with the larger version stays, then the one with the larger
    values: the same whatever the order they come in and in how many loads.
    ``rows`` have one row per key and no NULL in it. Only days with an
    overwritten row are rewritten; the others are appended to. ``days`` may
    name the days at hand where the caller knows them. Tells how many rows were
    inserted or overwritten.
    """
    spark = rows.sparkSession
    stored_schema = StructType([*schema.fields, *version])
    rows = to_target_columns(rows, stored_schema.fieldNames())
    if days is None:
        days = _touched_days(rows, day_column)
    stored = read_days(spark, path, stored_schema, day_column, days)
    names = [f.name for f in version] + [c for c in schema.fieldNames() if c not in key]
    old = stored.select(*key, F.struct(*names).alias("old"))
    newer = F.col("old").isNull() | (F.struct(*names) > F.col("old"))
    changed = rows.join(old, list(key), "left").where(newer).withColumn("replaces", F.col("old").isNotNull()).drop("old")
    scratch, seen = scratch_path(spark, "changed-rows"), Observation()
    replaced_day = F.when(F.col("replaces"), F.col(day_column))
    changed.observe(seen, F.count(F.lit(1)).alias("n"), F.collect_set(replaced_day).alias("days")).write.parquet(scratch)
    n, rewritten = seen.get.get("n") or 0, seen.get.get("days") or []
    if not n:
        return 0
    changed = spark.read.schema(StructType([*stored_schema.fields, T.StructField("replaces", T.BooleanType())])).parquet(scratch)
    if rewritten:
        in_days = F.col(day_column).isin(rewritten)
        kept = read_days(spark, path, stored_schema, day_column, rewritten)
        fresh = changed.where(in_days).select(*stored_schema.fieldNames())
        merged = kept.join(fresh.select(*key), list(key), "left_anti").select(*stored_schema.fieldNames()).unionByName(fresh)
        (
            _by_day(merged, day_column, sort_by)
            .write.partitionBy(day_column)
            .mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .parquet(path)
        )
        changed = changed.where(~in_days)
    append_by_day(changed.select(*stored_schema.fieldNames()), path, day_column, sort_by)
    return n
