"""Where each operation may be stored: an index over all days.

Beside a table of transactions lies a table (operation_id, day), dealt into hash
ranges of the id and sorted by it. A load asks it for the
ids that it brings and then reads only the days that can hold them, whatever
days its own rows have.

Entries are added before the rows they point to and never taken back: the index
may name a day in which the operation is not stored (a load failed, or the
operation moved on), but no stored operation is missing from it. What counts is
what the days hold.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paymart.schemas import TXN_DAY
from paymart.sinks import compaction, files

KEY = "operation_id"
# Ranges of a new index, each a folder. Make it with ``ensure`` and thousands of them
# before the first load of a large table: a range is read by one or few tasks.
BUCKETS = 16

ENTRY = T.StructType(
    [T.StructField(KEY, T.StringType()), T.StructField(TXN_DAY, T.DateType()), T.StructField("bucket", T.IntegerType())]
)

# Of tables that are not sorted by id: readers skip row groups that cannot hold the ids they ask for.
BLOOM = {
    f"parquet.bloom.filter.enabled#{KEY}": "true",
    "parquet.bloom.filter.adaptive.enabled": "true",
    "parquet.bloom.filter.candidates.number": "10",
}


def index_path(table_path: str) -> str:
    return f"{table_path.rstrip('/')}.keys"


def _root(spark: SparkSession, table_path: str) -> tuple[str, int] | None:
    """The index's folder and its number of ranges, which the name of the folder tells."""
    found = [(f, f.rpartition("of=")[2]) for f in files.folders(spark, f"{index_path(table_path)}/of=*")]
    return next(((folder, int(n)) for folder, n in found if n.isdigit()), None)


def _bucket(n: int) -> Column:
    return F.pmod(F.xxhash64(KEY), F.lit(n)).cast("int")


def _write(entries: DataFrame, folder: str, n: int) -> None:
    rows = entries.select(KEY, TXN_DAY, _bucket(n).alias("bucket"))
    clustered = rows.hint("rebalance", "bucket").sortWithinPartitions("bucket", KEY)
    clustered.write.partitionBy("bucket").mode("append").parquet(folder)


def ensure(spark: SparkSession, table_path: str, buckets: int = BUCKETS) -> None:
    """Make the index where there is none, from what the table holds.

    A table that is yet to be written gets an empty one. The index appears when
    it is complete.
    """
    if _root(spark, table_path):
        return
    target = f"{index_path(table_path)}/of={buckets}"
    if not files.path_exists(spark, table_path):
        return files.make_folder(spark, target)
    building = f"{index_path(table_path)}/building-{uuid.uuid4().hex}"
    stored = spark.read.schema(T.StructType(ENTRY.fields[:2])).parquet(table_path)
    _write(stored.where(F.col(KEY).isNotNull() & F.col(TXN_DAY).isNotNull()).distinct(), building, buckets)
    files.rename(spark, building, target)


def add(entries: DataFrame, table_path: str) -> None:
    """Add (operation_id, day) pairs; call it before their rows are written."""
    folder, n = _root(entries.sparkSession, table_path)
    _write(entries, folder, n)


def lookup(rows: DataFrame, table_path: str, ids: list[str] | None = None) -> DataFrame | None:
    """The entries of the operations in ``rows``; None where there can be none.

    ``ids`` are these operations where they are few: then only their ranges are
    listed, and row groups without them are skipped.
    """
    spark = rows.sparkSession
    folder, n = _root(spark, table_path)
    if ids is None:
        names = files.folders(spark, f"{folder}/bucket=*")
    else:
        asked = rows.select(_bucket(n)).distinct().collect()
        names = [f"{folder}/{name}" for name in files.existing(spark, folder, [f"bucket={r[0]}" for r in asked])]
    if not names:
        return None
    paths = [folder] if ids is None else names
    entries = spark.read.schema(ENTRY).option("basePath", folder).parquet(*paths).select(KEY, TXN_DAY)
    if ids is not None:
        entries = entries.where(F.col(KEY).isin(ids))
    return entries.join(rows.select(KEY), KEY, "left_semi")


def compact(spark: SparkSession, table_path: str, **options: object) -> int:
    """Few files per range in place of the one that each load adds; options as of ``compaction.compact``."""
    folder, _ = _root(spark, table_path)
    return compaction.compact(spark, folder, ENTRY, "bucket", [KEY], **options)
