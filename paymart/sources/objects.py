"""What lies in a folder of an object store, and what is in its files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def list_objects(spark: SparkSession, path: str, pattern: str | None = None) -> DataFrame:
    """Path, modification time and size of each file; no content is read."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    return reader.load(path).select("path", "modificationTime", "length")


def profile_source(df: DataFrame) -> DataFrame:
    """Rows and columns of each file behind a frame."""
    return df.groupBy(F.col("_metadata.file_path").alias("path")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.lit(len(df.columns)).alias("n_columns")
    )


def preview(df: DataFrame, order_by: Sequence[str | Column], n: int = 5) -> DataFrame:
    """The first rows; ordered, so that they are the same each time."""
    return df.orderBy(*order_by).limit(n)
