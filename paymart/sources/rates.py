"""The rate history, a CSV file with a header."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paymart.operators.checks import any_null
from paymart.schemas import RATES

CORRUPT = "_corrupt_record"


def read_rates_csv(spark: SparkSession, path: str) -> DataFrame:
    """Rates with an extra column that holds the text of a bad line.

    Columns go by the names in the file's header, in any order and among
    others; a missing one is an error. A field that does not parse is NULL,
    the rest of its row is kept.
    """
    reader = spark.read.option("header", True).option("inferSchema", False)
    header = reader.csv(path).columns
    missing = [c for c in RATES.fieldNames() if c not in header]
    if missing:
        raise ValueError(f"{path} has no column {', '.join(missing)}")
    schema = T.StructType([T.StructField(c, T.StringType()) for c in [*header, CORRUPT]])
    lines = (
        spark.read.schema(schema)
        .option("header", True)
        .option("enforceSchema", False)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .csv(path)
    )
    values = [F.col(f.name).try_cast(f.dataType).alias(f.name) for f in RATES]
    unread = reduce(
        lambda a, b: a | b, [F.col(f.name).isNotNull() & F.col(f.name).try_cast(f.dataType).isNull() for f in RATES]
    )
    whole = F.coalesce(CORRUPT, F.concat_ws(",", *[F.coalesce(c, F.lit("")) for c in header]))
    bad = F.col(CORRUPT).isNotNull() | unread | any_null(RATES.fieldNames())
    return lines.select(*values, F.when(bad, whole).alias(CORRUPT))


def _bad_line() -> Column:
    """Marked, or without one of the values, all of which are required."""
    return F.col(CORRUPT).isNotNull() | any_null(RATES.fieldNames())


def good_rates(rates: DataFrame) -> DataFrame:
    return rates.where(~_bad_line()).select(*RATES.fieldNames())


def bad_rates(rates: DataFrame) -> DataFrame:
    return rates.where(_bad_line())
