"""Written intermediates in the shared folder, and small helpers of all operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from paymart.session import scratch_path


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read again.

    Cuts the lineage, so a lost executor costs no recomputation of what stands
    before, and gives joins above it two plain scans, which the adaptive skew
    join can split.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def broadcast_if_small(df: DataFrame, row_bytes: int, max_bytes: int = 64 << 20, extra: Column | None = None) -> DataFrame:
    """``df`` with a broadcast hint if it is counted to be small; else a join shuffles it.

    ``row_bytes`` is what a row takes at most; ``extra`` adds the bytes of columns
    without such a bound, measured row by row.
    """
    size = F.count(F.lit(1)) * F.lit(row_bytes)
    if extra is not None:
        size = size + F.coalesce(F.sum(extra), F.lit(0))
    return F.broadcast(df) if df.agg(size.alias("size")).first()["size"] <= max_bytes else df


def free_names(df: DataFrame, *wanted: str) -> list[str]:
    """Column names that ``df`` does not have, like the wanted ones."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in wanted:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def filtered_in_arrow(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> DataFrame:
    """``df.mapInArrow`` for a function that only leaves out rows, with columns of any name; it finds them by place."""
    plain = df.toDF(*[f"c{i}" for i in range(len(df.columns))])
    return plain.mapInArrow(run, plain.schema).toDF(*df.columns)
