"""Insert with conflict handling, as joins of two frames.

NULL never equals NULL in a unique key, so rows with a NULL in the key are
always new. They are kept out of the joins: by hash they would all land in one
task.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paymart.operators.dedup import one_per_key


def _null_key(key: Sequence[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.col(k).isNull() for k in key])


def new_rows(target: DataFrame, rows: DataFrame, key: Sequence[str]) -> DataFrame:
    """The rows whose key the target does not have; only its key columns are read."""
    return rows.join(target.select(*key), list(key), "left_anti").select(*rows.columns)


def rows_to_insert(
    target: DataFrame, rows: DataFrame, key: Sequence[str], order_by: Sequence[str] = ()
) -> DataFrame:
    """What an insert that skips conflicts would add: one row per new key."""
    keyed = one_per_key(rows.where(~_null_key(key)), key, order_by)
    return new_rows(target, keyed, key).unionByName(rows.where(_null_key(key)))


def upsert_do_nothing(
    target: DataFrame, rows: DataFrame, key: Sequence[str], order_by: Sequence[str] = ()
) -> DataFrame:
    """The target after the insert, rows with a known key skipped."""
    added = rows_to_insert(target, rows, key, order_by)
    return target.unionByName(added, allowMissingColumns=True).select(*target.columns)


def upsert_do_update(
    target: DataFrame, rows: DataFrame, key: Sequence[str], order_by: Sequence[str] = ()
) -> DataFrame:
    """The target after the insert, rows with a known key overwritten.

    Columns that ``rows`` lacks keep the target's values. Whether a value
    comes from ``rows`` is told by a flag and not by the value being present:
    a new NULL overwrites an old value.
    """
    key = list(key)
    keyed = one_per_key(rows.where(~_null_key(key)), key, order_by)
    unkeyed = rows.where(_null_key(key))
    supplied = [c for c in target.columns if c in rows.columns]

    if set(supplied) == set(target.columns):
        kept = new_rows(keyed, target.where(~_null_key(key)), key)
        merged = kept.unionByName(keyed.select(*target.columns))
    else:
        old = target.where(~_null_key(key))
        fresh = keyed.select(
            *key,
            *[F.col(c).alias(f"new_{c}") for c in supplied if c not in key],
            F.lit(True).alias("is_new"),
        )
        joined = old.join(fresh, key, "full_outer")
        merged = joined.select(
            *[
                F.when(F.col("is_new"), F.col(f"new_{c}")).otherwise(F.col(c)).alias(c)
                if c in supplied and c not in key
                else F.col(c)
                for c in target.columns
            ]
        )
    return merged.unionByName(target.where(_null_key(key))).unionByName(
        unkeyed.select(*supplied), allowMissingColumns=True
    )
