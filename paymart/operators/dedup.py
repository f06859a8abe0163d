"""One row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def one_per_key(df: DataFrame, key: Sequence[str], order_by: Sequence[str] = ()) -> DataFrame:
    """The row of each key that is last by ``order_by``, then by its values.

    The pick is the same on every run, also after a lost executor. It is an
    aggregate and not a ranking window: each task reduces its own rows first,
    so a key with a third of all rows never meets in one task. NULL keys form
    a group of their own.
    """
    rest = [c for c in df.columns if c not in key and c not in order_by]
    ordered = [*order_by, *rest]
    if not ordered:
        return df.dropDuplicates(list(key))
    best = df.groupBy(*key).agg(F.max(F.struct(*ordered)).alias("best"))
    return best.select(*[c if c in key else F.col(f"best.{c}").alias(c) for c in df.columns])


def dedup_by_id(
    messages: DataFrame,
    key: Sequence[str] = ("object_type", "object_id"),
    latest: str | None = "sent_dttm",
) -> DataFrame:
    """One message per id; of several copies, the one sent last.

    The type is part of the key: an id that two types share stays two rows.
    """
    return one_per_key(messages, key, [latest] if latest else [])
