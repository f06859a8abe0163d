"""Which days of a table changed since its dependants were last computed.

A load leaves one small file that names the days it touched, in a folder beside
the table: before it writes, so that a load which fails half way is not
forgotten, and again when it is done, as a dependant may have read the days in
between. Whoever recomputes takes the files that are there, reads the days, and
removes exactly these files at the end. Files that came meanwhile stay, so a
day is recomputed once too often at worst and never too seldom.

Loads of messages and of rates leave such files. Whoever writes to a table in
another way calls ``record``, or names the range to recompute.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Iterable

from pyspark.sql import SparkSession

from paymart.sinks import files


def feed_path(table_path: str) -> str:
    return f"{table_path.rstrip('/')}.changes"


def record(spark: SparkSession, table_path: str, days: Iterable[dt.date]) -> None:
    """Name days as changed; no days leave no file."""
    days = sorted(set(days))
    if days:
        text = "\n".join(d.isoformat() for d in days)
        files.put_text(spark, f"{feed_path(table_path)}/days-{uuid.uuid4().hex}", text)


def open_days(spark: SparkSession, table_path: str) -> tuple[list[str], set[dt.date]]:
    """The files that are there, and all days they name."""
    names = list(files.sizes(spark, f"{feed_path(table_path)}/days-*"))
    days = {dt.date.fromisoformat(d) for name in names for d in files.get_text(spark, name).split()}
    return names, days


def mark_done(spark: SparkSession, names: Iterable[str]) -> None:
    """Take away the files whose days have been recomputed."""
    for name in names:
        files.delete(spark, name)
