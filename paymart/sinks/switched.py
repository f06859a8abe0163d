"""Several days of a table replaced at one moment.

Rows lie in ``version=<name>/<day>/``. A replacement writes its days under a new
version and then leaves one small file, a switch, that names the days and that
version; the newest switch of a day counts. So readers find all days of a
replacement or none, a writer that fails half way changes nothing for them, and
writers of different days do not touch what the other one wrote: they leave
separate switches. Of two writers of the same day the later switch counts.

The version before stays for readers that have begun; the one before that goes.
Switches are merged when there are many.
"""

from __future__ import annotations

import datetime as dt
import json
import time
import uuid
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StringType, StructField, StructType

from paymart.functions.columns import to_target_columns
from paymart.schemas import METRICS_BY_STATUS, METRICS_DAY
from paymart.sinks import files
from paymart.sinks.tables import METRICS_SORT, append_by_day, empty_table, in_days

MOST_SWITCHES = 50  # then they are merged into one


def _switches(spark: SparkSession, path: str) -> list[tuple[str, dict]]:
    """Names and contents of the switches: day to [time, version or None, the version before]."""
    names = files.sizes(spark, f"{path}/_switches/days-*")
    return [(name, json.loads(files.get_text(spark, name))) for name in names]


def _current(switches: list[tuple[str, dict]]) -> dict[str, list]:
    """The newest entry of each day; each keeps its own time, also in a merged switch."""
    days: dict[str, list] = {}
    for _, content in switches:
        for day, entry in content.items():
            if day not in days or entry[:1] + [str(entry[1])] > days[day][:1] + [str(days[day][1])]:
                days[day] = entry
    return days


def _leave(spark: SparkSession, path: str, content: dict) -> None:
    files.put_text(spark, f"{path}/_switches/days-{uuid.uuid4().hex}", json.dumps(content, sort_keys=True))


def read_table(
    spark: SparkSession,
    path: str,
    schema: StructType = METRICS_BY_STATUS,
    day_column: str = METRICS_DAY,
    days: Iterable[dt.date] | None = None,
) -> DataFrame:
    """The rows as of the switches that are there now; ``days`` limits what is listed and read."""
    current = _current(_switches(spark, path))
    wanted = None if days is None else {d.isoformat() for d in days}
    folders = [
        f"{path}/version={version}/{day_column}={day}"
        for day, (_, version, _) in sorted(current.items())
        if version is not None and (wanted is None or day in wanted)
    ]
    if not folders:
        return empty_table(spark, schema)
    with_version = StructType([*schema.fields, StructField("version", StringType())])
    return spark.read.schema(with_version).option("basePath", path).parquet(*folders).select(*schema.fieldNames())


def replace_days(
    df: DataFrame,
    path: str,
    days: Iterable[dt.date],
    schema: StructType = METRICS_BY_STATUS,
    day_column: str = METRICS_DAY,
    sort_by: Sequence[str] = METRICS_SORT,
) -> int:
    """Make these days hold exactly these rows, for all readers at once; tells how many rows.

    Rows of other days are not written. A day without rows comes out empty.
    """
    spark, days = df.sparkSession, sorted(set(days))
    if not days:
        return 0
    version = uuid.uuid4().hex
    rows = to_target_columns(df, schema.fieldNames()).where(in_days(day_column, days))
    n = append_by_day(rows, f"{path}/version={version}", day_column, sort_by)
    names = [d.isoformat() for d in days]
    written = {f.rpartition("=")[2] for f in files.folders(spark, f"{path}/version={version}/{day_column}=*")}
    before = _current(_switches(spark, path))
    nothing = [0, None, None]
    at = time.time_ns()
    _leave(spark, path, {d: [at, version if d in written else None, before.get(d, nothing)[1]] for d in names})
    for d in names:
        oldest = before.get(d, nothing)[2]
        if oldest is not None:
            files.delete(spark, f"{path}/version={oldest}/{day_column}={d}")
    _merge(spark, path)
    return n


def _merge(spark: SparkSession, path: str) -> None:
    """One switch in place of many.

    It is there before the others go. Whoever reads meanwhile finds the same days.
    """
    switches = _switches(spark, path)
    if len(switches) > MOST_SWITCHES:
        _leave(spark, path, _current(switches))
        for name, _ in switches:
            files.delete(spark, name)
