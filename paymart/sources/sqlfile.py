"""SQL kept in files."""

from __future__ import annotations

from collections.abc import Mapping
from importlib import resources
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

METRICS_FOR_DAY = str(resources.files("paymart.plans") / "sql" / "metrics_for_day.sql")


def run_sql_file(
    spark: SparkSession, path: str, args: Mapping[str, object] | None = None, **frames: DataFrame
) -> DataFrame:
    """Run the text with bound parameters; ``{name}`` in it stands for a frame."""
    return spark.sql(Path(path).read_text(encoding="utf-8"), args=dict(args or {}), **frames)
