"""Few, sorted files in place of many small ones.

Loads leave at least one file per day that they touch, streams one per
micro-batch. Compaction takes the small files of a day, packs them by size into
groups of about the wanted size, and writes each group as one sorted file, all
days in one job. Other files are left alone, and so are files that come meanwhile.

Plain Parquet has no transactions. The new files are complete, and a plan that
names new and old files is written, before the table is touched; then the new
ones move in and the old ones go. A compaction that stops half way is finished
from its plan by the next one. For a moment readers may find rows twice. A load
that replaces days must not run at the same time; one that only appends may.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from paymart.sinks import files

FILE_BYTES = 128 << 20  # of a compacted file
LEAST_FILES = 4  # small ones of a day that are worth a compaction
_NAME = "_metadata.file_path"


def packed(sizes: Mapping[str, int], target: int) -> list[list[str]]:
    """Files in groups of at most ``target`` bytes, by first fit of the largest; a group of one is left out."""
    bins: list[tuple[int, list[str]]] = []
    for name, size in sorted(sizes.items(), key=lambda x: (-x[1], x[0])):
        for i, (used, names) in enumerate(bins):
            if used + size <= target:
                names.append(name)
                bins[i] = (used + size, names)
                break
        else:
            bins.append((size, [name]))
    return [names for _, names in bins if len(names) > 1]


def _work(path: str) -> str:
    return f"{path.rstrip('/')}.compaction"


def finish(spark: SparkSession, path: str) -> int:
    """Bring compactions to their end that stopped after their plan; tells how many there were."""
    plans = list(files.sizes(spark, f"{_work(path)}/*/plan"))
    for plan in plans:
        folder = plan.rpartition("/")[0]
        moves = json.loads(files.get_text(spark, plan))
        for source, target in moves["new"]:
            if files.path_exists(spark, source) and not files.rename(spark, source, target):
                raise OSError(f"{source} cannot be moved to {target}")
        for old in moves["old"]:
            files.delete(spark, old)
        files.delete(spark, folder)
    return len(plans)


def compact(
    spark: SparkSession,
    path: str,
    schema: StructType,
    partition: str,
    sort_by: Sequence[str],
    only: Iterable[str] | None = None,
    file_bytes: int = FILE_BYTES,
    least_files: int = LEAST_FILES,
    options: Mapping[str, str] | None = None,
) -> int:
    """Compact the partitions of a table that have ``least_files`` files below half of ``file_bytes``.

    ``only`` names partitions, such as days; without, all are looked at. Rows
    stay as they are; tells how many files are gone.
    """
    finish(spark, path)
    names = "*" if only is None else "{" + ",".join(sorted(str(x) for x in only)) + "}"
    by_folder: dict[str, dict[str, int]] = {}
    for name, size in files.sizes(spark, f"{path}/{partition}={names}/*.parquet").items():
        if size < file_bytes // 2:
            by_folder.setdefault(name.rpartition("/")[0], {})[name] = size
    groups = [g for small in by_folder.values() if len(small) >= least_files for g in packed(small, file_bytes)]
    if not groups:
        return 0
    old = [name for g in groups for name in g]
    work = f"{_work(path)}/{uuid.uuid4().hex}"
    # The metadata column spells names as URIs; the last two parts tell a file.
    told = [("/".join(name.split("/")[-2:]), i) for i, g in enumerate(groups) for name in g]
    listed = F.from_json(F.lit(json.dumps([{"file": f, "group_of_file": i} for f, i in told])), "ARRAY<STRUCT<file: STRING, group_of_file: INT>>")
    group_of = spark.range(1).select(F.inline(listed))
    file = F.substring_index(F.url_decode(F.col(_NAME)), "/", -2)
    rows = spark.read.schema(schema).option("basePath", path).parquet(*old).withColumn("file", file)
    grouped = rows.join(group_of, "file").repartitionById(len(groups), F.col("group_of_file"))
    (
        grouped.sortWithinPartitions(partition, *sort_by)
        .select(*schema.fieldNames())
        .write.partitionBy(partition)
        .options(**{**(options or {}), "mapreduce.output.basename": f"compact-{uuid.uuid4().hex}"})
        .parquet(f"{work}/data")
    )
    if set(old) - set(files.sizes(spark, f"{path}/{partition}={names}/*.parquet")):
        files.delete(spark, work)  # another writer replaced a day meanwhile
        return 0
    new = files.sizes(spark, f"{work}/data/{partition}=*/*.parquet")
    moves = [(name, "/".join([path, *name.split("/")[-2:]])) for name in new]
    files.put_text(spark, f"{work}/plan", json.dumps({"new": moves, "old": old}))
    finish(spark, path)
    return len(old) - len(new)
