"""Folders of stored tables: what is there, and switching to a new version."""

from __future__ import annotations

import uuid
from collections.abc import Iterable

from pyspark.sql import SparkSession

CURRENT = "_CURRENT"  # names the version folder that readers take


class MissingInputError(FileNotFoundError):
    """A table that a job has to read is not there."""


def _file_system(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, hadoop_path = _file_system(spark, path)
    return fs.exists(hadoop_path)


def require_path(spark: SparkSession, path: str) -> str:
    """The path, or an error if nothing is there."""
    if not path_exists(spark, path):
        raise MissingInputError(path)
    return path


def existing(spark: SparkSession, path: str, names: Iterable[str]) -> list[str]:
    """Those of the named folders below ``path`` that are there, by one listing."""
    names = list(names)
    if not names or not path_exists(spark, path):
        return []
    fs, pattern = _file_system(spark, f"{path}/{{{','.join(names)}}}")
    return sorted(status.getPath().getName() for status in fs.globStatus(pattern) or [])


def delete(spark: SparkSession, path: str) -> None:
    fs, hadoop_path = _file_system(spark, path)
    fs.delete(hadoop_path, True)


def rename(spark: SparkSession, source: str, target: str) -> bool:
    """Move one file; false where the file system refuses or the source is gone."""
    fs, hadoop_path = _file_system(spark, source)
    return fs.rename(hadoop_path, _file_system(spark, target)[1])


def make_folder(spark: SparkSession, path: str) -> None:
    fs, hadoop_path = _file_system(spark, path)
    fs.mkdirs(hadoop_path)


def sizes(spark: SparkSession, pattern: str) -> dict[str, int]:
    """Full names and sizes of the files that match a pattern; one listing, nothing is opened."""
    fs, hadoop_path = _file_system(spark, pattern)
    return {s.getPath().toString(): s.getLen() for s in fs.globStatus(hadoop_path) or [] if s.isFile()}


def folders(spark: SparkSession, pattern: str) -> list[str]:
    """Full names of the folders that match a pattern."""
    fs, hadoop_path = _file_system(spark, pattern)
    return sorted(s.getPath().toString() for s in fs.globStatus(hadoop_path) or [] if s.isDirectory())


def put_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file that is there as a whole or not at all."""
    folder, _, name = path.rpartition("/")
    fs, temporary = _file_system(spark, f"{folder}/.{name}-{uuid.uuid4().hex}")
    stream = fs.create(temporary)
    stream.write(bytearray(text.encode()))
    stream.close()
    fs.rename(temporary, _file_system(spark, path)[1])


def get_text(spark: SparkSession, path: str) -> str:
    fs, hadoop_path = _file_system(spark, path)
    stream = fs.open(hadoop_path)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def new_version(path: str) -> str:
    """A folder name that no earlier version has."""
    return f"version-{uuid.uuid4().hex}"


def current_version(spark: SparkSession, path: str) -> str | None:
    """The folder that the pointer names; None before the first version."""
    if not path_exists(spark, f"{path}/{CURRENT}"):
        return None
    fs, pointer = _file_system(spark, f"{path}/{CURRENT}")
    stream = fs.open(pointer)
    try:
        return stream.readUTF()
    finally:
        stream.close()


def switch_version(spark: SparkSession, path: str, version: str) -> None:
    """Point readers to ``version``, which is complete by then.

    The pointer is replaced by a rename. The version before stays for readers
    that have begun; older ones go.
    """
    before = current_version(spark, path)
    fs, temporary = _file_system(spark, f"{path}/.{CURRENT}-{uuid.uuid4().hex}")
    stream = fs.create(temporary)
    stream.writeUTF(version)
    stream.close()
    jvm = spark._jvm
    rename = jvm.org.apache.hadoop.fs.Options.Rename
    options = spark.sparkContext._gateway.new_array(rename, 1)
    options[0] = rename.OVERWRITE
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration())
    context.rename(temporary, _file_system(spark, f"{path}/{CURRENT}")[1], options)
    for status in fs.listStatus(_file_system(spark, path)[1]):
        name = status.getPath().getName()
        if name.startswith("version-") and name not in (version, before):
            fs.delete(status.getPath(), True)
