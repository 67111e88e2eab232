"""Path lookups through the file system that serves a path."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import SparkSession


def _file_system(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def glob(spark: SparkSession, pattern: str) -> list[str]:
    """Existing paths that match a pattern, sorted."""
    fs, target = _file_system(spark, pattern)
    return sorted(str(s.getPath().toString()) for s in (fs.globStatus(target) or []))


def files(spark: SparkSession, pattern: str) -> list[str]:
    """The files that match a pattern, or that lie in the folders that do (not below), without hidden ones."""
    fs, target = _file_system(spark, pattern)
    out = []
    for status in fs.globStatus(target) or []:
        inside = fs.listStatus(status.getPath()) if status.isDirectory() else [status]
        out += [s.getPath() for s in inside if s.isFile() and not (status.isDirectory() and s.getPath().getName().startswith(("_", ".")))]
    return sorted(str(p.toString()) for p in out)


def exists(spark: SparkSession, path: str) -> bool:
    return bool(glob(spark, path))


def resolve(spark: SparkSession, paths: Sequence[str]) -> str:
    """The first of several candidate inputs that exists."""
    for path in paths:
        if exists(spark, path):
            return path
    raise FileNotFoundError(", ".join(paths))


def remove(spark: SparkSession, path: str) -> None:
    fs, target = _file_system(spark, path)
    fs.delete(target, True)


def read_text(spark: SparkSession, path: str) -> str | None:
    """The text of a small file, or nothing if there is none."""
    fs, target = _file_system(spark, path)
    if not fs.exists(target):
        return None
    stream = fs.open(target)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def replace_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file in one step: a reader finds the old text or the new, also if the writer dies in between.

    The step is a rename that overwrites, which is atomic on HDFS and on local file systems.
    """
    fs, target = _file_system(spark, path)
    jvm = spark._jvm
    fresh = jvm.org.apache.hadoop.fs.Path(f"{path}.{uuid.uuid4().hex}")
    stream = fs.create(fresh, True)
    try:
        stream.write(bytearray(text, "utf-8"))
    finally:
        stream.close()
    rename = jvm.org.apache.hadoop.fs.Options.Rename
    how = spark.sparkContext._gateway.new_array(rename, 1)
    how[0] = rename.OVERWRITE
    conf = spark._jsc.hadoopConfiguration()
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), conf)
    context.rename(fs.makeQualified(fresh), fs.makeQualified(target), how)
