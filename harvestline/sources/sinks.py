"""File sinks: partitioned Parquet, CSV, dated snapshots and kept versions."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from harvestline.operators.dedup import upsert
from harvestline.sources.paths import exists, glob, read_text, remove, replace_text

#: The file that names what readers see, and the prefix of folders that hold the partitions of one merge. Readers of the
#: folder itself pass over names that begin with an underscore.
POINTER = "_current"
MERGE = "_merge"
#: From the rows about to be published, a table of one row with a boolean column for each check.
Gate = Callable[[DataFrame], DataFrame]


class AuditError(ValueError):
    """A table failed its checks and was not published."""

    def __init__(self, failed: list[str]):
        super().__init__(", ".join(failed))
        self.failed = failed


def write_parquet(df: DataFrame, path: str, partition_by: Sequence[str] = (), mode: str = "overwrite") -> None:
    """Snappy Parquet. The rebalance is sized at run time: a large partition is split over many tasks, small ones
    share a task.
    """
    out = df.hint("rebalance", *[F.col(c) for c in partition_by]) if partition_by else df
    (out.write.mode(mode).option("compression", "snappy").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*partition_by).parquet(path))


def write_bucketed(df: DataFrame, path: str, keys: Sequence[str], buckets: int) -> DataFrame:
    """The rows as a table bucketed and sorted by ``keys`` at a path, and that table.

    Tables with the same buckets and key types join on the keys, and aggregate by them, without a shuffle: the shuffle is paid
    once, here. Every task writes its own files, so a hot key is not gathered while writing; but a bucket is read by one task,
    so facts in which one key holds a large share are better joined as they are, where skewed partitions are split.
    """
    name = f"bucketed_{uuid.uuid4().hex}"
    df.write.bucketBy(buckets, *keys).sortBy(*keys).options(path=path, compression="snappy").mode("overwrite").saveAsTable(name)
    return df.sparkSession.table(name)


def with_year(df: DataFrame, day: str = "arrival_date", out: str = "arrival_year") -> DataFrame:
    return df.withColumn(out, F.year(day))


def write_csv(df: DataFrame, path: str, sep: str = "; ", mode: str = "overwrite") -> None:
    """CSV with a header; list columns are joined to text first."""
    flat = {f.name: F.concat_ws(sep, F.col(f.name)) for f in df.schema.fields if f.dataType.typeName() == "array"}
    df.withColumns(flat).write.mode(mode).option("header", True).csv(path)


def write_snapshot(df: DataFrame, root: str, date: str, force: bool = False, partition: str = "partition_date") -> bool:
    """Write one dated snapshot; an existing one is kept unless forced. Tells whether it wrote."""
    spark = df.sparkSession
    if not force and exists(spark, f"{root}/{partition}={date}"):
        return False
    write_parquet(df.withColumn(partition, F.lit(date)), root, [partition])
    return True


def versions(spark: SparkSession, root: str) -> list[int]:
    """Complete versions below a root, oldest first; a version counts once its success marker exists."""
    return sorted(int(m.rsplit("/version=", 1)[1].split("/")[0]) for m in glob(spark, f"{root}/version=*/_SUCCESS"))


def current_version(spark: SparkSession, root: str) -> int | None:
    """The version that readers see: the published one, or the newest complete one of a root without a gate."""
    pointer = read_text(spark, f"{root}/{POINTER}")
    if pointer is not None:
        return json.loads(pointer)["version"]
    known = versions(spark, root)
    return known[-1] if known else None


def read_version(spark: SparkSession, root: str, version: int | None = None) -> DataFrame:
    """The current version, or a named one."""
    number = version if version is not None else current_version(spark, root)
    if number is None:
        raise FileNotFoundError(root)
    return spark.read.parquet(f"{root}/version={number}")


def write_versioned(df: DataFrame, root: str, keep: int = 3, version: int | None = None,
                    delete_old: bool = True) -> int:
    """Write the next version beside the old ones and keep the newest ``keep``; readers never see a partial table."""
    spark = df.sparkSession
    known = versions(spark, root)
    number = version if version is not None else (known[-1] + 1 if known else 1)
    df.write.mode("overwrite").option("compression", "snappy").parquet(f"{root}/version={number}")
    if delete_old:
        for old in [v for v in known if v != number][:max(0, len(set(known) | {number}) - keep)]:
            remove(spark, f"{root}/version={old}")
    return number


def failed_checks(gate: DataFrame) -> list[str]:
    """Names of the checks that do not hold, from a table of one row with a boolean column each (null does not hold)."""
    row = gate.first()
    return [c for c in gate.columns if row is None or not row[c]]


def publish(df: DataFrame, root: str, gate: Gate, keep: int = 3) -> list[str]:
    """Write the next version, audit what was written, and let readers see it only if every check holds.

    Returns the names of the checks that failed. The pointer to the current version moves in one step after the audit, so
    a failed check or a crash at any moment leaves the last good version as it is. A rejected version is removed.
    """
    spark = df.sparkSession
    before, known = current_version(spark, root), versions(spark, root)
    number = max([*known, before or 0]) + 1
    if before is not None and read_text(spark, f"{root}/{POINTER}") is None:
        _point(spark, root, {"version": before})  # else the newest complete version counts, also one that fails
    df.write.mode("overwrite").option("compression", "snappy").parquet(f"{root}/version={number}")
    failed = failed_checks(gate(read_version(spark, root, number)))
    if failed:
        remove(spark, f"{root}/version={number}")
        return failed
    _point(spark, root, {"version": number})
    good = [v for v in known if before is not None and v <= before]
    for old in [v for v in known if v not in good] + good[:max(0, len(good) + 1 - keep)]:
        remove(spark, f"{root}/version={old}")
    return []


def _point(spark: SparkSession, root: str, pointer: dict) -> None:
    replace_text(spark, f"{root}/{POINTER}", json.dumps(pointer, sort_keys=True))


def _merged(spark: SparkSession, root: str, partition: str) -> dict:
    """What a partitioned table consists of: the folder of every partition, by its name below ``root``."""
    pointer = read_text(spark, f"{root}/{POINTER}")
    if pointer is not None:
        return json.loads(pointer)
    plain = [f.rsplit("/", 1)[1] for f in glob(spark, f"{root}/{partition}=*")]  # written before without a pointer
    return {"version": 0, "folders": {name: name for name in plain}, "retired": []}


def _read_folders(spark: SparkSession, root: str, folders: Sequence[str], schema: StructType | str | None) -> DataFrame:
    reader = (spark.read.schema(schema) if schema is not None else spark.read).option("basePath", root)
    merged = [f for f in folders if f.startswith(f"{MERGE}=")]
    plain = [f for f in folders if f not in merged]
    parts = [reader.parquet(*[f"{root}/{f}" for f in some]).drop(MERGE) for some in (merged, plain) if some]
    return reduce(DataFrame.unionByName, parts)


def read_merged(spark: SparkSession, root: str, schema: StructType | str | None = None) -> DataFrame:
    """The current rows of a table that ``merge_partitions`` keeps."""
    pointer = read_text(spark, f"{root}/{POINTER}")
    if pointer is None:
        raise FileNotFoundError(root)
    return _read_folders(spark, root, sorted(json.loads(pointer)["folders"].values()), schema)


def merge_partitions(updates: DataFrame, root: str, keys: Sequence[str], partition: str, order: Sequence[Column] = (),
                     gate: Gate | None = None) -> int:
    """Upsert into a partitioned table by rewriting only the partitions that ``updates`` touches.

    The merged partitions are written once, to folders of their own, and audited there. Then the pointer that names the
    folder of every partition moves in one step: a reader sees all of a merge or nothing, a failed check or a crash leaves
    the table as it was, and a merge that is repeated gives the same rows. Folders that a merge replaces stay until the next
    one, for readers that have begun. Keys include the partition column or determine it; null is a partition like any other.
    Returns the partitions rewritten; ``AuditError`` names the checks that failed.
    """
    spark = updates.sparkSession
    touched = [r[0] for r in updates.select(partition).distinct().collect()]  # as many as folders that change
    if not touched:
        return 0
    table = _merged(spark, root, partition)
    number, folders = table["version"] + 1, table["folders"]
    base = updates.limit(0)
    if folders:
        known = [v for v in touched if v is not None]
        inside = F.col(partition).isin(known) if known else F.lit(False)
        base = _read_folders(spark, root, sorted(folders.values()), updates.schema)
        base = base.filter(inside | F.col(partition).isNull() if None in touched else inside).select(*updates.columns)
    merged = upsert(base, updates, keys, order=order).hint("rebalance", F.col(partition))
    merged.write.mode("overwrite").options(compression="snappy", partitionOverwriteMode="static").partitionBy(partition).parquet(f"{root}/{MERGE}={number}")
    written = [f.rsplit("/", 1)[1] for f in glob(spark, f"{root}/{MERGE}={number}/{partition}=*")]
    fresh = {name: f"{MERGE}={number}/{name}" for name in written}
    if gate is not None and (failed := failed_checks(gate(_read_folders(spark, root, sorted(fresh.values()), updates.schema)))):
        remove(spark, f"{root}/{MERGE}={number}")
        raise AuditError(failed)
    _point(spark, root, {"version": number, "folders": folders | fresh, "retired": [folders[n] for n in written if n in folders]})
    for old in table["retired"]:
        remove(spark, f"{root}/{old}")
    return len(touched)
