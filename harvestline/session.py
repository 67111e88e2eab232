"""Session construction and the shared working folder."""

from __future__ import annotations

import atexit
import contextlib
import functools
import os
import shutil
import tempfile
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from harvestline.sources import paths


def get_spark(app: str = "harvestline", master: str | None = None, shuffle_partitions: int | None = None,
              **conf: str) -> SparkSession:
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.sources.partitionOverwriteMode", "dynamic")
    )
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def reachable(spark: SparkSession) -> None:
    """Python workers look for the package where the driver found it, also when they start in another folder.

    A cluster whose machines do not share that path gets the package by ``--py-files`` or has it installed.
    """
    env, root = spark.sparkContext.environment, os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    known = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in known:
        env["PYTHONPATH"] = os.pathsep.join([*known, root])


_made: list[tuple[SparkSession, str]] = []
#: Spark's own setting to remove the shuffle files of a query when it ends.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def work_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder under the shared checkpoint location of the session, removed when the program ends.

    The cluster names the location in ``spark.checkpoint.dir``; every executor can reach it. Where it is unset, a session
    on one machine gets a temporary folder of that machine, and a session on several machines is refused.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = _own_folder()
    path = f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"
    _made.append((spark, path))
    return path


def written(df: DataFrame, label: str) -> DataFrame:
    """The rows as a compressed table in a fresh folder of ``work_dir``.

    The shuffle files behind them go as soon as they are written, not when the driver happens to collect its garbage.
    """
    spark, path = df.sparkSession, work_dir(df.sparkSession, label)
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Delete a table of ``written`` that nothing will read again."""
    for path in {file.rsplit("/", 1)[0] for file in df.inputFiles()}:
        if path.rsplit("/", 1)[-1] in {own.rsplit("/", 1)[-1] for _, own in _made}:
            paths.remove(df.sparkSession, path)


@functools.cache
def _own_folder() -> str:
    folder = tempfile.mkdtemp(prefix="harvestline-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return f"file://{folder}"


def remove_work(spark: SparkSession) -> int:
    """Delete the folders that ``work_dir`` gave to this session; tables read from them are gone. Returns how many."""
    own = [path for session, path in _made if session is spark]
    _made[:] = [m for m in _made if m[0] is not spark]
    for path in own:
        paths.remove(spark, path)
    return len(own)


@atexit.register
def _remove_all() -> None:
    for spark in {id(s): s for s, _ in _made}.values():
        with contextlib.suppress(Exception):  # a stopped session cannot delete
            remove_work(spark)


def local_table(spark: SparkSession, rows: list[dict], schema: pa.Schema) -> DataFrame:
    """A small literal table with exact size statistics, so that Catalyst itself decides whether to broadcast it."""
    return spark.createDataFrame(pa.Table.from_pylist(rows, schema=schema))
