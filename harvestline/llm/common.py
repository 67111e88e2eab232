"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from harvestline.session import work_dir


def reachable(spark: SparkSession) -> None:
    """Python workers look for the package where the driver found it, also when they start in another folder.

    A cluster whose machines do not share that path gets the package by ``--py-files`` or has it installed.
    """
    env, root = spark.sparkContext.environment, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    known = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in known:
        env["PYTHONPATH"] = os.pathsep.join([*known, root])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    reachable(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def text_of(df: DataFrame, column: str = "text") -> Column:
    """The text column; a null text counts as empty."""
    return F.coalesce(df[column].cast("string"), F.lit(""))


def stored(df: DataFrame, label: str) -> DataFrame:
    """The rows as a table in the shared folder: later stages do not compute them again, whatever executors are lost."""
    reachable(df.sparkSession)
    path = work_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def with_struct(df: DataFrame, result: Column, names: list[str]) -> DataFrame:
    """Add the fields of ``result``; columns of the input that bear the same name are replaced."""
    reachable(df.sparkSession)
    keep = [c for c in df.columns if c not in names]
    held = df.withColumn("__result", result)
    return held.select(*[F.col(f"`{c}`") for c in keep], *[F.col("__result")[n].alias(n) for n in names])


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string array without copying, and the start offset of each value (one more at the end).

    A null value takes no bytes.
    """
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not pa.types.is_large_string(column.type):
        column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    _, offsets, data = column.buffers()
    n = len(column)
    starts = np.frombuffer(offsets, np.int64, n + 1, column.offset * 8) if n else np.zeros(1, np.int64)
    return (np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)), starts


def blocks(starts: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Ranges of rows that hold up to ``most`` bytes together (one row at least)."""
    low, n = 0, len(starts) - 1
    while low < n:
        high = max(low + 1, int(np.searchsorted(starts, starts[low] + most, "right")) - 1)
        yield low, min(high, n)
        low = min(high, n)


def sha256(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


WORD_BYTE = np.zeros(256, bool)
WORD_BYTE[128:] = True
for _low, _high in ("09", "az", "AZ"):
    WORD_BYTE[ord(_low):ord(_high) + 1] = True
SOLID_BYTE = np.ones(256, bool)
SOLID_BYTE[list(b" \t\n\v\f\r")] = False


def word_hashes(data: np.ndarray, cuts: np.ndarray | None = None, word_byte: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words in some bytes, and where each begins. No word goes over one of the ``cuts``.

    ``word_byte`` tells which bytes belong to words; by default ASCII letters and digits, and all beyond ASCII.
    """
    is_word = (WORD_BYTE if word_byte is None else word_byte)[data]
    head = is_word.copy()
    head[1:] &= ~is_word[:-1]
    if cuts is not None:
        cuts = cuts[cuts < len(data)]
        head[cuts] = is_word[cuts]
    begin = np.flatnonzero(head)
    if not len(begin):
        return np.zeros(0, np.uint64), begin
    own = np.flatnonzero(is_word)
    first = np.searchsorted(own, begin)
    sizes = np.diff(np.r_[first, len(own)])
    place = np.arange(len(own)) - np.repeat(first, sizes)
    power = np.cumprod(np.full(int(sizes.max()), 0x9E3779B97F4A7C15, np.uint64), dtype=np.uint64)
    value = (data[own].astype(np.uint64) + np.uint64(1)) * power[place]
    h = np.add.reduceat(value, first)
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(29)), begin


def runs(words: np.ndarray, size: int) -> np.ndarray:
    """Hashes of the runs of ``size`` words."""
    n = len(words) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    h = np.zeros(n, np.uint64)
    for k in range(size):
        h = (h ^ words[k:n + k]) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(32)
    return h


def sample_keys(df: DataFrame, key: str, most: int, seed: int, *others: str) -> DataFrame:
    """Up to ``most`` distinct keys, taken by a hash, as a literal table: its size is bounded, so it may be broadcast.

    A first cut by the hash keeps what reaches the final sort near the size of the sample, however long the table is.
    """
    rows = df.where(F.col(key).isNotNull()).select(F.xxhash64(F.col(key).cast("string"), F.lit(seed)).alias("h"), F.col(key), *others)
    share = min(1.0, 3 * most / max(1, df.count()))
    rows = rows.where(F.pmod("h", F.lit(1 << 40)) < int(share * (1 << 40))).dropDuplicates([key])
    picked = rows.orderBy("h", key).limit(most).drop("h")
    return F.broadcast(df.sparkSession.createDataFrame(picked.toArrow()))


def held_out(doc_id: Column, folds: int, fold: int) -> Column:
    """Whether a row belongs to the fold that no model learns from, by the crc32 of its id as text."""
    return F.crc32(doc_id.cast("string").cast("binary")) % folds == fold
