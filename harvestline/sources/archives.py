"""CSV members of zip archives, read in parallel: one task for each member, inflated as a stream. Of very many members, small
ones share a task.

The members come from the archives' central directories, so planning reads a few kilobytes of each archive, and a task seeks to
its members, reading a directory once; neither holds an archive or a member in memory. Archives are opened by pyarrow's file systems (local, HDFS, S3,
GCS). A store that only Spark can open is read by Spark, one archive in one task.

A member that is not valid UTF-8 from end to end is read as Latin-1, and its rows say so. A record with more fields than its
header is reported with its fields, not cut; missing fields are null.
"""

from __future__ import annotations

import codecs
import csv
import io
import json
import zipfile
from collections.abc import Iterator, Sequence
from typing import IO

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from harvestline.session import reachable
from harvestline.sources.paths import files

CORRUPT = "_corrupt_record"
BATCH_ROWS = 8192
CHUNK_BYTES = 1 << 20
#: Up to so many members are a task each. More are put together up to an equal share of the bytes, and up to TASK_BYTES.
SINGLE_TASKS, TASK_BYTES = 512, 16 << 20


def open_archive(uri: str) -> IO[bytes]:
    """A seekable file; the forms ``/path`` and ``file:/path`` are local."""
    if uri.startswith("file:"):
        uri = "/" + uri.removeprefix("file:").lstrip("/")
    if uri.startswith("/"):
        return open(uri, "rb")
    system, path = pa.fs.FileSystem.from_uri(uri)
    return system.open_input_file(path)


def sized_members(archive: IO[bytes]) -> list[tuple[str, int]]:
    with zipfile.ZipFile(archive) as z:
        return [(m.filename, m.file_size) for m in z.infolist() if not m.is_dir() and m.filename.lower().endswith(".csv")]


def members(archive: IO[bytes]) -> list[str]:
    return [name for name, _ in sized_members(archive)]


def encoding_of(stream: IO[bytes]) -> str:
    decoder = codecs.getincrementaldecoder("utf-8")()
    try:
        while chunk := stream.read(CHUNK_BYTES):
            decoder.decode(chunk)
        decoder.decode(b"", True)
    except UnicodeDecodeError:
        return "ISO-8859-1"
    return "UTF-8"


def member_batches(archive: IO[bytes], member: str, columns: Sequence[str]) -> Iterator[pa.RecordBatch]:
    """The records of one member: its columns by header name, the member, its encoding, and records that are too long."""
    with zipfile.ZipFile(archive) as z:
        yield from opened_batches(z, member, columns)


def opened_batches(z: zipfile.ZipFile, member: str, columns: Sequence[str]) -> Iterator[pa.RecordBatch]:
    names = [*columns, "file", "encoding", CORRUPT]
    schema = pa.schema([(n, pa.string()) for n in names])
    with z.open(member) as raw:
        encoding = encoding_of(raw)
    with z.open(member) as raw:
        records = csv.reader(io.TextIOWrapper(raw, encoding="utf-8-sig" if encoding == "UTF-8" else encoding, newline=""))
        header = [h.strip() for h in next(records, [])]
        place = [header.index(c) if c in header else None for c in columns]
        held: list[list[str | None]] = []
        for record in records:
            if not record:
                continue
            if len(record) > len(header):
                held.append([*[None] * len(columns), member, encoding, json.dumps(record, ensure_ascii=False)])
            else:
                held.append([*[record[k] if k is not None and k < len(record) else None for k in place], member, encoding, None])
            if len(held) == BATCH_ROWS:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*held, strict=True)], schema=schema)
                held = []
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*held, strict=True)], schema=schema)


class Members(InputPartition):
    def __init__(self, archives: list[tuple[str, list[str]]]):
        self.archives = archives


def tasks(found: list[tuple[str, str, int]]) -> list[list[tuple[str, list[str]]]]:
    """Tasks of (archive, member, bytes) rows, in their order: the members of each archive that a task reads."""
    most = min(TASK_BYTES, sum(size for *_, size in found) // SINGLE_TASKS) if len(found) > SINGLE_TASKS else 0
    out, held = [], 0
    for uri, member, size in found:
        if not out or held + size > most or not most:
            out.append([])
            held = 0
        if not out[-1] or out[-1][-1][0] != uri:
            out[-1].append((uri, []))
        out[-1][-1][1].append(member)
        held += size
    return out


class ZipCsvReader(DataSourceReader):
    def __init__(self, archives: list[str], columns: list[str]):
        self.archives, self.columns = archives, columns

    def partitions(self) -> list[InputPartition]:
        found: list[tuple[str, str, int]] = []
        for uri in self.archives:
            with open_archive(uri) as archive:
                found += [(uri, *m) for m in sized_members(archive)]
        return [Members(t) for t in tasks(found)]

    def read(self, partition: Members) -> Iterator[pa.RecordBatch]:
        if partition is None or not hasattr(partition, "archives"):  # archives without a CSV member
            return
        for uri, names in partition.archives:
            with open_archive(uri) as archive, zipfile.ZipFile(archive) as z:
                for member in names:
                    yield from opened_batches(z, member, self.columns)


class ZipCsv(DataSource):
    @classmethod
    def name(cls) -> str:
        return "zip_csv"

    def schema(self) -> str:
        return _schema(json.loads(self.options["columns"]))

    def reader(self, schema) -> DataSourceReader:
        return ZipCsvReader(json.loads(self.options["archives"]), json.loads(self.options["columns"]))


def _schema(columns: Sequence[str]) -> str:
    return ", ".join(f"`{c}` string" for c in [*columns, "file", "encoding", CORRUPT])


def _from_contents(columns: Sequence[str]):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch["content"]:
                with zipfile.ZipFile(held := io.BytesIO(content.as_buffer())) as z:
                    for member in members(held):
                        yield from opened_batches(z, member, columns)
    return rows


def openable(uri: str) -> bool:
    try:
        open_archive(uri).close()
    except Exception:  # any store that pyarrow does not know or cannot reach
        return False
    return True


def read_zip_members(spark: SparkSession, path: str, columns: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Text columns of the CSV members of all archives at a path or pattern with their ``file`` and ``encoding``, and the records
    that do not fit their header."""
    reachable(spark)
    archives = files(spark, path)
    if all(openable(a) for a in archives[:1]):
        spark.dataSource.register(ZipCsv)
        found = spark.read.format("zip_csv").options(archives=json.dumps(archives), columns=json.dumps(list(columns))).load()
    else:
        found = spark.read.format("binaryFile").load(path).select("content").mapInArrow(_from_contents(list(columns)), _schema(columns))
    bad = F.col(CORRUPT).isNotNull()
    return found.filter(~bad).drop(CORRUPT), found.filter(bad).select("file", "encoding", F.col(CORRUPT).alias("record"))
