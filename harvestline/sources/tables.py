"""File sources: Parquet, messy CSV, archives, per-entity folders and dated snapshots."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from harvestline.operators.shape import rename_by_alias
from harvestline.operators.profile import scope_share, value_counts
from harvestline.sources.archives import read_zip_members
from harvestline.sources.paths import exists

CORRUPT = "_corrupt_record"


def read_prices(spark: SparkSession, paths: Sequence[str], source: str, schema: str | None = None) -> DataFrame:
    """Price files as one table tagged with their source."""
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.parquet(*paths).withColumn("source", F.lit(source))


def read_csv(spark: SparkSession, path: str | list[str], schema: str | None = None, **options: str) -> DataFrame:
    """CSV with a header; ``#`` lines and blank lines are skipped. Without a schema every column is text."""
    reader = spark.read.options(header=True, comment="#", ignoreLeadingWhiteSpace=True,
                                ignoreTrailingWhiteSpace=True, **options)
    return (reader.schema(schema) if schema else reader).csv(path)


def read_messy_csv(spark: SparkSession, path: str | list[str], columns: Sequence[str],
                   encoding: str = "UTF-8", header: bool = True) -> tuple[DataFrame, DataFrame]:
    """Text columns of a large CSV (plain, gzip or bzip2 by suffix), and its malformed lines as a second table.

    Splits of plain files are read in parallel; nothing is dropped silently.
    """
    schema = ", ".join(f"`{c}` string" for c in columns) + f", {CORRUPT} string"
    # Every column is parsed whatever a caller selects: a line is malformed by its whole width.
    rows = (spark.read.schema(schema)
            .options(header=header, mode="PERMISSIVE", columnNameOfCorruptRecord=CORRUPT, encoding=encoding,
                     columnPruning=False)
            .csv(path).withColumn("file", F.col("_metadata.file_name"))
            .filter(F.length(F.concat_ws("", CORRUPT, *columns)) >= 0))
    bad = F.col(CORRUPT).isNotNull()
    return rows.filter(~bad).drop(CORRUPT), rows.filter(bad).select("file", F.col(CORRUPT).alias("line"))


def file_encodings(spark: SparkSession, path: str | list[str], fallback: str = "ISO-8859-1") -> DataFrame:
    """``file, encoding, lines, odd_lines``: files (plain, gzip or bzip2) of which every line is valid UTF-8 are UTF-8, others are
    in the fallback encoding. Files are read as lines of bytes, in splits, whatever their size."""
    lines = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), F.is_valid_utf8("value").alias("valid"))
    found = lines.groupBy("file").agg(F.count("*").alias("lines"), F.count_if(~F.col("valid")).alias("odd_lines"))
    return found.select("file", F.when(F.col("odd_lines") == 0, "UTF-8").otherwise(fallback).alias("encoding"), "lines", "odd_lines")


def read_mixed_csv(spark: SparkSession, path: str | list[str], columns: Sequence[str], header: bool = True,
                   fallback: str = "ISO-8859-1") -> tuple[DataFrame, DataFrame, DataFrame]:
    """Rows and malformed lines as by ``read_messy_csv``, of files in UTF-8 and of others in the fallback encoding, and the table
    of the files with the encoding that each was read in. Every file is read by one reader only."""
    names: dict[str, list[str]] = {"UTF-8": [], fallback: []}
    listed = []  # one entry per file, as Spark's own listing has
    for r in file_encodings(spark, path, fallback).toLocalIterator():
        names[r["encoding"]].append(unquote(r["file"]))
        listed.append(r)
    manifest = spark.createDataFrame(listed, "file string, encoding string, lines long, odd_lines long")
    read = [(e, read_messy_csv(spark, found, columns, e, header)) for e, found in names.items() if found]
    if not read:
        empty = spark.createDataFrame([], ", ".join(f"`{c}` string" for c in [*columns, "file", "encoding"]))
        return empty, spark.createDataFrame([], "file string, line string"), manifest
    rows = [good.withColumn("encoding", F.lit(e)) for e, (good, _) in read]
    return reduce(DataFrame.unionByName, rows), reduce(DataFrame.unionByName, [bad for _, (_, bad) in read]), manifest


def read_zip_csv(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """CSV members of zip archives as text columns matched by header name; every member is a task of its own."""
    return read_zip_members(spark, path, columns)[0].select(*columns, "file")


def read_any(spark: SparkSession, path: str, columns: Sequence[str] = ()) -> DataFrame:
    """Reader chosen by suffix: parquet, json, zip of CSVs, or CSV in any text compression."""
    low = path.lower().rstrip("/")
    if low.endswith(".zip"):
        return read_zip_csv(spark, path, columns)
    if low.endswith((".csv", ".csv.gz", ".csv.bz2")):
        return read_csv(spark, path)
    if low.endswith((".json", ".jsonl")):
        return spark.read.json(path)
    return spark.read.parquet(path)


def entity_of(file_path: Column) -> Column:
    """The name of the folder a file lies in, ``_`` read as blank."""
    return F.replace(F.url_decode(F.element_at(F.split(file_path, "/"), -2)), F.lit("_"), F.lit(" "))


def read_entity_dirs(spark: SparkSession, root: str, column: str, schema: str, skip: str = "receipt") -> DataFrame:
    """CSV files in one folder per entity; a missing entity column is filled from the folder name."""
    rows = spark.read.schema(schema).options(header=True, comment="#").csv(f"{root}/*/*.csv").select(
        "*", F.col("_metadata.file_path").alias("_path"), F.col("_metadata.file_name").alias("_name"),
        F.col("_metadata.file_modification_time").alias("file_time"))
    kept = rows.filter(~F.contains(F.lower("_name"), F.lit(skip)))
    named = F.coalesce(F.col(column), entity_of(F.col("_path"))) if column in kept.columns else entity_of(F.col("_path"))
    return kept.withColumn(column, named).drop("_path", "_name")


def read_snapshots(spark: SparkSession, root: str, schema: str, date: str | None = None, latest: bool = False,
                   max_age_days: int | None = None, today: str | None = None,
                   partition: str = "partition_date") -> DataFrame:
    """Dated snapshots below ``root``: all, one date, the newest, or the newest not older than some days.

    The choice is a condition on the partition column, so other snapshots are not read.
    """
    snaps = spark.read.schema(f"{schema}, {partition} date").parquet(root)
    if date:
        return snaps.filter(F.col(partition) == F.lit(date).cast("date"))
    if max_age_days is not None:
        snaps = snaps.filter(F.col(partition) >= F.date_sub(F.lit(today).cast("date"), max_age_days))
    if latest or max_age_days is not None:
        newest = snaps.agg(F.max(partition).alias("newest")).first()["newest"]
        return snaps.filter(F.col(partition) == F.lit(newest))
    return snaps


def read_newest_per(spark: SparkSession, root: str, schema: str, n: int = 1, by_entity: bool = True,
                    suffix: str = "*.csv") -> DataFrame:
    """Rows of the newest file of every entity folder, or of the ``n`` newest files of all."""
    if not exists(spark, f"{root}/*/{suffix}"):
        return spark.createDataFrame([], f"{schema}, entity string")
    files = (spark.read.format("binaryFile").load(f"{root}/*/{suffix}")
             .select("path", "modificationTime", entity_of(F.col("path")).alias("entity")))
    newest = [F.col("modificationTime").desc(), F.col("path").desc()]
    if by_entity:
        w = Window.partitionBy("entity").orderBy(*newest)
        chosen = files.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= n).select("path")
    else:
        chosen = files.orderBy(*newest).limit(n).select("path")
    # A list of file names, not of rows: one entry per entity folder.
    paths = [r["path"] for r in chosen.toLocalIterator()]
    return spark.read.schema(schema).options(header=True, comment="#").csv(paths).select(
        "*", entity_of(F.col("_metadata.file_path")).alias("entity"))


def preview(df: DataFrame, aliases: dict[str, list[str]], state: str, inside: Column, n: int = 1000,
            top: int = 10, order: Sequence[str] = ()) -> dict[str, DataFrame | list[str]]:
    """First look at an input: columns before and after renaming, frequent states and the in-scope share, of the first
    ``n`` rows (by ``order`` if given)."""
    head = rename_by_alias((df.orderBy(*order) if order else df).limit(n), aliases)
    return {"columns": df.columns, "renamed": head.columns, "states": value_counts(head, state, top),
            "scope": scope_share(head, inside)}
