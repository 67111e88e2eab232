"""The corpus pipeline: quality filter, line dedup, near-duplicate removal, benchmark decontamination, tokens.

Each stage takes ``(spark, docs, sf_dir)`` and works on all that the stage before kept; all but the last return the columns
of ``documents``. Between stages the rows are written as Parquet and read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from harvestline.llm import bpe, decontaminate, jaccard_join, line_dedup, quality
from harvestline.llm.common import stored, table
from harvestline.llm.queries import ACCEPT, fit_quality

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    model = fit_quality(docs, table(spark, sf_dir, "labels"))
    return quality.score(docs.select(*COLUMNS), model, output="__score").where(F.col("__score") >= ACCEPT).select(*COLUMNS)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later repeated runs of lines leave the texts; ``n_chars`` follows."""
    return line_dedup.dedup_lines(docs.select(*COLUMNS), long_words=line_dedup.LONG_WORDS).withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return jaccard_join.keep_one(docs.select(*COLUMNS))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no test item."""
    found = decontaminate.find_hits(docs.select(*COLUMNS), table(spark, sf_dir, "benchmark"))
    return found.where(F.size("hits") == 0).select(*COLUMNS)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document (little-endian unsigned 32-bit integers) and their number."""
    return bpe.encode(docs.select("doc_id", "text")).select("doc_id", "n_tokens", "token_ids")


STAGES = [
    ("quality classifier", keep_good),
    ("line dedup", drop_repeated_lines),
    ("n-gram Jaccard join", keep_one_of_each),
    ("benchmark decontamination", drop_contaminated),
    ("BPE encoding and decoding", tokenize),
]

#: SQL can express neither the trained classifier nor the tokenizer; the tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = stored(docs, f"pipeline-{k}")
    return docs
