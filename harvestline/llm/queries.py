"""The registered queries of this subpackage, and the SQL statements of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from harvestline.llm import (
    bpe, chat, decontaminate, iblt, jaccard_join, line_dedup, pages, periodic, phrases, quality, simhash, substrings, toxicity,
)
from harvestline.llm.common import held_out, table

#: A score from here on counts as label 1.
ACCEPT = 0.3


def predicted(score: Column) -> Column:
    return (score >= ACCEPT).cast("int")


def op1_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(chat.probe(spark))
    out = chat.format_conversations(turns)
    out = out.withColumn("r", chat.read_digests("formatted", "loss_spans"))
    return out.select("conv_id", "n_turns", F.col("r.turns_sha256"), F.col("r.loss_chars"), F.col("r.loss_sha256"),
                      F.length("formatted").cast("long").alias("formatted_chars"), F.size("token_ids").cast("long").alias("n_tokens"),
                      F.size(F.filter("loss_mask", lambda x: x)).cast("long").alias("n_loss_tokens"))


def op2_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return iblt.fingerprints(table(spark, sf_dir, "documents").select("doc_id", "text")).withColumnRenamed("id", "doc_id")


def toxicity_model(spark: SparkSession, sf_dir: str) -> toxicity.Model:
    docs, labels = table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels")
    known = labels.where(~held_out(F.col("doc_id"), 4, 2))
    prior = known.agg(F.avg("toxic")).first()[0] or 0.0
    return toxicity.fit(docs, known.where("toxic = 1").select("doc_id"), float(prior))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = toxicity.score(table(spark, sf_dir, "documents").select("doc_id", "text"), toxicity_model(spark, sf_dir))
    return out.select("doc_id", held_out(F.col("doc_id"), 4, 2).alias("held_out"), "score", predicted(F.col("score")).alias("predicted"))


def op4_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = jaccard_join.near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select(F.col("id").alias("doc_id"), "class_id", "class_size", "n_copies", "n_links", "n_similar")


def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")


def op6_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return pages.extract(rows, pages.fit(rows)).select("page_id", "url", "text", "n_chars")


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"), long_words=line_dedup.LONG_WORDS)
    return out.select("doc_id", "n_lines", "n_removed", "text")


OP7_SQL = """
WITH lines AS (
  SELECT doc_id, unnest(range(len(l))) AS k, unnest(l) AS line, len(l) AS n
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents)
),
windows AS (
  SELECT doc_id, k, line, n, lead(line) OVER (PARTITION BY doc_id ORDER BY k) AS line2,
         len(regexp_extract_all(line, '[^ \\t\\n\\x0B\\f\\r]+')) >= 50 AS long FROM lines
),
marked AS (
  SELECT *, k + 1 < n AND row_number() OVER (PARTITION BY line, line2, k + 1 < n ORDER BY doc_id, k) > 1 AS again,
         long AND row_number() OVER (PARTITION BY line ORDER BY doc_id, k) > 1 AS alone FROM windows
),
gone AS (
  SELECT doc_id, k, line, alone OR again OR coalesce(lag(again) OVER (PARTITION BY doc_id ORDER BY k), false) AS out FROM marked
)
SELECT doc_id, count(*) AS n_lines, CAST(count(*) FILTER (out) AS BIGINT) AS n_removed,
       coalesce(string_agg(line, chr(10) ORDER BY k) FILTER (NOT out), '') AS text
FROM gone GROUP BY doc_id
"""


def op7_paired_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As ``op7_line_dedup`` without the rule for long lines: a line goes only with a neighbour that repeats with it."""
    out = line_dedup.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_removed", "text")


OP7_PAIRED_SQL = """
WITH lines AS (
  SELECT doc_id, unnest(range(len(l))) AS k, unnest(l) AS line, len(l) AS n
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents)
),
windows AS (
  SELECT doc_id, k, line, n, lead(line) OVER (PARTITION BY doc_id ORDER BY k) AS line2 FROM lines
),
marked AS (
  SELECT *, k + 1 < n AND row_number() OVER (PARTITION BY line, line2, k + 1 < n ORDER BY doc_id, k) > 1 AS again FROM windows
),
gone AS (
  SELECT doc_id, k, line, again OR coalesce(lag(again) OVER (PARTITION BY doc_id ORDER BY k), false) AS out FROM marked
)
SELECT doc_id, count(*) AS n_lines, CAST(count(*) FILTER (out) AS BIGINT) AS n_removed,
       coalesce(string_agg(line, chr(10) ORDER BY k) FILTER (NOT out), '') AS text
FROM gone GROUP BY doc_id
"""


def fit_quality(docs: DataFrame, labels: DataFrame):
    """The quality model, learnt from labels outside the held-out fold."""
    known = labels.where(~held_out(F.col("doc_id"), 5, 0)).select("doc_id", F.col("quality").alias("label"))
    return quality.fit(docs, known)


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    out = quality.score(docs.select("doc_id", "text"), fit_quality(docs, table(spark, sf_dir, "labels")))
    return out.select("doc_id", held_out(F.col("doc_id"), 5, 0).alias("held_out"), "score", predicted(F.col("score")).alias("predicted"))


def op9_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark")
    found = decontaminate.find_hits(docs, items).select("doc_id", F.explode("hits").alias("h"))
    return found.select("doc_id", "h.item_id", "h.score", "h.question_overlap", "h.answer_overlap")


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents").select("lang", "text"))


def op12_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"), keep=["doc_id"])


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic.collapse_runs(periodic.planted(table(spark, sf_dir, "documents").select("doc_id", "text")))
    line = lambda r: F.concat(r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"), F.lit("\n"))
    found = found.withColumn("best", periodic.strongest(F.col("runs")))
    return found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
                        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
                        F.sha2(F.array_join(F.transform("runs", line), "").cast("binary"), 256).alias("runs_sha256"),
                        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_chat_formatting": op1_chat_formatting,
    "op2_document_fingerprints": op2_document_fingerprints,
    "op3_toxicity": op3_toxicity,
    "op4_jaccard_join": op4_jaccard_join,
    "op5_bpe": op5_bpe,
    "op6_html_extraction": op6_html_extraction,
    "op7_line_dedup": op7_line_dedup,
    "op7_paired_lines": op7_paired_lines,
    "op8_quality": op8_quality,
    "op9_suffix_array_dedup": op9_suffix_array_dedup,
    "op10_decontamination": op10_decontamination,
    "op11_collocations": op11_collocations,
    "op12_simhash": op12_simhash,
    "op13_periodic_runs": op13_periodic_runs,
}

ORACLES: dict[str, str] = {"op7_line_dedup": OP7_SQL, "op7_paired_lines": OP7_PAIRED_SQL}
