"""Run metrics and the chunk manifest."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from harvestline.operators.dedup import latest

STATUSES = ["pending", "in_progress", "completed", "failed", "skipped"]


def observed(df: DataFrame, name: str, day: str, uniques: Sequence[str] = ()) -> tuple[DataFrame, Observation]:
    """The table with metrics collected while it is used, without another pass. Distinct counts are approximate."""
    seen = Observation(name)
    metrics: list[Column] = [F.count(F.lit(1)).alias("rows"), F.min(day).cast("string").alias("date_min"),
                             F.max(day).cast("string").alias("date_max"),
                             *[F.approx_count_distinct(c).alias(f"unique_{c}") for c in uniques]]
    return df.observe(seen, *metrics), seen


def receipt(spark: SparkSession, step: str, metrics: dict[str, object], started: str, finished: str,
            errors: Sequence[str] = ()) -> DataFrame:
    """One row describing a finished step."""
    values = {k: None if v is None else str(v) for k, v in metrics.items()}
    pairs = [x for k, v in values.items() for x in (F.lit(k), F.lit(v).cast("string"))]
    return spark.range(1).select(
        F.lit(step).alias("step"), F.lit(started).cast("timestamp").alias("started"),
        F.lit(finished).cast("timestamp").alias("finished"),
        (F.unix_timestamp(F.lit(finished).cast("timestamp")) - F.unix_timestamp(F.lit(started).cast("timestamp")))
        .alias("duration_seconds"),
        (F.create_map(*pairs) if pairs else F.create_map().cast("map<string,string>")).alias("metrics"),
        F.array(*[F.lit(e) for e in errors]).cast("array<string>").alias("errors"),
        F.lit(len(errors) == 0).alias("success"))


def run_metrics(before: DataFrame, after: DataFrame, day: str, uniques: Sequence[str]) -> DataFrame:
    """Rows in, out and dropped, distinct values and date range of a step as one row."""
    kept = after.agg(F.count(F.lit(1)).alias("rows_out"), F.min(day).alias("date_min"), F.max(day).alias("date_max"),
                     *[F.countDistinct(c).alias(f"unique_{c}") for c in uniques])
    entered = before.agg(F.count(F.lit(1)).alias("n")).scalar()
    return kept.withColumn("rows_in", entered).withColumn("rows_dropped", F.col("rows_in") - F.col("rows_out"))


def receipt_markdown(metrics: DataFrame) -> str:
    """A (metric, value) table of a report as Markdown, whole; it is meant for the tens of rows of a report."""
    lines = ["| Metric | Value |", "|---|---|"]
    return "\n".join(lines + [f"| {r['metric']} | {r['value']} |" for r in metrics.toLocalIterator()])


_TWIN = {"session": "_session", "chunk": "_chunk"}


def _same_chunk() -> Column:
    """A chunk without a session or number is a chunk as well."""
    return F.col("session").eqNullSafe(F.col("_session")) & F.col("chunk").eqNullSafe(F.col("_chunk"))


def chunk_state(manifest: DataFrame) -> DataFrame:
    """Latest entry of every chunk of an append-only manifest, with its number of attempts."""
    tries = manifest.groupBy("session", "chunk").agg(F.count_if(F.col("status") == "in_progress").alias("attempts"))
    newest = latest(manifest.select("session", "chunk", "status", "rows", "event_time"), ["session", "chunk"],
                    ["event_time", "status", "rows"])
    return newest.join(tries.withColumnsRenamed(_TWIN), _same_chunk()).drop(*_TWIN.values())


def pending(manifest: DataFrame) -> DataFrame:
    """Chunks still to do: whatever is neither completed nor skipped, so an interrupted chunk is tried again."""
    done = manifest.filter(F.col("status").isin("completed", "skipped")).select("session", "chunk").distinct()
    return manifest.select("session", "chunk").distinct().join(done.withColumnsRenamed(_TWIN), _same_chunk(), "left_anti")


def summary(manifest: DataFrame) -> DataFrame:
    state = chunk_state(manifest)
    return state.groupBy("session").agg(
        F.count(F.lit(1)).alias("total_chunks"),
        *[F.count_if(F.col("status") == s).alias(s) for s in STATUSES],
        F.sum(F.when(F.col("status") == "completed", F.col("rows")).otherwise(0)).alias("total_rows"))
