"""Structured Streaming forms of the daily feed: upsert, dedup, discovery, latest price and daily trend."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from harvestline import vocab
from harvestline.functions import measures as M
from harvestline.operators.dedup import upsert
from harvestline.sources.sinks import AuditError, Gate, current_version, merge_partitions, publish, read_merged, read_version, write_versioned


def read_stream(spark: SparkSession, path: str, schema, fmt: str = "parquet", files_per_trigger: int | None = None,
                **options: str) -> DataFrame:
    reader = spark.readStream.schema(schema).format(fmt).options(**options)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.load(path)


def run_available(query: StreamingQuery) -> None:
    """Wait until everything available at the start is processed."""
    query.awaitTermination()
    if query.exception():
        raise query.exception()


def upsert_stream(stream: DataFrame, root: str, checkpoint: str, keys: Sequence[str], order: Sequence[Column] = (),
                  keep: int = 3, prepare: Callable[[DataFrame], DataFrame] = lambda df: df,
                  partition: str | None = None, gate: Gate | None = None,
                  rejected: Callable[[int, list[str]], None] = lambda number, failed: None) -> StreamingQuery:
    """Merge each micro-batch into a table: whole versions side by side, or the changed folders of ``partition``.

    With a ``gate``, the merged rows are audited before readers see them. A batch that fails is left out: the last good
    table stays, ``rejected`` is told the batch and the checks, and the stream goes on. Merging a batch twice gives the same
    table, so a batch repeated after a failure does no harm. With no new data the last good version stays.
    """
    def merge(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        rows = prepare(batch)
        if partition:
            try:
                merge_partitions(rows, root, keys, partition, order, gate)
            except AuditError as error:
                rejected(number, error.failed)
            return
        base = read_version(spark, root) if current_version(spark, root) is not None else rows.limit(0)
        merged = upsert(base, rows, keys, order=order)
        if gate is None:
            write_versioned(merged, root, keep=keep)
        elif failed := publish(merged, root, gate, keep):
            rejected(number, failed)

    return (stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


def dedup_stream(stream: DataFrame, keys: Sequence[str], ts: str, lateness: str) -> DataFrame:
    """First row of every key to arrive; state older than the bound is dropped. ``best_stream`` keeps the best instead."""
    return stream.withWatermark(ts, lateness).dropDuplicatesWithinWatermark(list(keys))


def best_stream(stream: DataFrame, keys: Sequence[str], ts: str, lateness: str, ranked: Sequence[Column]) -> DataFrame:
    """The best row of every key, whatever order rows arrive in: the least by ``ranked``, then by all other columns.

    ``ts`` is the event time and part of the key, so the state of a key is one row and is dropped once the watermark has passed
    it. In update mode every batch gives the keys whose best row has changed; in append mode a key comes once, at the bound.
    """
    at = [] if ts in keys else [ts]
    others = [c for c in stream.columns if c not in (*keys, *at)]
    ties = [x for c in others for x in (F.col(c).isNull().alias(f"_no_{c}"), F.col(c).alias(c))]
    best = F.min(F.struct(*[r.alias(f"_r{i}") for i, r in enumerate(ranked)], *ties))
    return (stream.withWatermark(ts, lateness).groupBy(*keys, *at).agg(best.alias("_best"))
            .select(*[F.col(c) if c in (*keys, *at) else F.col(f"_best.{c}").alias(c) for c in stream.columns]))


def dedup_priority_stream(stream: DataFrame, keys: Sequence[str], ts: str, lateness: str, source: str = "source",
                          prices: Sequence[str] = vocab.PRICE_MEASURES, modal: str = "modal_price",
                          ranks: dict[str, int] = vocab.SOURCE_RANK) -> DataFrame:
    """The rows that the batch deduplication keeps: best source, then most complete prices, then highest modal price."""
    present = M.completeness(*[F.col(p) for p in prices])
    ranked = [-M.source_rank(F.col(source), ranks), -present, -F.coalesce(F.col(modal), F.lit(0.0))]
    return best_stream(stream, keys, ts, lateness, ranked)


def discover_stream(stream: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Distinct values with their counters, kept as streaming state, which grows with the number of values."""
    return _named_values(stream, cols).groupBy("column", "value").agg(F.count(F.lit(1)).alias("rows"))


def _named_values(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in cols])
    return df.select(F.explode(pairs).alias("p")).select("p.*").filter(F.col("value").isNotNull())


def discovery_sketches(df: DataFrame, cols: Sequence[str], lg_k: int = 14, tracked: int = 4096) -> DataFrame:
    """One row per column of a stream or table: its rows, a sketch of its distinct values and one of its frequent values.

    The size of a row does not depend on the data: a HyperLogLog sketch of 2^``lg_k`` cells (relative standard error
    0.83 / 2^(lg_k / 2), 0.65 % at 14) and a frequent-items sketch of ``tracked`` values.
    """
    return _named_values(df, cols).groupBy("column").agg(
        F.count(F.lit(1)).alias("rows"), F.hll_sketch_agg("value", lg_k).alias("distinct_values"),
        F.expr(f"approx_top_k_accumulate(value, {tracked})").alias("frequent_values"))


def discovered(sketches: DataFrame, top: int = 10) -> DataFrame:
    """``column, rows, distinct_count, top`` of sketches; ``top`` lists values with their estimated rows, most frequent first.

    A listed value has at least its estimate less 3.5 / ``tracked`` of the rows; while a column has no more than three quarters
    of ``tracked`` values, its counts are exact.
    """
    return sketches.select("column", "rows", F.hll_sketch_estimate("distinct_values").alias("distinct_count"),
                           F.transform(F.expr(f"approx_top_k_estimate(frequent_values, {top})"),
                                       lambda x: F.struct(x["item"].alias("value"), x["count"].alias("rows"))).alias("top"))


def latest_stream(stream: DataFrame, keys: Sequence[str], ts: str, value: str) -> DataFrame:
    """Newest value of every key as state; equal times take the larger value."""
    best = F.max(F.struct(F.col(ts).alias("ts"), F.col(value).alias("value")))
    return (stream.groupBy(*keys).agg(best.alias("b"))
            .select(*keys, F.col("b.ts").alias(ts), F.col("b.value").alias(value)))


def daily_trend_stream(stream: DataFrame, by: Sequence[str], ts: str, value: str, lateness: str) -> DataFrame:
    """Average per day, emitted once the watermark has passed the day."""
    return (stream.withWatermark(ts, lateness).groupBy(F.window(ts, "1 day").alias("w"), *by)
            .agg(F.avg(value).alias("avg_value"), F.count(F.lit(1)).alias("rows"))
            .select(F.col("w.start").alias("day"), *by, "avg_value", "rows"))


def to_files(result: DataFrame, path: str, checkpoint: str, mode: str = "append") -> StreamingQuery:
    """Append-mode results as Parquet files."""
    return (result.writeStream.outputMode(mode).format("parquet").option("path", path)
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


def changes_to_files(result: DataFrame, path: str, checkpoint: str, keys: Sequence[str], buckets: int = 16) -> StreamingQuery:
    """Update-mode results as one current table: every batch replaces its changed keys in the buckets that hold them.

    The table has one row per key, however many batches there were; a repeated batch gives the same table.
    """
    def merge(batch: DataFrame, number: int) -> None:
        rows = batch.withColumn("_bucket", F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")).persist()
        try:  # the state of a batch is advanced once, though its rows are read twice
            merge_partitions(rows, path, keys, "_bucket")
        finally:
            rows.unpersist()

    return (result.writeStream.outputMode("update").foreachBatch(merge).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


def read_changes(spark: SparkSession, path: str) -> DataFrame:
    """The current row of every key."""
    return read_merged(spark, path).drop("_bucket")
