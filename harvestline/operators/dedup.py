"""Deduplication, upsert and duplicate statistics on a natural key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from harvestline import vocab
from harvestline.functions import measures as M
from harvestline.operators.ordered import total_order


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str], n: int = 1) -> DataFrame:
    """The first ``n`` rows of every key. The row limit is applied before the shuffle, so hot keys stay small."""
    ranked = Window.partitionBy(*keys).orderBy(*total_order(df, order, skip=keys))
    return df.withColumn("_rn", F.row_number().over(ranked)).filter(F.col("_rn") <= n).drop("_rn")


def dedup_priority(df: DataFrame, keys: Sequence[str] = vocab.PRICE_KEY, source: str = "source",
                   prices: Sequence[str] = vocab.PRICE_MEASURES, modal: str = "modal_price",
                   ranks: dict[str, int] = vocab.SOURCE_RANK) -> DataFrame:
    """One row per key: best source, then most complete prices, then highest modal price."""
    return keep_first(df, keys, [
        M.source_rank(F.col(source), ranks).desc(),
        M.completeness(*[F.col(p) for p in prices]).desc(),
        F.coalesce(F.col(modal), F.lit(0.0)).desc(),
    ])


def dedup_observations(df: DataFrame, keys: Sequence[str] = vocab.WEATHER_KEY,
                       measures: Sequence[str] = vocab.WEATHER_MEASURES, newest: str | None = None) -> DataFrame:
    """One row per key: newest file first when ``newest`` names its time, then the most complete row."""
    present = [F.col(m) for m in measures if m in df.columns]
    order = [F.col(newest).desc_nulls_last()] if newest else []
    kept = df.filter(F.col(keys[-1]).isNotNull())
    return keep_first(kept, keys, [*order, M.completeness(*present).desc()])


def keep_last(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The last row of every key in the stated order of arrival."""
    return keep_first(df, keys, [F.col(c).desc_nulls_last() for c in order])


def latest(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    return keep_last(df, keys, order)


def upsert(base: DataFrame, updates: DataFrame, keys: Sequence[str], prefer: str = "updates",
           order: Sequence[Column] = ()) -> DataFrame:
    """Both sides merged on the key. Keys are unique afterwards even if one side is empty."""
    if prefer not in ("updates", "base"):
        raise ValueError("prefer is 'updates' or 'base'")
    tagged = (base.withColumn("_new", F.lit(prefer != "updates"))
              .unionByName(updates.withColumn("_new", F.lit(prefer == "updates")), allowMissingColumns=True))
    return keep_first(tagged, keys, [F.col("_new").desc(), *order]).drop("_new")


def duplicates(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Every member of a group with more than one row.

    Keys are counted with map-side aggregation and joined back, which lets the skew join split a hot key; a window
    over the key would put all of it into one task.
    """
    repeated = (df.groupBy(F.struct(*keys).alias("_key")).agg(F.count(F.lit(1)).alias("_n"))
                .filter(F.col("_n") > 1).select("_key"))
    return df.withColumn("_key", F.struct(*keys)).join(repeated, "_key", "left_semi").drop("_key")


def duplicate_stats(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    total, unique = F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))
    repeated = F.col("n") > 1
    return sizes.agg(
        total.alias("total_rows"), unique.alias("unique_rows"),
        F.coalesce(F.sum(F.when(repeated, F.col("n"))), F.lit(0)).alias("duplicate_rows"),
        F.count_if(repeated).alias("duplicate_keys"),
        (total - unique).alias("rows_to_remove"),
        F.coalesce(F.try_divide((total - unique) * 100.0, total), F.lit(0.0)).alias("dedup_pct"))
