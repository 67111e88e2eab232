"""Quality reports as (section, metric, value) tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from harvestline import vocab
from harvestline.operators import dedup, impute as I, joins as J, profile as P, quality as Q, shape as S


def dedup_report(before: DataFrame, after: DataFrame, keys: Sequence[str] = vocab.PRICE_KEY) -> DataFrame:
    return S.union_all(P.to_metrics(dedup.duplicate_stats(before, keys), "before"),
                       P.to_metrics(dedup.duplicate_stats(after, keys), "after"))


def price_report(df: DataFrame, keys: Sequence[str] = vocab.PRICE_KEY) -> DataFrame:
    summary = P.table_summary(df, "arrival_date", ["state", "district", "market", "commodity"], keys)
    sources = P.value_counts(df, "source").select(F.col("source").alias("metric"), F.col("rows").cast("string").alias("value"))
    prices = _long(P.measure_profile(df, vocab.PRICE_MEASURES))
    return S.union_all(summary.select(F.lit("summary").alias("section"), "metric", "value"),
                       sources.select(F.lit("sources").alias("section"), "metric", "value"),
                       prices.select(F.lit("prices").alias("section"), "metric", "value"))


def weather_report(df: DataFrame, measures: Sequence[str] = vocab.WEATHER_MEASURES,
                   keys: Sequence[str] = vocab.WEATHER_KEY) -> DataFrame:
    summary = P.table_summary(df, "date", ["district"], keys)
    values = _long(P.measure_profile(df, [m for m in measures if m in df.columns], median=False))
    return S.union_all(summary.select(F.lit("summary").alias("section"), "metric", "value"),
                       values.select(F.lit("measures").alias("section"), "metric", "value"))


def _long(profile: DataFrame) -> DataFrame:
    """One row per figure, as text that keeps every digit; who shows it rounds once."""
    stats = [c for c in profile.columns if c != "column"]
    pairs = F.array(*[F.struct(F.concat_ws("_", "column", F.lit(s)).alias("metric"),
                               F.col(s).cast("string").alias("value")) for s in stats])
    return profile.select(F.explode(pairs).alias("p")).select("p.*")


def coverage_report(dim: DataFrame, prices: DataFrame, weather: DataFrame) -> DataFrame:
    """Members by status, and a recommendation for each fact table with missing members."""
    table = J.coverage(dim, prices, weather)
    status = table.groupBy("data_status").agg(F.count(F.lit(1)).cast("string").alias("value")).select(
        F.lit("coverage").alias("section"), F.col("data_status").alias("metric"), "value")
    gaps = table.agg(F.count_if(~F.col("has_prices")).alias("prices"), F.count_if(~F.col("has_weather")).alias("weather"))
    advice = P.to_metrics(gaps).filter(F.col("value") != "0").select(
        F.lit("recommendation").alias("section"), "metric",
        F.concat(F.lit("Complete coverage - missing "), F.col("value"), F.lit(" districts")).alias("value"))
    return S.union_all(status, advice)


def imputation_report(imputed: DataFrame, cols: Sequence[str]) -> DataFrame:
    return P.to_metrics(I.imputation_stats(imputed, cols), "imputation")


def training_report(predictions: DataFrame, calibration: DataFrame) -> DataFrame:
    """Metrics per horizon and the calibration as rows."""
    metrics = P.regression_metrics(predictions, "y", "yhat", ["horizon"])
    names = ["mae", "rmse", "r2", "mape", "n"]
    pairs = F.array(*[F.struct(F.lit(n).alias("metric"), F.col(n).cast("double").cast("string").alias("value"))
                      for n in names])
    by_h = metrics.select(F.concat(F.lit("horizon_"), F.col("horizon")).alias("section"), F.explode(pairs).alias("p"))
    return S.union_all(by_h.select("section", "p.*"), P.to_metrics(calibration, "calibration"))


def violations_report(df: DataFrame, rules: list[Q.Rule]) -> DataFrame:
    found = Q.violation_report(df, rules)
    return found.filter(F.col("broken") > 0).select(F.lit("violations").alias("section"), F.col("rule").alias("metric"),
                                                    F.col("broken").cast("string").alias("value"))


def completeness(facts: dict[str, DataFrame], dim: DataFrame, key: str = "district") -> DataFrame:
    """Members missing from each fact table."""
    parts = [J.missing_members(dim, t, key).select(F.lit(name).alias("table"), F.col(key).alias("missing"))
             for name, t in facts.items()]
    return S.union_all(*parts)
