"""Aggregations: dimensions, profiles, counts, metrics and coverage."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from harvestline.operators.dedup import duplicate_stats
from harvestline.operators.quantiles import quantile_table
from harvestline.operators.shape import last_n_days, only


def commodity_dimension(df: DataFrame, cap: int = 10) -> DataFrame:
    """Code, varieties (at most ``cap`` listed, all counted) and rows per commodity.

    Varieties are made distinct first and limited before the shuffle, so a list never holds more than ``cap`` values.
    """
    per_variety = df.groupBy("commodity", "variety").agg(F.min("commodity_code").alias("code"),
                                                         F.count("*").alias("rows"))
    named = F.col("variety").isNotNull()
    listed = (per_variety.filter(named).withColumn(
        "_rn", F.row_number().over(Window.partitionBy("commodity").orderBy("variety"))).filter(F.col("_rn") <= cap)
        .groupBy("commodity").agg(F.array_sort(F.collect_list("variety")).alias("varieties")))
    totals = per_variety.groupBy("commodity").agg(
        F.min("code").alias("commodity_code"), F.count_if(named).alias("distinct_varieties"),
        F.sum("rows").alias("total_records"))
    empty = F.array().cast("array<string>")
    listed = listed.withColumnRenamed("commodity", "_c")
    return (totals.join(listed, F.col("commodity").eqNullSafe(F.col("_c")), "left").drop("_c").withColumn("varieties", F.coalesce("varieties", empty))
            .withColumn("variety_count", F.size("varieties")))


def distinct_counts(df: DataFrame, cols: Sequence[str], approximate: bool = False) -> DataFrame:
    count = F.approx_count_distinct if approximate else F.countDistinct
    return df.agg(*[count(c).alias(f"unique_{c}") for c in cols])


def date_range(df: DataFrame, day: str, by: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*by).agg(F.min(day).alias("date_min"), F.max(day).alias("date_max"),
                               F.countDistinct(F.to_date(F.col(day))).alias("days"))


def value_counts(df: DataFrame, col: str, k: int | None = None) -> DataFrame:
    counts = df.groupBy(col).agg(F.count("*").alias("rows")).orderBy(F.desc("rows"), F.col(col).asc_nulls_last())
    return counts.limit(k) if k else counts


def measure_profile(df: DataFrame, cols: Sequence[str], median: bool = True) -> DataFrame:
    """Mean, minimum, maximum, null share and exact median of each column as rows."""
    stats = df.agg(*[a for c in cols for a in (
        F.avg(c).alias(f"{c}|mean"), F.min(c).alias(f"{c}|min"), F.max(c).alias(f"{c}|max"),
        (F.avg(F.col(c).isNull().cast("int")) * 100).alias(f"{c}|null_pct"))])
    rows = F.array(*[F.struct(F.lit(c).alias("column"), *[F.col(f"`{c}|{s}`").cast("double").alias(s)
                                                          for s in ("mean", "min", "max", "null_pct")])
                     for c in cols])
    out = stats.select(F.explode(rows).alias("r")).select("r.*")
    if not median:
        return out
    middle = quantile_table(df, cols, [0.5]).select("column", F.col("value").alias("median"))
    return out.join(middle, "column", "left")


def table_summary(df: DataFrame, day: str, uniques: Sequence[str], keys: Sequence[str]) -> DataFrame:
    """Rows, date range, distinct counts and duplicate rows of one table as (metric, value) rows."""
    base = df.agg(F.count("*").alias("total_rows"), F.min(day).cast("date").cast("string").alias("date_min"),
                  F.max(day).cast("date").cast("string").alias("date_max"),
                  F.countDistinct(F.to_date(F.col(day))).alias("unique_dates"),
                  *[F.countDistinct(c).alias(f"unique_{c}") for c in uniques])
    dups = duplicate_stats(df, keys).select("duplicate_rows", "duplicate_keys", "rows_to_remove")
    return to_metrics(base).unionByName(to_metrics(dups))


def to_metrics(one_row: DataFrame, section: str | None = None) -> DataFrame:
    """A one-row table as (metric, value) text rows."""
    pairs = F.array(*[F.struct(F.lit(c).alias("metric"), F.col(c).cast("string").alias("value"))
                      for c in one_row.columns])
    out = one_row.select(F.explode(pairs).alias("p")).select("p.*")
    return out.select(F.lit(section).alias("section"), "metric", "value") if section else out


def group_stats(df: DataFrame, by: Sequence[str], day: str, uniques: Sequence[str]) -> DataFrame:
    return df.groupBy(*by).agg(F.count("*").alias("rows"), *[F.countDistinct(c).alias(f"unique_{c}") for c in uniques],
                               F.min(day).alias("date_min"), F.max(day).alias("date_max"))


def price_trend(df: DataFrame, commodity: str, days: int = 30, day: str = "arrival_date",
                price: str = "modal_price") -> DataFrame:
    """Average price per date of one commodity over the last days of the table."""
    recent = only(last_n_days(df, day, days), commodity=commodity)
    return recent.groupBy(F.col(day).alias("date")).agg(F.round(F.avg(price), 0).alias("price"))


def daily_average(df: DataFrame, by: Sequence[str], price: str = "modal_price") -> DataFrame:
    return df.groupBy(*by).agg(F.avg(price).alias("avg_price"), F.count("*").alias("rows"))


def top_groups(df: DataFrame, col: str, k: int, **equals: object) -> DataFrame:
    return value_counts(only(df, **equals), col, k)


def monthly_stats(df: DataFrame, by: str = "district", day: str = "arrival_date",
                  price: str = "modal_price") -> DataFrame:
    return df.groupBy(by, F.year(day).alias("year"), F.month(day).alias("month")).agg(
        F.avg(price).alias("mean"), F.stddev_samp(price).alias("std"), F.count(price).alias("count"))


def calibrate(df: DataFrame, y: str, yhat: str, by: Sequence[str] = (),
              probs: Sequence[float] = (0.8, 0.9, 0.95)) -> DataFrame:
    """Quantiles, mean and population deviation of the absolute residual."""
    residuals = df.withColumn("residual", F.abs(F.col(y) - F.col(yhat))).filter(F.col("residual").isNotNull())
    spread = [F.avg("residual").alias("mean_residual"), F.stddev_pop("residual").alias("std_residual"), F.count("*").alias("rows")]
    levels = [F.max(F.when(F.col("prob") == p, F.col("value"))).alias(f"q{round(p * 100)}") for p in probs]
    if by:
        at = quantile_table(residuals, ["residual"], probs, by).groupBy(F.struct(*by).alias("_k")).agg(*levels)
        found = residuals.groupBy(F.struct(*by).alias("_k")).agg(*spread).join(at, "_k")  # in a struct null equals null
        return found.select("_k.*", *[c for c in found.columns if c != "_k"])
    wide = quantile_table(residuals, ["residual"], probs).agg(*levels)
    one = residuals.agg(*spread)
    return wide.withColumns({c: one.select(c).scalar() for c in ("mean_residual", "std_residual", "rows")})


def regression_metrics(df: DataFrame, y: str, yhat: str, by: Sequence[str] = ()) -> DataFrame:
    """MAE, RMSE, R2 and MAPE (denominator at least 1)."""
    ok = df.filter(F.col(y).isNotNull() & F.col(yhat).isNotNull())
    error = F.col(y) - F.col(yhat)
    return ok.groupBy(*by).agg(
        F.avg(F.abs(error)).alias("mae"), F.sqrt(F.avg(error * error)).alias("rmse"),
        (1 - F.try_divide(F.avg(error * error), F.var_pop(y))).alias("r2"),
        (F.avg(F.abs(error / F.greatest(F.col(y), F.lit(1.0)))) * 100).alias("mape"), F.count("*").alias("n"))


def confusion(df: DataFrame, y: str, yhat: str) -> DataFrame:
    return df.groupBy(F.col(y).alias("y"), F.col(yhat).alias("yhat")).agg(F.count("*").alias("n"))


def class_report(df: DataFrame, y: str, yhat: str) -> DataFrame:
    """Precision, recall, F1 and support of each class; a ratio without cases is 0."""
    cells = confusion(df, y, yhat)
    sides = cells.select(F.explode(F.array(
        F.struct(F.col("y").alias("class"), F.col("n").alias("support"), F.lit(0).cast("long").alias("predicted"),
                 F.when(F.col("y") == F.col("yhat"), F.col("n")).otherwise(0).alias("hit")),
        F.struct(F.col("yhat").alias("class"), F.lit(0).cast("long").alias("support"),
                 F.col("n").alias("predicted"), F.lit(0).cast("long").alias("hit")))).alias("s")).select("s.*")
    zero = lambda c: F.coalesce(c, F.lit(0.0))
    by_class = sides.groupBy("class").agg(F.sum("support").alias("support"), F.sum("predicted").alias("predicted"),
                                          F.sum("hit").alias("hit"))
    rated = by_class.withColumns({"precision": zero(F.try_divide(F.col("hit"), F.col("predicted"))),
                                  "recall": zero(F.try_divide(F.col("hit"), F.col("support")))})
    f1 = F.try_divide(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall"))
    return rated.withColumn("f1", zero(f1)).select("class", "support", "predicted", "hit", "precision", "recall", "f1")


def classification_metrics(df: DataFrame, y: str, yhat: str, focus: object | None = None) -> DataFrame:
    """Accuracy, macro and weighted F1, and the recall of one class."""
    rep = class_report(df, y, yhat)
    aggs = [F.try_divide(F.sum("hit"), F.sum("support")).alias("accuracy"), F.avg("f1").alias("f1_macro"),
            F.try_divide(F.sum(F.col("f1") * F.col("support")), F.sum("support")).alias("f1_weighted")]
    if focus is not None:
        aggs.append(F.coalesce(F.max(F.when(F.col("class") == focus, F.col("recall"))), F.lit(0.0)).alias("recall_focus"))
    return rep.agg(*aggs, F.sum("support").alias("n"))


def discover(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Every distinct value of the columns with its number of rows, in one scan."""
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in cols])
    return (df.select(F.explode(pairs).alias("p")).select("p.*").filter(F.col("value").isNotNull())
            .groupBy("column", "value").agg(F.count("*").alias("rows")))


def mapping_report(df: DataFrame, raw: str, mapped: str) -> DataFrame:
    return df.groupBy(F.col(raw).alias("raw"), F.col(mapped).alias("mapped")).agg(F.count("*").alias("rows"))


def null_profile(df: DataFrame, critical: Sequence[str] = (), limit_pct: float = 10.0) -> DataFrame:
    """Null count and share per column, one pass; ``warn`` marks critical columns above the limit."""
    counts = df.agg(F.count("*").alias("_n"), *[F.count_if(F.col(f"`{c}`").isNull()).alias(c) for c in df.columns])
    rows = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").alias("nulls"),
                              F.coalesce(F.try_divide(F.col(f"`{c}`") * 100.0, F.col("_n")), F.lit(0.0)).alias("null_pct"))
                     for c in df.columns])
    return (counts.select(F.explode(rows).alias("r")).select("r.*")
            .withColumn("warn", F.col("column").isin(list(critical)) & (F.col("null_pct") > limit_pct)))


def scope_share(df: DataFrame, inside: Column) -> DataFrame:
    return df.agg(F.count("*").alias("rows"), F.count_if(inside).alias("in_scope"),
                  F.coalesce(F.avg(F.coalesce(inside, F.lit(False)).cast("int")) * 100, F.lit(0.0)).alias("in_scope_pct"))


def dashboard(df: DataFrame) -> DataFrame:
    return df.agg(F.format_string("%.1fM+", F.count("*") / F.lit(1e6)).alias("total_records"),
                  F.countDistinct("market").alias("total_markets"),
                  F.countDistinct("commodity").alias("total_commodities"),
                  F.countDistinct("district").alias("total_districts"))


def share(df: DataFrame, value: str) -> DataFrame:
    """Each value as a share of the column total."""
    total = df.agg(F.sum(value).alias("total")).scalar()
    return df.withColumn("share", F.try_divide(F.col(value), total))


def snapshot_counts(df: DataFrame, partition: str = "partition_date", k: int = 10) -> DataFrame:
    counts = df.groupBy(partition).agg(F.count("*").alias("rows"))
    return counts.orderBy(F.desc(partition)).limit(k)


def file_stats(df: DataFrame, kept: Column, bad: Column) -> DataFrame:
    """Rows read, kept, dropped and unreadable per input file (a ``file`` column names it)."""
    k, b = F.coalesce(kept, F.lit(False)), F.coalesce(bad, F.lit(False))
    return df.groupBy("file").agg(F.count("*").alias("read"), F.count_if(k & ~b).alias("kept"),
                                  F.count_if(~k & ~b).alias("dropped"), F.count_if(b).alias("errors"))


def ranked(df: DataFrame, value: str, by: Sequence[str]) -> DataFrame:
    """Rank by falling value inside each group of an aggregated table."""
    return df.withColumn("rank", F.rank().over(Window.partitionBy(*by).orderBy(F.desc(value))))
