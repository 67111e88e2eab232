"""Date functions over columns."""

from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from harvestline import vocab


def _shape(fmt: str) -> str:
    """A pattern for the texts a format can read: counts of digits and letters around its separators."""
    parts = re.findall(r"y+MM+d+|[a-zA-Z]+|[^a-zA-Z]+", fmt)
    shapes = {"yyyyMMdd": r"\d{8}", "yyyy": r"\d{4}", "MMM": r"\p{L}{3,4}", "MMMM": r"\p{L}{3,}"}
    return "^" + "".join(shapes.get(p, r"\d{1,2}") if p.isalpha() else re.escape(p) for p in parts) + "$"


def try_format(text: Column, fmt: str) -> Column:
    """Timestamp read with one format, null if it does not fit.

    The cheap look at the shape comes first: a failed parse raises and catches an exception for every row.
    """
    return F.when(text.rlike(_shape(fmt)), F.try_to_timestamp(text, F.lit(fmt)))


def parse_date(c: Column, formats: list[str] = vocab.PRICE_DATE_FORMATS) -> Column:
    """First format that reads the text, tried in order for every row; null when none does."""
    text = F.trim(c)
    return F.coalesce(*[try_format(text, f).cast("date") for f in formats],
                      F.try_to_timestamp(text).cast("date"))


def format_shares(df: DataFrame, col: str, formats: list[str]) -> DataFrame:
    """One row: the share of rows each format can read, by one pass over the column."""
    text = F.trim(F.col(col).cast("string"))
    hits = [F.try_divide(F.count(try_format(text, f)), F.count(F.lit(1))).alias(f) for f in formats]
    return df.agg(*hits)


def parse_date_by_consensus(df: DataFrame, col: str, formats: list[str] = vocab.RAW_DATE_FORMATS,
                            min_share: float = 0.5) -> DataFrame:
    """Read the whole column with the first format that fits more than ``min_share`` of the rows.

    With no such format the last one applies, and if even that reads nothing, the session's own parser.
    """
    shares = format_shares(df, col, formats).first()
    chosen = next((f for f in formats if (shares[f] or 0.0) > min_share), None)
    if chosen is None and (shares[formats[-1]] or 0.0) > 0.0:
        chosen = formats[-1]
    text = F.trim(F.col(col).cast("string"))
    parsed = try_format(text, chosen) if chosen else F.try_to_timestamp(text)
    return df.withColumn(col, parsed.cast("date"))


def from_epoch_days(c: Column) -> Column:
    return F.date_add(F.to_date(F.lit("1970-01-01")), F.floor(c).cast("int"))


def day_of_week(d: Column, base: str = "monday") -> Column:
    """0-based day of week; ``base`` names the day numbered 0."""
    return F.weekday(d) if base == "monday" else F.dayofweek(d) - 1


def calendar(d: Column, prefix: str = "arrival_") -> dict[str, Column]:
    return {
        f"{prefix}year": F.year(d),
        f"{prefix}month": F.month(d),
        f"{prefix}day_of_week": day_of_week(d),
        f"{prefix}week_of_year": F.weekofyear(d),
        f"{prefix}day_of_month": F.dayofmonth(d),
        f"{prefix}quarter": F.quarter(d),
    }


def flags(d: Column) -> dict[str, Column]:
    return {
        "is_month_start": (F.dayofmonth(d) <= 5).cast("int"),
        "is_month_end": (F.dayofmonth(d) >= 25).cast("int"),
        "is_weekend": (F.weekday(d) >= 5).cast("int"),
    }


def season(d: Column) -> Column:
    month = F.month(d)
    return (F.when(month.between(6, 9), "kharif").when((month >= 10) | (month <= 2), "rabi")
            .when(month.isNotNull(), "summer"))


def season_code(d: Column) -> Column:
    name = season(d)
    return F.when(name == "kharif", 0).when(name == "rabi", 1).when(name == "summer", 2)


def cyclic(position: Column, period: int, name: str) -> dict[str, Column]:
    angle = position * F.lit(2.0) * F.pi() / F.lit(float(period))
    return {f"{name}_sin": F.sin(angle), f"{name}_cos": F.cos(angle)}


def default_range(today: dt.date, days: int, delay: int = 2) -> tuple[dt.date, dt.date]:
    """The newest complete day (observations lag by ``delay`` days) and the day ``days`` before it."""
    end = today - dt.timedelta(days=delay)
    return end - dt.timedelta(days=days), end


def date_spine(spark: SparkSession, start: dt.date, end: dt.date) -> DataFrame:
    days = F.sequence(F.lit(start), F.lit(end), F.expr("interval 1 day"))
    return spark.range(1).select(F.explode(days).alias("date"))


def spine_per_key(df: DataFrame, key: list[str], col: str) -> DataFrame:
    """One row for every key and every day between its first and last date."""
    spans = df.groupBy(*key).agg(F.min(col).alias("_from"), F.max(col).alias("_to"))
    return spans.select(*key, F.explode(F.sequence("_from", "_to", F.expr("interval 1 day"))).alias(col))
