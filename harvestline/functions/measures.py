"""Numeric functions over columns."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column, functions as F

from harvestline import vocab


def number(c: Column) -> Column:
    """Text that is no number becomes null."""
    return F.trim(c.cast("string")).try_cast("double")


def without_sentinel(c: Column, sentinel: float = -999.0) -> Column:
    return F.nullif(c, F.lit(sentinel))


def spread(hi: Column, lo: Column) -> Column:
    return hi - lo


def spread_pct(hi: Column, lo: Column, base: Column) -> Column:
    return F.round(F.try_divide(hi - lo, base) * 100, 2)


def mean_of_extremes(mean: Column, hi: Column, lo: Column) -> Column:
    return F.coalesce(mean, (hi + lo) / 2)


def growing_degree_days(hi: Column, lo: Column, base: float = 10.0) -> Column:
    excess = (hi + lo) / 2 - base
    return F.when(excess.isNotNull(), F.greatest(F.lit(0.0), excess))


def vapour_pressure_deficit(t: Column, rh: Column) -> Column:
    """Saturation pressure (Tetens, kPa) times the missing share of humidity."""
    saturated = 0.6108 * F.exp(F.try_divide(17.27 * t, t + 237.3))
    return saturated * (1 - rh / 100)


def drought_index(vpd: Column, rain_7d: Column) -> Column:
    return F.try_divide(vpd, 1 + rain_7d / 50)


def completeness(*cols: Column) -> Column:
    return reduce(add, [c.isNotNull().cast("int") for c in cols])


def clamp(c: Column, lo: Column, hi: Column) -> Column:
    return F.when(c.isNotNull(), F.greatest(F.least(c, hi), lo))


def source_rank(c: Column, ranks: dict[str, int] = vocab.SOURCE_RANK) -> Column:
    ranked = F.lit(0)
    for name, rank in ranks.items():
        ranked = F.when(c == name, rank).otherwise(ranked)
    return ranked


def data_status(has_prices: Column, has_weather: Column) -> Column:
    return (F.when(has_prices & has_weather, "full").when(has_weather, "weather_only")
            .when(has_prices, "prices_only").otherwise("none"))


def distinct_sorted(c: Column, cap: int | None = None) -> Column:
    values = F.array_sort(F.array_distinct(c))
    return F.slice(values, 1, cap) if cap else values


def mentions(texts: Column, word: str) -> Column:
    return F.exists(texts, lambda t: F.contains(F.lower(t), F.lit(word)))
