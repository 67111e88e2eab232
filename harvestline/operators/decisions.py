"""From horizon forecasts to daily curves, intervals, hold/sell advice and trend labels."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from harvestline import vocab


def with_intervals(forecasts: DataFrame, calibration: DataFrame, confidence: float = 0.9,
                   by: Sequence[str] = ()) -> DataFrame:
    """Symmetric bounds from calibrated residual quantiles; an uncalibrated confidence uses the 90 % quantile."""
    key = f"q{int(confidence * 100)}"
    key = key if key in calibration.columns else "q90"
    if by:
        wide = forecasts.join(calibration.select(*by, F.col(key).alias("_band")), list(by), "left")
    else:
        wide = forecasts.withColumn("_band", calibration.select(key).scalar())
    return (wide.withColumns({"lower": F.col("price") - F.col("_band"), "upper": F.col("price") + F.col("_band")})
            .drop("_band"))


def _points(forecasts: DataFrame, keys: Sequence[str], horizons: Sequence[int], extra: Sequence[Column]) -> DataFrame:
    """One row per series with its (horizon, price) points in order."""
    by_h = [F.max(F.when(F.col("horizon") == h, F.col("price"))) for h in horizons]
    points = F.array(*[F.when(p.isNotNull(), F.struct(F.lit(h).alias("h"), p.alias("p")))
                       for h, p in zip(horizons, by_h)])
    return forecasts.groupBy(*keys).agg(F.array_compact(points).alias("points"), *extra)


def curve_of(points: Column, band: Column, days: int, as_of: Column | None = None) -> Column:
    """The daily curve as an array: prices for days 1..``days`` by linear interpolation between the points, flat beyond
    the outer ones, with bounds that widen from ``band`` at a week up to three times as much."""
    def at(day: Column) -> Column:
        lo = F.coalesce(F.try_element_at(F.filter(points, lambda x: x["h"] <= day), F.lit(-1)), F.element_at(points, 1))
        hi = F.coalesce(F.try_element_at(F.filter(points, lambda x: x["h"] >= day), F.lit(1)), F.element_at(points, -1))
        step = F.try_divide(day - lo["h"], hi["h"] - lo["h"])
        price = F.when(lo["h"] == hi["h"], lo["p"]).otherwise(lo["p"] + step * (hi["p"] - lo["p"]))
        wide = band * F.least(day / 7, F.lit(3.0))
        return F.struct(day.alias("day"), F.round(price, 0).alias("predicted_price"), F.round(price - wide, 0).alias("lower_bound"),
                        F.round(price + wide, 0).alias("upper_bound"),
                        F.round(F.greatest(F.lit(70.0), 95.0 - day * 1.2), 1).alias("confidence"),
                        *([F.date_add(as_of, day).alias("date")] if as_of is not None else []))

    return F.transform(F.sequence(F.lit(1), F.lit(days)), at)


def daily_curve(forecasts: DataFrame, keys: Sequence[str], q90: Column, days: int = 14,
                horizons: Sequence[int] = vocab.HORIZONS, as_of: Column | None = None) -> DataFrame:
    """A row for every series and day of its curve."""
    spread = _points(forecasts, keys, horizons, []).filter(F.size("points") > 0).withColumn("_band", q90)
    return spread.select(*keys, F.inline(curve_of(F.col("points"), F.col("_band"), days, as_of)))


def recommend(forecasts: DataFrame, keys: Sequence[str], threshold: float = vocab.GAIN_THRESHOLD_PCT) -> DataFrame:
    """HOLD when the best horizon gains more than the threshold, else SELL. Equal prices prefer the earlier horizon.

    Input rows: keys, horizon, price, current_price and optionally lower and upper.
    """
    has_band = "lower" in forecasts.columns
    band = [F.col("lower"), F.col("upper")] if has_band else [F.lit(None).cast("double").alias("lower"),
                                                               F.lit(None).cast("double").alias("upper")]
    out = forecasts.groupBy(*keys).agg(best_of(*band).alias("b"), F.max("current_price").alias("current_price"))
    out = out.select(*keys, "current_price", F.col("b.price").alias("max_forecast_price"),
                     (-F.col("b.early")).alias("best_sell_day"), F.col("b.lower").alias("lower"), F.col("b.upper").alias("upper"))
    return out.withColumns(advice(has_band, threshold))


def best_of(lower: Column, upper: Column) -> Column:
    """Aggregate: the best price of a series, of equal ones the earliest."""
    return F.max(F.struct("price", (-F.col("horizon")).alias("early"), lower.alias("lower"), upper.alias("upper")))


def advice(has_band: bool = True, threshold: float = vocab.GAIN_THRESHOLD_PCT) -> dict[str, Column]:
    """Advice columns from ``max_forecast_price``, ``best_sell_day``, ``lower``, ``upper`` and ``current_price``."""
    now = F.col("current_price")
    g = F.try_divide(F.col("max_forecast_price") - now, now) * 100
    safe = F.try_divide(F.col("lower") - now, now) * 100
    text = F.coalesce(F.format_string(" (90%% CI: %.0f-%.0f)", "lower", "upper"), F.lit("")) if has_band else F.lit("")
    return {
        "expected_gain_pct": g,
        "recommendation": F.when(g > threshold, "HOLD").otherwise("SELL"),
        "confidence": (F.when(F.col("lower").isNull(), "unknown").when(safe > threshold, "high")
                       .when(g > threshold, "medium").otherwise("low")),
        "reason": (F.when(g > threshold, F.concat(F.format_string("Price expected to rise %.1f%% in %d days", g,
                                                                  "best_sell_day"), text))
                   .when(g < -threshold, F.concat(F.format_string("Price expected to fall %.1f%% - sell now",
                                                                  F.abs(g)), text))
                   .otherwise(F.format_string("Price stable (±%.1f%%) - no significant gain expected", F.abs(g)))),
    }


def trend(first: Column, last: Column, band: float = vocab.TREND_BAND) -> Column:
    return F.when(last > first * (1 + band), "up").when(last < first * (1 - band), "down").otherwise("stable")


def trend_of(curve: DataFrame, keys: Sequence[str], band: float = vocab.TREND_BAND) -> DataFrame:
    """Up, down or stable by the last against the first day of a curve."""
    ends = curve.groupBy(*keys).agg(F.min_by("predicted_price", "day").alias("first"),
                                    F.max_by("predicted_price", "day").alias("last"))
    return ends.withColumn("price_trend", trend(F.col("first"), F.col("last"), band))


def expected_change(forecast: Column, current: Column) -> Column:
    return F.round(F.coalesce(F.try_divide(forecast - current, current) * 100, F.lit(0.0)), 2)


def confidence_number(level: Column) -> Column:
    out = F.lit(vocab.CONFIDENCE_OTHER)
    for name, value in vocab.CONFIDENCE_NUMBER.items():
        out = F.when(level == name, value).otherwise(out)
    return out
