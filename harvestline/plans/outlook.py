"""Price outlook of every series in one job."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from harvestline import vocab
from harvestline.operators import decisions as X, joins as J

SERIES = ["commodity", "market"]


def outlook(forecasts: DataFrame, history: DataFrame, live: DataFrame, calibration: DataFrame, days: int = 14,
            horizons: Sequence[int] = vocab.HORIZONS, as_of: Column | None = None) -> DataFrame:
    """Advice, curve, trend and key forecasts per (commodity, market).

    ``forecasts`` has rows (commodity, market, horizon, price) and should be a stored table, as it is used several times;
    ``history`` and ``live`` hold observed prices. ``calibration`` is the one row of residual quantiles.
    """
    now = J.current_value(forecasts, live, history, SERIES, "arrival_date", "modal_price")
    at = lambda h: F.max(F.when(F.col("horizon") == h, F.col("price")))
    bounded = X.with_intervals(forecasts, calibration)
    # one group per series holds its points, its best forecast and the named horizons
    series = X._points(bounded, SERIES, horizons, [X.best_of(F.col("lower"), F.col("upper")).alias("b"),
                                                   at(7).alias("_f7"), at(14).alias("_f14"), at(15).alias("_f15")])
    series = series.filter(F.size("points") > 0).withColumn("_band", calibration.select("q90").scalar())
    series = series.select(*SERIES, "_f7", "_f14", "_f15", F.col("b.price").alias("max_forecast_price"),
                           (-F.col("b.early")).alias("best_sell_day"), F.col("b.lower").alias("lower"), F.col("b.upper").alias("upper"),
                           X.curve_of(F.col("points"), F.col("_band"), days, as_of).alias("forecasts"))
    joined = now.join(series, SERIES)
    joined = joined.withColumns({**X.advice(), "price_trend": X.trend(F.element_at("forecasts", 1)["predicted_price"],
                                                                     F.element_at("forecasts", -1)["predicted_price"])})
    on_day = lambda n: F.element_at("forecasts", F.least(F.lit(n), F.size("forecasts")))["predicted_price"]
    f7 = F.coalesce(F.col("_f7"), on_day(7))
    f14 = F.coalesce(F.col("_f14"), on_day(14))
    return joined.select(
        *SERIES, F.round("current_price", 0).alias("current_price"), "price_date", "price_source", "forecasts",
        "price_trend", "recommendation", "reason", "best_sell_day", "expected_gain_pct",
        F.round(f7, 0).alias("forecast_7d"), F.round(f14, 0).alias("forecast_14d"),
        F.round(F.coalesce(F.col("_f15"), f14), 0).alias("forecast_15d"),
        X.expected_change(f14, F.col("current_price")).alias("expected_change_percent"),
        X.confidence_number(F.col("confidence")).alias("model_confidence"))
