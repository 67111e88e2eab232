"""Datasets assembled from operators: raw to canonical to joined to imputed to features."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from harvestline import vocab
from harvestline.functions import dates as D, measures as M, text as T
from harvestline.operators import dedup, impute as I, joins as J, quality as Q, shape as S, windows as W
from harvestline.operators.encode import fit_codes
from harvestline.operators.quantiles import trim_quantiles
from harvestline.sources import sinks


def standardize_prices(raw: DataFrame, source: str, scope: str, ingested_at: str) -> DataFrame:
    """One raw price table in the canonical layout, cut to the scope. A null stays null, never the text of one."""
    named = S.rename_by_alias(raw, vocab.PRICE_ALIASES)
    S.require(named, vocab.PRICE_REQUIRED)
    if "district_raw" not in named.columns:
        named = named.withColumn("district_raw", F.col("district"))
    if dict(named.dtypes)["arrival_date"] == "string":
        named = named.withColumn("arrival_date", D.parse_date(F.col("arrival_date")))
    texts = [c for c, t in vocab.PRICE_COLUMNS.items() if t == "string" and c in named.columns]
    named = named.withColumns({c: T.null_if_blank(F.col(c).cast("string")) for c in texts})
    numbers = [c for c, t in vocab.PRICE_COLUMNS.items() if t == "double" and c in named.columns]
    named = named.withColumns({c: M.number(F.col(c)) for c in numbers})
    tagged = S.add_ingestion_metadata(S.keep_scope(named, "state", scope), source, ingested_at)
    return S.conform(tagged, vocab.PRICE_COLUMNS)


def canonical_prices(tables: Sequence[DataFrame], aliases: DataFrame) -> DataFrame:
    """Standardised tables united, districts mapped, unmapped rows dropped, one row per natural key."""
    mapped = J.normalize_key(S.union_all(*tables), "district", aliases)
    return dedup.dedup_priority(S.drop_unmapped(mapped, "district"))


def canonical_weather(raw: DataFrame, aliases: DataFrame, forecast: bool = False) -> DataFrame:
    """Weather files in the canonical layout, districts mapped, one row per day and district.

    With a ``file_time`` column the newest file wins; a forecast is saved again every run.
    """
    schema = vocab.FORECAST_COLUMNS if forecast else vocab.WEATHER_COLUMNS
    named = S.rename_by_alias(raw, vocab.FORECAST_ALIASES if forecast else vocab.WEATHER_ALIASES)
    if dict(named.dtypes)["date"] == "string":
        named = named.withColumn("date", D.parse_date(F.col("date"), vocab.WEATHER_DATE_FORMATS))
    numbers = [c for c, t in schema.items() if t == "double" and c in named.columns]
    named = named.withColumns({c: M.without_sentinel(M.number(F.col(c))) for c in numbers})
    mapped = S.drop_unmapped(J.normalize_key(named, "district", aliases), "district")
    newest = "file_time" if "file_time" in mapped.columns else None
    return S.conform(dedup.dedup_observations(mapped, measures=list(schema), newest=newest), schema)


def serving_forecast(forecast: DataFrame) -> DataFrame:
    """Forecast columns under the names of observations, mean temperature from the extremes."""
    renamed = forecast.withColumnsRenamed({"temperature_max": "t2m_max", "temperature_min": "t2m_min",
                                           "precipitation_sum": "precipitation"})
    return renamed.withColumn("t2m_mean", (F.col("t2m_max") + F.col("t2m_min")) / 2)


def price_only(prices: DataFrame, day: str = "arrival_date") -> DataFrame:
    """Canonical prices with calendar and spread columns."""
    d = F.col(day)
    cal = {k: v for k, v in D.calendar(d).items() if k.endswith(("year", "month", "day_of_week", "week_of_year"))}
    return prices.withColumns({**cal, "price_spread": M.spread(F.col("max_price"), F.col("min_price")),
                               "price_spread_pct": M.spread_pct(F.col("max_price"), F.col("min_price"),
                                                                F.col("modal_price"))})


def joined(prices: DataFrame, weather: DataFrame, first_year: int = 2016, dow_base: str = "monday") -> DataFrame:
    """Prices from ``first_year`` with the weather of their day and district."""
    d = F.col("arrival_date")
    recent = S.from_year(prices, "arrival_date", first_year)
    out = J.join_daily(recent, weather).withColumns({
        "arrival_year": F.year(d), "arrival_month": F.month(d), "arrival_day_of_week": D.day_of_week(d, dow_base),
        "arrival_week_of_year": F.weekofyear(d),
        "price_spread": M.spread(F.col("max_price"), F.col("min_price"))})
    return out.withColumnRenamed("source", "price_source")


def model_table(joined_rows: DataFrame, order: Sequence[str] = ("market", "commodity")) -> DataFrame:
    """Joined rows with weather gaps filled and derived columns added."""
    cols = [c for c in vocab.JOINED_WEATHER.values() if c in joined_rows.columns]
    filled = I.impute(joined_rows, cols, order=order)
    d = F.col("arrival_date")
    width = M.spread(F.col("max_price"), F.col("min_price"))
    return filled.withColumns({
        "price_range": width,
        "price_volatility": M.spread_pct(F.col("max_price"), F.col("min_price"), F.col("modal_price")),
        **D.flags(d), "season": D.season(d)})


def training_table(model_rows: DataFrame, order: Sequence[Column | str], features: Sequence[str],
                   max_null: float = 0.3) -> tuple[DataFrame, DataFrame]:
    """Trimmed rows with every feature, target and category code, and the fitted code table."""
    trimmed = trim_quantiles(model_rows, "modal_price")
    featured = W.calendar_features(W.features_and_targets(trimmed, order))
    categories = [c for c in ("district", "market", "commodity", "variety", "grade") if c in featured.columns]
    codes = fit_codes(featured, categories)
    coded = J.apply_codes(featured, codes, categories)
    return S.max_null_fraction(coded, [f for f in features if f in coded.columns], max_null), codes


def colocated(prices: DataFrame, weather: DataFrame, prices_path: str, weather_path: str, buckets: int,
              rename: dict[str, str] = vocab.JOINED_WEATHER) -> DataFrame:
    """Prices with their daily observation, from two tables that are bucketed by district and day: written once, joined (also
    again and again) without moving a row of either."""
    keys = ["district", "_day"]
    p = sinks.write_bucketed(prices.withColumn("_day", F.to_date("arrival_date")), prices_path, keys, buckets)
    measures = [F.col(c).alias(f"_w_{n}") for c, n in rename.items() if c in weather.columns]
    w = sinks.write_bucketed(weather.select("district", F.to_date("date").alias("_day"), *measures, F.lit(1).alias("has_weather")), weather_path, keys, buckets)
    found = p.join(w.hint("merge"), keys, "left")
    return found.select(*prices.columns, *[F.col(f"_w_{n}").alias(n) for c, n in rename.items() if c in weather.columns],
                        F.coalesce("has_weather", F.lit(0)).alias("has_weather"))


STEPS = ["prices", "weather", "joined", "model"]


def build(inputs: dict[str, DataFrame], aliases: DataFrame, dim: DataFrame, scope: str, ingested_at: str,
          write=None, steps: Sequence[str] = STEPS, first_year: int = 2016, dry_run: bool = False
          ) -> dict[str, DataFrame]:
    """Every requested step as a table; ``write(name, df)`` stores a step and returns the stored table.

    ``inputs``: raw ``history`` and ``current`` prices and raw ``weather``, or already built step tables. A dry run only
    plans. The price table is stored only if its keys, districts and scope pass the gate.
    """
    unknown = [s for s in steps if s not in STEPS]
    if unknown:
        raise ValueError(f"unknown steps: {unknown}")
    out = dict(inputs)
    if "prices" in steps:
        raw = [standardize_prices(inputs[s], s, scope, ingested_at) for s in ("history", "current") if s in inputs]
        out["prices"] = canonical_prices(raw, aliases)
    if "weather" in steps:
        out["weather"] = canonical_weather(inputs["weather"], aliases)
    if "prices" in steps and not dry_run:
        if write:
            out["prices"] = write("prices_checked", out["prices"])
        gate = Q.output_gate(out["prices"], vocab.PRICE_KEY, dim, "district", "state", scope).first()
        if not gate["passed"]:
            raise ValueError(f"price table fails its gate: {gate.asDict()}")
    if "weather" in steps and write and not dry_run:
        out["weather"] = write("weather_checked", out["weather"])
    if "joined" in steps:
        out["joined"] = joined(out["prices"], out["weather"], first_year)
        if write and not dry_run:
            out["joined"] = write("joined", out["joined"])
    if "model" in steps:
        if dry_run:
            # Filling needs medians of the data, so a dry run stops at the plan of its input.
            out["model"] = out["joined"]
        else:
            out["model"] = model_table(out["joined"])
            if write:
                out["model"] = write("model", out["model"])
    return {s: out[s] for s in steps}
