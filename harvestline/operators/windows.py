"""Time-series features over row windows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, Window, functions as F

from harvestline import vocab
from harvestline.functions import dates as D, measures as M
from harvestline.operators.dedup import keep_first
from harvestline.operators.ordered import BLOCK_ROWS, over_rows, series_hash, with_stages
from harvestline.operators.quantiles import medians

SERIES = ["commodity", "market"]


def _stat(fn: str, value: Column, frame: Window) -> Column:
    return {"mean": F.avg, "std": F.stddev_samp, "min": F.min, "max": F.max, "sum": F.sum}[fn](value).over(frame)


def lag_columns(w: Window, col: str, ns: Sequence[int] = vocab.LAGS) -> dict[str, Column]:
    return {f"price_lag_{n}d": F.lag(col, n).over(w) for n in ns}


def _named(n: int, part: str, at: int | None = None) -> str:
    return f"_roll_{n}_{part}" if at is None else f"_roll_{n}_{part}_{at}"


PARTS = ("n", "sum", "mean", "m2", "lo", "hi")


def frame_stages(w: Window, col: str, ns: Sequence[int]) -> list[dict[str, Column]]:
    """Stages of helper columns with count, sum, mean, squared deviations and extremes of the ``n`` rows before the current one.

    A frame is put together from shorter ones: 14 rows are the 7 before this row and the 7 before the row 7 earlier. So a row
    costs a few lags and merges for each frame and not a pass over the frame. Merged deviations do not cancel, and a
    frame of equal values has a deviation of exactly zero.
    """
    wanted: list[int] = []
    for n in sorted(set(ns)):
        while n > 4 * max(wanted, default=1):
            wanted.append(4 * max(wanted, default=1))
        wanted.append(n)
    known: list[int] = []
    stages: list[dict[str, Column]] = []
    for n in wanted:
        lags, parts, at = {}, [], 0
        while at < n:
            size = max((k for k in known if k <= n - at), default=1)
            if size == 1:
                name = _named(n, "value", at)
                lags[name], value = F.lag(col, at + 1).over(w), F.col(name)
                number = value.cast("double")
                parts.append({"n": value.isNotNull().cast("int"), "sum": number, "mean": number,
                              "m2": F.when(value.isNotNull(), number - number), "lo": value, "hi": value})
            else:
                if at:
                    lags |= {_named(n, p, at): F.lag(_named(size, p), at).over(w) for p in PARTS}
                parts.append({p: F.col(_named(n, p, at) if at else _named(size, p)) for p in PARTS})
            at += size
        known.append(n)
        each = lambda p, parts=parts: [x[p] for x in parts]
        total = lambda cols: reduce(add, [F.coalesce(c, F.lit(0)) for c in cols])
        near = F.coalesce(*each("mean"))
        of = lambda p, n=n: F.col(_named(n, p))
        ends = {"lo": F.least, "hi": F.greatest}
        stages += [lags, {_named(n, "n"): total(each("n")), _named(n, "sum"): total(each("sum")), _named(n, "near"): near,
                          **{_named(n, p): fn(*each(p)) if len(parts) > 1 else parts[0][p] for p, fn in ends.items()}},
                   {_named(n, "mean"): of("near") + total([x["n"] * (x["mean"] - of("near")) for x in parts]) / F.greatest(of("n"), F.lit(1))},
                   {_named(n, "m2"): total([x["m2"] + x["n"] * (x["mean"] - of("mean")) * (x["mean"] - of("mean")) for x in parts])}]
    return stages


def _frame_mean(n: int) -> Column:
    return F.when(F.col(_named(n, "n")) > 0, F.col(_named(n, "sum")) / F.col(_named(n, "n")))


def _frame_std(n: int) -> Column:
    return F.when(F.col(_named(n, "n")) > 1, F.sqrt(F.col(_named(n, "m2")) / (F.col(_named(n, "n")) - 1)))


def rolling_columns(ns: Sequence[int] = vocab.ROLLING) -> dict[str, Column]:
    """Statistics of the ``n`` rows before the current one, from the columns of ``frame_stages``."""
    return {f"price_rolling_{fn}_{n}d": c for n in ns for fn, c in (
        ("mean", _frame_mean(n)), ("std", _frame_std(n)), ("min", F.col(_named(n, "lo"))), ("max", F.col(_named(n, "hi"))))}


def momentum_columns(w: Window, col: str, ns: Sequence[int] = vocab.MOMENTUM) -> dict[str, Column]:
    return {f"price_momentum_{n}d": F.lag(col, 1).over(w) - F.lag(col, n).over(w) for n in ns}


def volatility_columns(ns: Sequence[int] = vocab.VOLATILITY) -> dict[str, Column]:
    return {f"price_volatility_{n}d": F.try_divide(_frame_std(n), _frame_mean(n)) for n in ns}


def change_columns(w: Window, col: str, ns: Sequence[int] = vocab.CHANGES) -> dict[str, Column]:
    def change(n: int) -> Column:
        before = F.lag(col, n).over(w)
        return F.try_divide(F.col(col) - before, before)
    return {f"price_pct_change_{n}d": change(n) for n in ns}


def rolling_stages(w: Window, col: str, ns: Sequence[int] = vocab.ROLLING) -> list[dict[str, Column]]:
    return [*frame_stages(w, col, ns), rolling_columns(ns)]


def price_feature_stages(w: Window, col: str) -> list[dict[str, Column]]:
    """All features; each stage may use the columns of those before."""
    return [{**lag_columns(w, col), **momentum_columns(w, col), **change_columns(w, col)},
            *frame_stages(w, col, [*vocab.ROLLING, *vocab.VOLATILITY]), {**rolling_columns(), **volatility_columns()}]


def price_features(df: DataFrame, order: Sequence[Column | str], by: Sequence[str] = SERIES, day: str = "arrival_date",
                   col: str = "modal_price", block_rows: int = BLOCK_ROWS) -> DataFrame:
    """All lag, rolling, momentum, volatility and change features from one shuffle and one sort."""
    return over_rows(df, by, day, order, lambda w: price_feature_stages(w, col), back=max(vocab.LAGS),
                     block_rows=block_rows)


def targets(df: DataFrame, order: Sequence[Column | str], by: Sequence[str] = SERIES, day: str = "arrival_date",
            col: str = "modal_price", horizons: Sequence[int] = vocab.HORIZONS,
            block_rows: int = BLOCK_ROWS) -> DataFrame:
    """The price ``h`` rows later, for every horizon."""
    return over_rows(df, by, day, order, lambda w: {f"target_{h}d": F.lead(col, h).over(w) for h in horizons},
                     back=0, ahead=max(horizons), block_rows=block_rows)


def features_and_targets(df: DataFrame, order: Sequence[Column | str], by: Sequence[str] = SERIES,
                         day: str = "arrival_date", col: str = "modal_price",
                         horizons: Sequence[int] = vocab.HORIZONS, block_rows: int = BLOCK_ROWS) -> DataFrame:
    def build(w: Window) -> list[dict[str, Column]]:
        ahead = {f"target_{h}d": F.lead(col, h).over(w) for h in horizons}
        first, *rest = price_feature_stages(w, col)
        return [{**first, **ahead}, *rest]
    return over_rows(df, by, day, order, build, back=max(vocab.LAGS), ahead=max(horizons), block_rows=block_rows)


def rolling_min_count(col: Column, w: Window, n: int, min_periods: int, fn: str) -> Column:
    """Statistic of the last ``n`` rows, present only when enough of them have a value."""
    frame = w.rowsBetween(-(n - 1), 0)
    return F.when(F.count(col).over(frame) >= min_periods, _stat(fn, col, frame))


def rolling_days(col: Column, test: Column, w: Window, n: int, min_periods: int) -> Column:
    """How many of the last ``n`` rows pass a test."""
    frame = w.rowsBetween(-(n - 1), 0)
    return F.when(F.count(col).over(frame) >= min_periods, F.sum(F.when(test, 1).otherwise(0)).over(frame))


def weather_features(df: DataFrame, key: str = "district", day: str = "date",
                     humidity_default: float = 65.0) -> DataFrame:
    """Trailing rain, heat, humidity, growing-degree and drought features per district.

    The input has one row per district and day, so a window holds at most the days of one district.
    """
    mean_t = M.mean_of_extremes(F.col("t2m_mean"), F.col("t2m_max"), F.col("t2m_min"))
    typical = medians(df, ["rh2m"], humidity_default)["rh2m"] if "rh2m" in df.columns else humidity_default
    humidity = F.coalesce(F.col("rh2m"), F.lit(typical)) if "rh2m" in df.columns else F.lit(humidity_default)
    base = df.withColumns({"t2m_mean": mean_t, "humidity": humidity})
    base = base.withColumns({
        "gdd_daily": M.growing_degree_days(F.col("t2m_max"), F.col("t2m_min")),
        "vpd": M.vapour_pressure_deficit(F.col("t2m_mean"), F.col("humidity")),
    })
    w = Window.partitionBy(key).orderBy(day)
    rain, hi, lo, mean = (F.col(c) for c in ("precipitation", "t2m_max", "t2m_min", "t2m_mean"))
    week = lambda c, fn: rolling_min_count(c, w, 7, 3, fn)
    out = base.withColumns({
        "rainfall_3d": rolling_min_count(rain, w, 3, 2, "sum"),
        "rainfall_7d": week(rain, "sum"),
        "rainfall_14d": rolling_min_count(rain, w, 14, 5, "sum"),
        "rainfall_max_day_7d": week(rain, "max"),
        "rainfall_days_7d": rolling_days(rain, rain > 1, w, 7, 3),
        "wet_days_7d": rolling_days(rain, rain > 10, w, 7, 3),
        "temp_max_7d": week(hi, "max"),
        "temp_min_7d": week(lo, "min"),
        "temp_mean_7d": week(mean, "mean"),
        "temp_std_7d": week(mean, "std"),
        "hot_days_7d": rolling_days(hi, hi > 35, w, 7, 3),
        "cold_days_7d": rolling_days(lo, lo < 15, w, 7, 3),
        "humidity_7d": week(F.col("humidity"), "mean"),
        "humidity_max_7d": week(F.col("humidity"), "max"),
        "gdd_7d": week(F.col("gdd_daily"), "sum"),
        "gdd_14d": rolling_min_count(F.col("gdd_daily"), w, 14, 5, "sum"),
        "vpd_7d": week(F.col("vpd"), "mean"),
    }).withColumns({
        "temp_range_7d": F.col("temp_max_7d") - F.col("temp_min_7d"),
        "drought_stress_7d": M.drought_index(F.col("vpd_7d"), F.col("rainfall_7d")),
    })
    return out.dropna(how="any", subset=["rainfall_7d", "temp_mean_7d"])


def calendar_features(df: DataFrame, day: str = "arrival_date") -> DataFrame:
    d = F.col(day)
    cal = D.calendar(d)
    return df.withColumns({**cal, **D.cyclic(F.month(d), 12, "month"), **D.cyclic(D.day_of_week(d), 7, "dow"),
                           **D.flags(d), "day_of_year": F.dayofyear(d), "agri_season": D.season_code(d),
                           "season": D.season(d)})


def spread_features(df: DataFrame, lo: str = "min_price", hi: str = "max_price", modal: str = "modal_price") -> DataFrame:
    width = M.spread(F.col(hi), F.col(lo))
    pct = M.spread_pct(F.col(hi), F.col(lo), F.col(modal))
    return df.withColumns({"price_spread": width, "price_spread_pct": pct, "price_range": width,
                           "price_volatility": pct})


def latest_features(df: DataFrame, order: Sequence[Column | str], by: Sequence[str] = SERIES, day: str = "arrival_date",
                    col: str = "modal_price", min_rows: int = vocab.MIN_SERIES_ROWS) -> DataFrame:
    """Features of the newest row of every series with at least ``min_rows`` rows.

    Only the newest rows that a frame can reach are shuffled, so no series is ever held whole.
    """
    descending = [F.col(day).desc_nulls_last(), *[(F.col(c) if isinstance(c, str) else c).desc_nulls_last()
                                                  for c in order]]
    series = ["_s", *by]
    recent = Window.partitionBy(*series).orderBy(*descending)
    tail = df.withColumn("_s", series_hash(by)).withColumn("_age", F.row_number().over(recent)).filter(F.col("_age") <= max(min_rows, max(vocab.LAGS) + 1))
    w = Window.partitionBy(*series).orderBy(F.col("_age").desc())
    sized = Window.partitionBy(*series)
    long = tail.withColumn("_rows", F.count(F.lit(1)).over(sized)).filter(F.col("_rows") >= min_rows)  # short series get no features
    kept = with_stages(long, price_feature_stages(w, col)).filter(F.col("_age") == 1).drop("_age", "_rows", "_s")
    zeros = [f"price_{kind}_{n}d" for kind, ns in (("rolling_std", vocab.ROLLING), ("volatility", vocab.VOLATILITY),
                                                   ("pct_change", vocab.CHANGES)) for n in ns]
    return calendar_features(kept.fillna(0.0, zeros), day)


def forecast_stats(df: DataFrame, key: str = "district", day: str = "date", days: int = 15, start: str | None = None) -> DataFrame:
    """Weather statistics of the first days of a forecast per district, from ``start`` on; a measure is found under any of
    its usual names, and constants stand where a column is absent."""
    df = df.withColumnsRenamed({next(n for n in names if n in df.columns): c for c, names in vocab.FORECAST_NAMES.items()
                                if c not in df.columns and any(n in df.columns for n in names)})
    if start is not None:
        df = df.filter(F.col(day) >= F.lit(start).cast("date"))
    # A district has one row per forecast day; several runs leave duplicates, of which the fullest counts.
    first = keep_first(df, [key, day], [M.completeness(*[F.col(c) for c in df.columns])])
    w = Window.partitionBy(key).orderBy(day)
    ranked = first.withColumn("_d", F.row_number().over(w)).filter(F.col("_d") <= days)
    has = set(df.columns)
    within = lambda n, c: F.when(F.col("_d") <= n, c)
    defaults = {k: F.lit(v) for k, v in vocab.STAT_DEFAULTS.items()}
    out: dict[str, Column] = dict(defaults)
    zero = lambda c: F.coalesce(c, F.lit(0.0))
    if "precipitation" in has:
        rain = F.col("precipitation")
        out |= {f"rainfall_{n}d": zero(F.sum(within(n, rain))) for n in (3, 7, 14)}
        out |= {"rainfall_max_day": F.max(within(7, rain)),
                "rainfall_days_7d": F.count_if((F.col("_d") <= 7) & (rain > 1)).cast("double"),
                "wet_days_7d": F.count_if((F.col("_d") <= 7) & (rain > 10)).cast("double")}
    if {"t2m_max", "t2m_min"} <= has:
        hi, lo = F.col("t2m_max"), F.col("t2m_min")
        gdd = M.growing_degree_days(hi, lo)
        out |= {"temp_max": F.max(within(7, hi)), "temp_min": F.min(within(7, lo)),
                "temp_range": F.max(within(7, hi)) - F.min(within(7, lo)),
                "hot_days_7d": F.count_if((F.col("_d") <= 7) & (hi > 35)).cast("double"),
                "cold_days_7d": F.count_if((F.col("_d") <= 7) & (lo < 15)).cast("double"),
                "gdd_7d": zero(F.sum(within(7, gdd))), "gdd_14d": zero(F.sum(within(14, gdd)))}
    if "t2m_mean" in has:
        out |= {"temp_mean": F.avg(within(7, F.col("t2m_mean"))), "temp_std": F.stddev_samp(within(7, F.col("t2m_mean")))}
    if "rh2m" in has:
        out |= {"humidity": F.avg(within(7, F.col("rh2m"))), "humidity_max": F.max(within(7, F.col("rh2m")))}
    if {"t2m_mean", "rh2m"} <= has:
        out["vpd_7d"] = F.avg(within(7, M.vapour_pressure_deficit(F.col("t2m_mean"), F.col("rh2m"))))
    stats = ranked.groupBy(key).agg(F.count(F.lit(1)).alias("forecast_days"), *[c.alias(n) for n, c in out.items()])
    return stats.withColumn("drought_stress_7d", M.drought_index(F.col("vpd_7d"), F.col("rainfall_7d")))
