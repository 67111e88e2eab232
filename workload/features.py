"""Time-series features, imputation, codes and folds."""

from pyspark.sql import functions as F

from harvestline import vocab
from harvestline.operators import encode as E, impute as I, joins as J, windows as W
from harvestline.operators.ordered import over_rows
from harvestline.plans import datasets as Ds
from workload.base import (JOINED_SQL, ORDER, ORDER_SQL, PRICES_SQL, WEATHER_SQL, nation_aliases, nations, prices, query, r,
                           rounded, stored, weather)

ID = ["commodity", "market", "l_orderkey", "l_linenumber", "modal_price"]
IDS = "commodity, market, l_orderkey, l_linenumber, modal_price"
WIN = f"WINDOW w AS (PARTITION BY commodity, market ORDER BY {ORDER_SQL})"


def _frame(n):
    return f"(PARTITION BY commodity, market ORDER BY {ORDER_SQL} ROWS BETWEEN {n} PRECEDING AND 1 PRECEDING)"


@query("w07_lags", "WITH " + PRICES_SQL + f"""
SELECT {IDS}, {", ".join(f"lag(modal_price, {n}) OVER w AS price_lag_{n}d" for n in vocab.LAGS)} FROM prices {WIN}""")
def _(spark, sf):
    return over_rows(prices(spark, sf), W.SERIES, "arrival_date", ORDER, lambda w: W.lag_columns(w, "modal_price"), back=30
                     ).select(*ID, *[f"price_lag_{n}d" for n in vocab.LAGS])


@query("w08_rolling", "WITH " + PRICES_SQL + f"""
SELECT commodity, market, l_orderkey, l_linenumber, round(modal_price + 3e-7, 3) AS modal_price, {", ".join(f"round({fn}(modal_price) OVER {_frame(n)} + 3e-7, 3) AS price_rolling_{name}_{n}d"
                         for n in vocab.ROLLING for fn, name in (("avg", "mean"), ("stddev_samp", "std"), ("min", "min"), ("max", "max")))}
FROM prices""")
def _(spark, sf):
    out = over_rows(prices(spark, sf), W.SERIES, "arrival_date", ORDER, lambda w: W.rolling_stages(w, "modal_price"), back=30)
    return rounded(out.select(*ID, *[c for c in out.columns if c.startswith("price_rolling")]), 3, 3e-7)


@query("w09_w11_momentum_volatility_change", "WITH " + PRICES_SQL + f"""
SELECT {IDS}, {", ".join(f"round(lag(modal_price, 1) OVER w - lag(modal_price, {n}) OVER w, 4) AS price_momentum_{n}d" for n in vocab.MOMENTUM)},
  {", ".join(f"round(stddev_samp(modal_price) OVER {_frame(n)} / avg(modal_price) OVER {_frame(n)}, 5) AS price_volatility_{n}d" for n in vocab.VOLATILITY)},
  {", ".join(f"round((modal_price - lag(modal_price, {n}) OVER w) / lag(modal_price, {n}) OVER w, 5) AS price_pct_change_{n}d" for n in vocab.CHANGES)}
FROM prices {WIN}""")
def _(spark, sf):
    out = over_rows(prices(spark, sf), W.SERIES, "arrival_date", ORDER, lambda w: [
        {**W.momentum_columns(w, "modal_price"), **W.change_columns(w, "modal_price")}, *W.frame_stages(w, "modal_price", vocab.VOLATILITY),
        W.volatility_columns()], back=30)
    return out.select(*ID, *[r(c, 4 if "momentum" in c else 5).alias(c) for c in out.columns
                             if c.startswith(("price_momentum", "price_volatility", "price_pct"))])


@query("w12_targets", "WITH " + PRICES_SQL + f"""
SELECT {IDS}, {", ".join(f"lead(modal_price, {h}) OVER w AS target_{h}d" for h in vocab.HORIZONS)} FROM prices {WIN}""")
def _(spark, sf):
    return W.targets(prices(spark, sf), ORDER).select(*ID, *[f"target_{h}d" for h in vocab.HORIZONS])


@query("w07_w12_hot_series", "WITH " + PRICES_SQL + f"""
SELECT {IDS}, lag(modal_price, 30) OVER w AS price_lag_30d, max(modal_price) OVER {_frame(14)} AS price_rolling_max_14d,
  lead(modal_price, 15) OVER w AS target_15d FROM prices {WIN}""")
def _(spark, sf):
    """Features and targets of all series at once, from blocks of the registered size."""
    return W.features_and_targets(prices(spark, sf), ORDER).select(*ID, "price_lag_30d", "price_rolling_max_14d", "target_15d")


def _trail(expr, col, n, m):
    w = f"(PARTITION BY district ORDER BY date ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"
    return f"CASE WHEN count({col}) OVER {w} >= {m} THEN {expr} OVER {w} END"


WEATHER_FEATURES_SQL = WEATHER_SQL + """,
med AS (SELECT quantile_cont(rh2m, 0.5) AS m FROM weather),
base AS (SELECT w.* EXCLUDE (t2m_mean), coalesce(t2m_mean, (t2m_max + t2m_min) / 2) AS t2m_mean, coalesce(rh2m, (SELECT m FROM med)) AS humidity
         FROM weather w),
b2 AS (SELECT *, greatest(0, (t2m_max + t2m_min) / 2 - 10) AS gdd_daily,
       0.6108e0 * exp(17.27e0 * t2m_mean / (t2m_mean + 237.3e0)) * (1 - humidity / 100) AS vpd FROM base),
feat AS (SELECT *, """ + ", ".join([
    _trail("sum(precipitation)", "precipitation", 3, 2) + " AS rainfall_3d",
    _trail("sum(precipitation)", "precipitation", 7, 3) + " AS rainfall_7d",
    _trail("sum(precipitation)", "precipitation", 14, 5) + " AS rainfall_14d",
    _trail("max(precipitation)", "precipitation", 7, 3) + " AS rainfall_max_day_7d",
    _trail("sum(CASE WHEN precipitation > 1 THEN 1 ELSE 0 END)", "precipitation", 7, 3) + " AS rainfall_days_7d",
    _trail("sum(CASE WHEN precipitation > 10 THEN 1 ELSE 0 END)", "precipitation", 7, 3) + " AS wet_days_7d",
    _trail("max(t2m_max)", "t2m_max", 7, 3) + " AS temp_max_7d",
    _trail("min(t2m_min)", "t2m_min", 7, 3) + " AS temp_min_7d",
    _trail("avg(t2m_mean)", "t2m_mean", 7, 3) + " AS temp_mean_7d",
    _trail("stddev_samp(t2m_mean)", "t2m_mean", 7, 3) + " AS temp_std_7d",
    _trail("sum(CASE WHEN t2m_max > 35 THEN 1 ELSE 0 END)", "t2m_max", 7, 3) + " AS hot_days_7d",
    _trail("sum(CASE WHEN t2m_min < 15 THEN 1 ELSE 0 END)", "t2m_min", 7, 3) + " AS cold_days_7d",
    _trail("avg(humidity)", "humidity", 7, 3) + " AS humidity_7d",
    _trail("max(humidity)", "humidity", 7, 3) + " AS humidity_max_7d",
    _trail("sum(gdd_daily)", "gdd_daily", 7, 3) + " AS gdd_7d",
    _trail("sum(gdd_daily)", "gdd_daily", 14, 5) + " AS gdd_14d",
    _trail("avg(vpd)", "vpd", 7, 3) + " AS vpd_7d"]) + """ FROM b2)"""
WF = ["rainfall_3d", "rainfall_7d", "rainfall_14d", "rainfall_max_day_7d", "rainfall_days_7d", "wet_days_7d", "temp_max_7d",
      "temp_min_7d", "temp_mean_7d", "temp_std_7d", "hot_days_7d", "cold_days_7d", "humidity_7d", "humidity_max_7d", "gdd_7d",
      "gdd_14d", "vpd_7d"]


@query("w13_w16_weather_features", "WITH " + WEATHER_FEATURES_SQL + f"""
SELECT CAST(date AS VARCHAR) AS date, district, {", ".join(f"round(CAST({c} AS DOUBLE), 4) AS {c}" for c in WF)},
  round(temp_max_7d - temp_min_7d, 4) AS temp_range_7d, round(vpd_7d / (1 + rainfall_7d / 50), 4) AS drought_stress_7d
FROM feat WHERE rainfall_7d IS NOT NULL AND temp_mean_7d IS NOT NULL""")
def _(spark, sf):
    out = W.weather_features(weather(spark, sf))
    return out.select(F.col("date").cast("string").alias("date"), "district",
                      *[r(F.col(c).cast("double")).alias(c) for c in [*WF, "temp_range_7d", "drought_stress_7d"]])


def _fill(c, fallback):
    w = f"(PARTITION BY district ORDER BY {ORDER_SQL}, market"
    return (f"coalesce({c}, last_value({c} IGNORE NULLS) OVER {w} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), "
            f"first_value({c} IGNORE NULLS) OVER {w} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING), {fallback})")


@query("w15_impute", "WITH " + JOINED_SQL + f""",
gaps AS (SELECT *, CASE WHEN district <> 'NATION_4' THEN t2m_max END AS t, CASE WHEN district <> 'NATION_4' THEN humidity END AS h FROM joined),
med AS (SELECT quantile_cont(t, 0.5) AS mt, quantile_cont(h, 0.5) AS mh FROM gaps)
SELECT l_orderkey, l_linenumber, market, modal_price, has_weather AS was, round({_fill("t", "(SELECT mt FROM med)")}, 4) AS t2m_max,
  {_fill("h", "(SELECT mh FROM med)")} AS humidity, CAST(t IS NULL AS INT) AS t2m_max_imputed, CAST(h IS NULL AS INT) AS humidity_imputed,
  1 - has_weather AS weather_imputed, 1 AS has_weather FROM gaps""")
def _(spark, sf):
    joined = J.join_daily(prices(spark, sf), weather(spark, sf))
    hole = F.col("district") != "NATION_4"
    gaps = joined.select("district", "arrival_date", "market", *ORDER, "has_weather", F.col("has_weather").alias("was"),
                         F.when(hole, F.col("t2m_max")).alias("t2m_max"), F.when(hole, F.col("humidity")).alias("humidity"))
    return rounded(I.impute(stored(gaps, "gaps"), ["t2m_max", "humidity"], order=[*ORDER, "market"])
                   .drop("district", "arrival_date", "variety", "grade", "source"))


@query("w18_latest_features", "WITH " + PRICES_SQL + f""",
f AS (SELECT *, {", ".join(f"lag(modal_price, {n}) OVER w AS price_lag_{n}d" for n in vocab.LAGS)},
  avg(modal_price) OVER {_frame(7)} AS price_rolling_mean_7d, stddev_samp(modal_price) OVER {_frame(14)} AS price_rolling_std_14d,
  row_number() OVER (PARTITION BY commodity, market ORDER BY {", ".join(c + " DESC" for c in ORDER_SQL.split(", "))}) AS age,
  count(*) OVER (PARTITION BY commodity, market) AS n FROM prices {WIN})
SELECT commodity, market, CAST(arrival_date AS VARCHAR) AS arrival_date, modal_price, {", ".join(f"price_lag_{n}d" for n in vocab.LAGS)},
  round(price_rolling_mean_7d, 3) AS price_rolling_mean_7d, round(price_rolling_std_14d, 3) AS price_rolling_std_14d,
  round(price_lag_1d - price_lag_30d, 3) AS price_momentum_30d, extract(doy FROM arrival_date) AS day_of_year
FROM f WHERE age = 1 AND n >= 31""")
def _(spark, sf):
    out = W.latest_features(prices(spark, sf), ORDER)
    return rounded(out.select("commodity", "market", "arrival_date", "modal_price", *[f"price_lag_{n}d" for n in vocab.LAGS],
                              "price_rolling_mean_7d", "price_rolling_std_14d", "price_momentum_30d", "day_of_year"), 3)


@query("w19_time_folds", "WITH " + PRICES_SQL + f""",
p AS (SELECT *, row_number() OVER (ORDER BY {ORDER_SQL}, market, commodity) - 1 AS pos, count(*) OVER () AS n FROM prices)
SELECT CASE WHEN pos < n - 5 * (n // 6) THEN 0 ELSE (pos - (n - 5 * (n // 6))) // (n // 6) + 1 END AS fold, count(*) AS rows,
  CAST(min(arrival_date) AS VARCHAR) AS date_min, CAST(max(arrival_date) AS VARCHAR) AS date_max FROM p GROUP BY 1""")
def _(spark, sf):
    return rounded(E.fold_summary(E.time_folds(prices(spark, sf), "arrival_date", [*ORDER, "market", "commodity"], 5), "arrival_date"))


@query("w20_fit_codes", "WITH " + PRICES_SQL + """,
v AS (SELECT DISTINCT 'district' AS "column", district AS value FROM prices UNION ALL SELECT DISTINCT 'market', market FROM prices
      UNION ALL SELECT DISTINCT 'variety', variety FROM prices)
SELECT "column", value, row_number() OVER (PARTITION BY "column" ORDER BY value) - 1 AS code FROM v""")
def _(spark, sf):
    return E.fit_codes(prices(spark, sf), ["district", "market", "variety"])


@query("w21_forecast_stats", "WITH " + WEATHER_SQL + """,
f AS (SELECT *, row_number() OVER (PARTITION BY district ORDER BY date) AS d FROM weather WHERE date >= DATE '2000-03-01'),
v AS (SELECT *, 0.6108e0 * exp(17.27e0 * t2m_mean / (t2m_mean + 237.3e0)) * (1 - rh2m / 100) AS vpd,
      greatest(0, (t2m_max + t2m_min) / 2 - 10) AS gdd FROM f WHERE d <= 15),
s AS (SELECT district, count(*) AS forecast_days, sum(precipitation) FILTER (d <= 3) AS rainfall_3d, sum(precipitation) FILTER (d <= 7) AS rainfall_7d,
  sum(precipitation) FILTER (d <= 14) AS rainfall_14d, max(precipitation) FILTER (d <= 7) AS rainfall_max_day,
  CAST(count(*) FILTER (d <= 7 AND precipitation > 1) AS DOUBLE) AS rainfall_days_7d, CAST(count(*) FILTER (d <= 7 AND precipitation > 10) AS DOUBLE) AS wet_days_7d,
  max(t2m_max) FILTER (d <= 7) AS temp_max, min(t2m_min) FILTER (d <= 7) AS temp_min, avg(t2m_mean) FILTER (d <= 7) AS temp_mean,
  stddev_samp(t2m_mean) FILTER (d <= 7) AS temp_std, avg(rh2m) FILTER (d <= 7) AS humidity, max(rh2m) FILTER (d <= 7) AS humidity_max,
  CAST(count(*) FILTER (d <= 7 AND t2m_max > 35) AS DOUBLE) AS hot_days_7d, CAST(count(*) FILTER (d <= 7 AND t2m_min < 15) AS DOUBLE) AS cold_days_7d,
  sum(gdd) FILTER (d <= 7) AS gdd_7d, sum(gdd) FILTER (d <= 14) AS gdd_14d, avg(vpd) FILTER (d <= 7) AS vpd_7d FROM v GROUP BY 1)
SELECT district, forecast_days, round(rainfall_3d, 4) AS rainfall_3d, round(rainfall_7d, 4) AS rainfall_7d, round(rainfall_14d, 4) AS rainfall_14d,
  rainfall_max_day, rainfall_days_7d, wet_days_7d, round(temp_max, 4) AS temp_max, round(temp_min, 4) AS temp_min, round(temp_mean, 4) AS temp_mean,
  round(temp_std, 4) AS temp_std, round(humidity, 4) AS humidity, humidity_max, hot_days_7d, cold_days_7d, round(gdd_7d, 4) AS gdd_7d,
  round(gdd_14d, 4) AS gdd_14d, round(vpd_7d, 4) AS vpd_7d, round(temp_max - temp_min, 4) AS temp_range,
  round(vpd_7d / (1 + rainfall_7d / 50), 4) AS drought_stress_7d FROM s""")
def _(spark, sf):
    return rounded(W.forecast_stats(weather(spark, sf), start="2000-03-01"))


@query("w22_ranked", "WITH " + PRICES_SQL + """,
g AS (SELECT district, market, count(*) AS rows FROM prices GROUP BY 1, 2)
SELECT *, rank() OVER (PARTITION BY district ORDER BY rows DESC) AS rank FROM g""")
def _(spark, sf):
    from harvestline.operators.profile import ranked
    return ranked(prices(spark, sf).groupBy("district", "market").agg(F.count("*").alias("rows")), "rows", ["district"])


@query("g13_calendar_and_spread", "WITH " + PRICES_SQL + """
SELECT l_orderkey, l_linenumber, market, modal_price, extract(week FROM arrival_date) AS arrival_week_of_year,
  round(sin(2 * pi() * extract(month FROM arrival_date) / 12), 6) AS month_sin, extract(doy FROM arrival_date) AS day_of_year,
  round(max_price - min_price, 3) AS price_spread,
  CASE WHEN extract(isodow FROM arrival_date) >= 6 THEN 1 ELSE 0 END AS is_weekend FROM prices""")
def _(spark, sf):
    out = W.spread_features(W.calendar_features(prices(spark, sf)))
    return out.select("l_orderkey", "l_linenumber", "market", "modal_price", "arrival_week_of_year",
                      (r("month_sin", 6) + F.lit(0.0)).alias("month_sin"), "day_of_year", r("price_spread", 3).alias("price_spread"), "is_weekend")


@query("g14_price_only", "WITH " + PRICES_SQL + """
SELECT district, extract(year FROM arrival_date) AS arrival_year, extract(isodow FROM arrival_date) - 1 AS arrival_day_of_week,
  count(*) AS rows, round(max(max_price - min_price), 3) AS widest FROM prices GROUP BY 1, 2, 3""")
def _(spark, sf):
    out = Ds.price_only(prices(spark, sf))
    return out.groupBy("district", "arrival_year", "arrival_day_of_week").agg(
        F.count("*").alias("rows"), r(F.max("price_spread"), 3).alias("widest"))


@query("g16_joined_model_table", "WITH " + JOINED_SQL + """,
k AS (SELECT *, row_number() OVER (PARTITION BY state, district, market, commodity, variety, grade, arrival_date ORDER BY
      CASE source WHEN 'current' THEN 2 ELSE 1 END DESC, modal_price DESC) AS rn FROM joined WHERE arrival_date >= DATE '1997-01-01')
SELECT district, extract(year FROM arrival_date) AS arrival_year, count(*) AS rows, 1 AS has_weather,
  sum(1 - has_weather) AS imputed, max(modal_price) AS high FROM k WHERE rn = 1 GROUP BY 1, 2""")
def _(spark, sf):
    p = prices(spark, sf).drop("l_orderkey", "l_linenumber")
    canonical = Ds.canonical_prices([p.filter("source = 'history'"), p.filter("source = 'current'")], nation_aliases(spark, sf))
    model = Ds.model_table(stored(Ds.joined(canonical, weather(spark, sf), 1997), "joined"))
    return model.groupBy("district", "arrival_year", "has_weather").agg(
        F.count("*").alias("rows"), F.sum("weather_imputed").alias("imputed"), F.max("modal_price").alias("high"))


BUILD_SQL = "WITH " + JOINED_SQL + """,
k AS (SELECT *, row_number() OVER (PARTITION BY state, district, market, commodity, variety, grade, arrival_date ORDER BY
      CASE source WHEN 'current' THEN 2 ELSE 1 END DESC, modal_price DESC) AS rn FROM joined),
canon AS MATERIALIZED (SELECT * FROM k WHERE rn = 1),
late AS MATERIALIZED (SELECT * FROM canon WHERE arrival_date >= DATE '1997-01-01'),
bounds AS (SELECT quantile_cont(modal_price, 0.005) AS lo, quantile_cont(modal_price, 0.995) AS hi FROM late),
placed AS (SELECT district, row_number() OVER (PARTITION BY commodity, market ORDER BY arrival_date) - 1 AS behind FROM late, bounds
  WHERE modal_price BETWEEN lo AND hi),
trained AS (SELECT district FROM placed WHERE (""" + " + ".join(f"CASE WHEN behind < {n} THEN 1 ELSE 0 END" for n in vocab.LAGS) + f""") <= 0.3 * {len(vocab.LAGS)})
SELECT 'prices' AS step, district, count(*) AS rows, CAST(round(sum(modal_price) * 100) AS BIGINT) AS total FROM canon GROUP BY 2
UNION ALL SELECT 'weather', district, count(*), CAST(sum(precipitation) AS BIGINT) FROM weather GROUP BY 2
UNION ALL SELECT 'joined', district, count(*), CAST(sum(has_weather) AS BIGINT) FROM late GROUP BY 2
UNION ALL SELECT 'model', district, count(*), CAST(sum(1 - has_weather) AS BIGINT) FROM late GROUP BY 2
UNION ALL SELECT 'training', district, count(*), 0 FROM trained GROUP BY 2"""


@query("g16_build", BUILD_SQL)
def _(spark, sf):
    """From raw text tables to the training table: standardised, mapped, deduplicated, gated, joined, filled, featured."""
    p = prices(spark, sf)
    raw = p.select("source", F.col("state").alias("State"), F.concat(F.lower("district"), F.lit(" ")).alias("District"), F.col("market").alias("Market"),
                   F.col("commodity").alias("Commodity"), F.col("variety").alias("Variety"), F.col("grade").alias("Grade"),
                   F.date_format("arrival_date", "dd/MM/yyyy").alias("Arrival_Date"), *[F.col(c).cast("string").alias(c) for c in vocab.PRICE_MEASURES],
                   F.col("commodity_code").cast("string").alias("Commodity_Code"))
    away = raw.limit(1).withColumn("State", F.lit("Away"))
    w = weather(spark, sf).select(F.col("district").alias("District"), F.date_format("date", "yyyyMMdd").alias("Date"), *[
        F.coalesce(F.col(c), F.lit(-999.0)).alias(n) for c, n in (("t2m_max", "T2M_MAX"), ("t2m_min", "T2M_MIN"), ("t2m_mean", "T2M"), ("rh2m", "RH2M"),
                                                                   ("precipitation", "PRECTOTCORR"))])
    inputs = {s: raw.filter(F.col("source") == s).drop("source") for s in ("history", "current")}
    inputs["history"] = inputs["history"].unionByName(away.drop("source"))
    steps = Ds.build({**inputs, "weather": w}, nation_aliases(spark, sf), nations(spark, sf), "Home", "2026-01-01 00:00:00",
                     write=lambda name, df: stored(df, name), first_year=1997)
    lags = [f"price_lag_{n}d" for n in vocab.LAGS]
    training, _ = Ds.training_table(steps["model"], ["variety", "grade", "modal_price"], lags)
    of = lambda step, df, total: df.groupBy(F.lit(step).alias("step"), "district").agg(F.count("*").alias("rows"), total.cast("long").alias("total"))
    return (of("prices", steps["prices"], F.round(F.sum("modal_price") * 100)).unionByName(of("weather", steps["weather"], F.sum("precipitation")))
            .unionByName(of("joined", steps["joined"], F.sum("has_weather"))).unionByName(of("model", steps["model"], F.sum("weather_imputed")))
            .unionByName(of("training", training, F.max(F.lit(0)))))
