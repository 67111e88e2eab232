"""Calibration, metrics, curves, advice and outlooks."""

from pyspark.sql import functions as F

from harvestline.operators import decisions as X, profile as P, windows as W
from harvestline.operators.ordered import over_rows
from harvestline.plans import outlook as Ol, reports as R
from workload.base import NAIVE, ORDER, ORDER_SQL, PREDICTIONS_SQL, PRICES_SQL, prices, query, r, rounded, stored, table


def predictions(spark, sf):
    lagged = over_rows(prices(spark, sf), W.SERIES, "arrival_date", ORDER, lambda w: W.lag_columns(w, "modal_price", NAIVE), back=14)
    cells = F.array(*[F.struct(F.lit(h).alias("horizon"), F.col(f"price_lag_{h}d").alias("yhat")) for h in NAIVE])
    return stored(lagged.select(F.col("modal_price").alias("y"), F.explode(cells).alias("c"))
                  .select("c.horizon", "y", "c.yhat").filter(F.col("yhat").isNotNull()), "predictions")


@query("a13_calibrate", "WITH " + PREDICTIONS_SQL + """
SELECT horizon, round(avg(abs(y - yhat)), 3) AS mean_residual, round(stddev_pop(abs(y - yhat)), 3) AS std_residual, count(*) AS rows,
  round(quantile_cont(abs(y - yhat), 0.8), 3) AS q80, round(quantile_cont(abs(y - yhat), 0.9), 3) AS q90,
  round(quantile_cont(abs(y - yhat), 0.95), 3) AS q95 FROM predictions GROUP BY 1""")
def _(spark, sf):
    return rounded(P.calibrate(predictions(spark, sf), "y", "yhat", ["horizon"]), 3)


@query("a13_calibrate_overall", "WITH " + PREDICTIONS_SQL + """
SELECT round(avg(abs(y - yhat)), 3) AS mean_residual, round(stddev_pop(abs(y - yhat)), 3) AS std_residual, count(*) AS rows,
  round(quantile_cont(abs(y - yhat), 0.8), 3) AS q80, round(quantile_cont(abs(y - yhat), 0.9), 3) AS q90,
  round(quantile_cont(abs(y - yhat), 0.95), 3) AS q95 FROM predictions""")
def _(spark, sf):
    return rounded(P.calibrate(predictions(spark, sf), "y", "yhat"), 3)


@query("a14_regression_metrics", "WITH " + PREDICTIONS_SQL + """
SELECT horizon, round(avg(abs(y - yhat)), 3) AS mae, round(sqrt(avg((y - yhat) * (y - yhat))), 3) AS rmse,
  round(1 - sum((y - yhat) * (y - yhat)) / (var_pop(y) * count(*)), 5) AS r2,
  round(avg(abs((y - yhat) / greatest(y, 1))) * 100, 3) AS mape, count(*) AS n FROM predictions GROUP BY 1""")
def _(spark, sf):
    return P.regression_metrics(predictions(spark, sf), "y", "yhat", ["horizon"]).select(
        "horizon", *[r(c, 5 if c == "r2" else 3).alias(c) for c in ("mae", "rmse", "r2", "mape")], "n")


LABELS_SQL = """
labelled AS (SELECT quality + toxic AS y, CASE WHEN n_chars > 6000 THEN 1 WHEN lang = 'en' THEN 2 ELSE 0 END AS yhat
  FROM labels JOIN documents USING (doc_id)),
cells AS (SELECT y, yhat, count(*) AS n FROM labelled GROUP BY 1, 2),
ks AS (SELECT y AS class FROM cells UNION SELECT yhat FROM cells),
rep AS (SELECT class, coalesce((SELECT sum(n) FROM cells WHERE y = class), 0) AS support,
  coalesce((SELECT sum(n) FROM cells WHERE yhat = class), 0) AS predicted,
  coalesce((SELECT sum(n) FROM cells WHERE y = class AND yhat = class), 0) AS hit FROM ks),
rat AS (SELECT *, coalesce(CAST(hit AS DOUBLE) / nullif(predicted, 0), 0) AS precision, coalesce(CAST(hit AS DOUBLE) / nullif(support, 0), 0) AS recall FROM rep),
fin AS (SELECT *, coalesce(2 * precision * recall / nullif(precision + recall, 0), 0) AS f1 FROM rat)"""


def labelled(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "n_chars", "lang")
    yhat = F.when(F.col("n_chars") > 6000, 1).when(F.col("lang") == "en", 2).otherwise(0)
    return table(spark, sf, "labels").join(docs, "doc_id").select((F.col("quality") + F.col("toxic")).alias("y"), yhat.alias("yhat"))


@query("a15_confusion", "WITH " + LABELS_SQL + " SELECT y, yhat, n FROM cells")
def _(spark, sf):
    return P.confusion(labelled(spark, sf), "y", "yhat")


@query("a15_class_report", "WITH " + LABELS_SQL + """
SELECT class, CAST(support AS BIGINT) AS support, CAST(predicted AS BIGINT) AS predicted, CAST(hit AS BIGINT) AS hit,
  round(precision, 5) AS precision, round(recall, 5) AS recall, round(f1, 5) AS f1 FROM fin""")
def _(spark, sf):
    return rounded(P.class_report(labelled(spark, sf), "y", "yhat"), 5)


@query("a15_classification_metrics", "WITH " + LABELS_SQL + """
SELECT round(CAST(sum(hit) AS DOUBLE) / CAST(sum(support) AS DOUBLE), 5) AS accuracy, round(avg(f1), 5) AS f1_macro,
  round(sum(f1 * CAST(support AS DOUBLE)) / CAST(sum(support) AS DOUBLE), 5) AS f1_weighted,
  round(max(CASE WHEN class = 2 THEN recall END), 5) AS recall_focus, CAST(sum(support) AS BIGINT) AS n FROM fin""")
def _(spark, sf):
    return rounded(P.classification_metrics(labelled(spark, sf), "y", "yhat", focus=2), 5)


# Forecasts per series: prices some rows ago stand for the horizons.
FORECAST_SQL = PRICES_SQL + f""",
numbered AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY commodity, market ORDER BY {", ".join(c + " DESC" for c in ORDER_SQL.split(", "))}) AS age,
  count(*) OVER (PARTITION BY commodity, market) AS n FROM prices),
forecasts AS MATERIALIZED (SELECT a.commodity, a.market, h.horizon, a.modal_price AS price, b.modal_price AS current_price FROM numbered a
  JOIN (VALUES (1), (2), (7), (14), (21)) h(horizon) ON a.age = h.horizon + 1
  JOIN numbered b ON a.commodity = b.commodity AND a.market = b.market AND b.age = 1 WHERE a.n >= 31)"""
STEPS = [1, 2, 7, 14, 21]


def forecasts(spark, sf, last=None):
    last = W.latest_features(prices(spark, sf), ORDER) if last is None else last
    cells = F.array(*[F.struct(F.lit(h).alias("horizon"), F.col(f"price_lag_{h}d").alias("price")) for h in STEPS])
    return (last.select("commodity", "market", F.col("modal_price").alias("current_price"), F.explode(cells).alias("c"))
            .select("commodity", "market", "c.horizon", "c.price", "current_price"))


def curve_sql(days, band):
    """One row for each day and series: the points of a series stand side by side, so nothing is joined with itself."""
    return f""",
points AS MATERIALIZED (SELECT commodity, market, list(struct_pack(h := horizon, p := price) ORDER BY horizon) AS pts FROM forecasts GROUP BY 1, 2),
days AS MATERIALIZED (SELECT commodity, market, pts, unnest(generate_series(1, {days})) AS day FROM points),
brk AS (SELECT *, coalesce(list_filter(pts, lambda x: x.h <= day)[-1], pts[1]) AS l, coalesce(list_filter(pts, lambda x: x.h >= day)[1], pts[-1]) AS u FROM days),
pr AS (SELECT commodity, market, day, CASE WHEN l.h = u.h THEN l.p ELSE l.p + (CAST(day - l.h AS DOUBLE) / (u.h - l.h)) * (u.p - l.p) END AS price,
  {band} * least(day / 7, 3) AS band FROM brk),
"""


CURVE_SQL = FORECAST_SQL + curve_sql(25, "900e0") + """
curve AS (SELECT commodity, market, day, round(price + 3e-7, 0) AS predicted_price, round(price - band + 3e-7, 0) AS lower_bound,
  round(price + band + 3e-7, 0) AS upper_bound, round(greatest(70e0, 95e0 - day * 1.2e0), 1) AS confidence FROM pr)"""


@query("g05_m10_daily_curve", "WITH " + CURVE_SQL + " SELECT * FROM curve")
def _(spark, sf):
    f = forecasts(spark, sf).withColumn("price", F.col("price") + 3e-7)
    return X.daily_curve(f, W.SERIES, F.lit(900.0), 25, STEPS)


@query("g06_intervals", "WITH " + FORECAST_SQL + """,
c AS (SELECT quantile_cont(abs(price - current_price), 0.95) AS q95 FROM forecasts)
SELECT commodity, market, horizon, price, current_price, round(price - q95 + 3e-7, 3) AS lower, round(price + q95 + 3e-7, 3) AS upper FROM forecasts, c""")
def _(spark, sf):
    f = forecasts(spark, sf)
    return rounded(X.with_intervals(f, P.calibrate(f, "price", "current_price"), 0.95), 3, 3e-7)


RECOMMEND_SQL = FORECAST_SQL + """,
best AS (SELECT *, row_number() OVER (PARTITION BY commodity, market ORDER BY price DESC, horizon) AS rn FROM forecasts),
adv AS (SELECT commodity, market, current_price, price AS max_forecast_price, horizon AS best_sell_day, price - 900 AS lower,
  (price - current_price) / current_price * 100 AS gain, (price - 900 - current_price) / current_price * 100 AS safe FROM best WHERE rn = 1)"""


@query("g07_recommend", "WITH " + RECOMMEND_SQL + """
SELECT commodity, market, current_price, max_forecast_price, best_sell_day, round(gain, 4) AS expected_gain_pct,
  CASE WHEN gain > 5 THEN 'HOLD' ELSE 'SELL' END AS recommendation,
  CASE WHEN safe > 5 THEN 'high' WHEN gain > 5 THEN 'medium' ELSE 'low' END AS confidence,
  CASE WHEN gain > 5 THEN 'rise' WHEN gain < -5 THEN 'fall' ELSE 'stable' END AS kind FROM adv""")
def _(spark, sf):
    f = forecasts(spark, sf).withColumns({"lower": F.col("price") - 900, "upper": F.col("price") + 900})
    out = X.recommend(f, W.SERIES)
    return rounded(out.select("commodity", "market", "current_price", "max_forecast_price", "best_sell_day", "expected_gain_pct",
                              "recommendation", "confidence", F.regexp_extract("reason", "(rise|fall|stable)", 1).alias("kind")))


@query("g08_trend", "WITH " + CURVE_SQL + """,
e AS (SELECT commodity, market, max(CASE WHEN day = 1 THEN predicted_price END) AS first, max(CASE WHEN day = 25 THEN predicted_price END) AS last FROM curve GROUP BY 1, 2)
SELECT *, CASE WHEN last > first * 1.02e0 THEN 'up' WHEN last < first * 0.98e0 THEN 'down' ELSE 'stable' END AS price_trend FROM e""")
def _(spark, sf):
    f = forecasts(spark, sf).withColumn("price", F.col("price") + 3e-7)
    return X.trend_of(X.daily_curve(f, W.SERIES, F.lit(900.0), 25, STEPS), W.SERIES)


@query("g12_outlook", "WITH " + RECOMMEND_SQL + """,
predictions AS MATERIALIZED (SELECT modal_price AS y, unnest([""" + ", ".join(f"lag(modal_price, {h}) OVER w" for h in NAIVE) + """]) AS yhat
  FROM prices WINDOW w AS (PARTITION BY commodity, market ORDER BY """ + ORDER_SQL + """)),
cal AS MATERIALIZED (SELECT quantile_cont(abs(y - yhat), 0.9) AS q90 FROM predictions)""" + curve_sql(14, "(SELECT q90 FROM cal)") + """
curve AS (SELECT commodity, market, string_agg(CAST(CAST(round(price + 3e-7, 0) AS BIGINT) AS VARCHAR) || '/' || CAST(CAST(round(price - band + 3e-7, 0) AS BIGINT) AS VARCHAR), ' ' ORDER BY day) AS days FROM pr GROUP BY 1, 2),
f AS (SELECT commodity, market, max(CASE WHEN horizon = 7 THEN price END) AS f7, max(CASE WHEN horizon = 14 THEN price END) AS f14 FROM forecasts GROUP BY 1, 2),
live AS (SELECT commodity, market, current_price + CASE WHEN CAST(market AS BIGINT) % 2 = 0 THEN 10 ELSE 0 END AS now, max_forecast_price, best_sell_day FROM adv),
told AS (SELECT *, (max_forecast_price - now) / now * 100 AS gain FROM live)
SELECT commodity, market, round(now + 3e-7, 0) AS current_price, CASE WHEN CAST(market AS BIGINT) % 2 = 0 THEN 'live' ELSE 'historical' END AS price_source,
  CASE WHEN gain > 5 THEN 'HOLD' ELSE 'SELL' END AS recommendation, best_sell_day,
  round(gain, 4) AS expected_gain_pct, round(f7 + 3e-7, 0) AS forecast_7d, round(f14 + 3e-7, 0) AS forecast_14d, days
FROM told JOIN f USING (commodity, market) JOIN curve USING (commodity, market)""")
def _(spark, sf):
    """Every second market has a live price, ten above its last one; the others fall back to history."""
    last = stored(W.latest_features(prices(spark, sf), ORDER), "latest")
    f = forecasts(spark, sf, last).withColumn("price", F.col("price") + 3e-7).drop("current_price")
    newest = last.select("commodity", "market", "arrival_date", (F.col("modal_price") + 3e-7).alias("modal_price"))
    calibration = P.calibrate(predictions(spark, sf), "y", "yhat")
    live = newest.filter(F.col("market").cast("long") % 2 == 0).withColumn("modal_price", F.col("modal_price") + 10)
    out = Ol.outlook(f, newest, live, calibration, 14, STEPS)
    return out.select("commodity", "market", "current_price", "price_source", "recommendation", "best_sell_day", r("expected_gain_pct").alias("expected_gain_pct"),
                      "forecast_7d", "forecast_14d",
                      F.array_join(F.transform("forecasts", lambda d: F.concat_ws("/", d["predicted_price"].cast("long"), d["lower_bound"].cast("long"))), " ").alias("days"))


@query("g15_training_report", "WITH " + PREDICTIONS_SQL + """,
m AS (SELECT horizon, [avg(abs(y - yhat)), sqrt(avg((y - yhat) * (y - yhat))), 1 - avg((y - yhat) * (y - yhat)) / var_pop(y),
  avg(abs((y - yhat) / greatest(y, 1))) * 100, count(*)] AS v FROM predictions GROUP BY 1),
c AS (SELECT [avg(abs(y - yhat)), stddev_pop(abs(y - yhat)), count(*), quantile_cont(abs(y - yhat), 0.8), quantile_cont(abs(y - yhat), 0.9),
  quantile_cont(abs(y - yhat), 0.95)] AS v FROM predictions)
SELECT 'horizon_' || horizon AS section, unnest(['mae', 'rmse', 'r2', 'mape', 'n']) AS metric, round(unnest(v) + 3e-5, 2) AS value FROM m
UNION ALL SELECT 'calibration', unnest(['mean_residual', 'std_residual', 'rows', 'q80', 'q90', 'q95']), round(unnest(v) + 3e-5, 2) FROM c""")
def _(spark, sf):
    p = predictions(spark, sf)
    return rounded(R.training_report(p, P.calibrate(p, "y", "yhat")).withColumn("value", F.col("value").cast("double")), 2, 3e-5)
