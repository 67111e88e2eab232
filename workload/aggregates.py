"""Profiles, counts, coverage and report aggregations."""

from pyspark.sql import functions as F

from harvestline.operators import impute as I, joins as J, profile as P
from workload.base import (JOINED_SQL, ORDER, PRICES_SQL, RAW_DISTRICT_SQL, WEATHER_SQL, nation_aliases, prices, query, r,
                           raw_names, rounded, stored, table, weather)


@query("a02_distinct_counts", "WITH " + PRICES_SQL + """
SELECT count(DISTINCT district) AS unique_district, count(DISTINCT market) AS unique_market,
       count(DISTINCT commodity) AS unique_commodity, count(DISTINCT arrival_date) AS unique_arrival_date FROM prices""")
def _(spark, sf):
    return P.distinct_counts(prices(spark, sf), ["district", "market", "commodity", "arrival_date"])


@query("a03_date_range", "WITH " + PRICES_SQL + """
SELECT district, CAST(min(arrival_date) AS VARCHAR) AS date_min, CAST(max(arrival_date) AS VARCHAR) AS date_max,
       count(DISTINCT arrival_date) AS days FROM prices GROUP BY 1""")
def _(spark, sf):
    return rounded(P.date_range(prices(spark, sf), "arrival_date", ["district"]))


@query("a04_value_counts", "WITH " + PRICES_SQL + """
SELECT variety, count(*) AS rows FROM prices GROUP BY 1 ORDER BY rows DESC, variety LIMIT 12""")
def _(spark, sf):
    return P.value_counts(prices(spark, sf), "variety", 12)


@query("a05_measure_profile", """
WITH l AS (SELECT nullif(l_discount, 0) AS l_discount, l_extendedprice, l_quantity FROM lineitem),
u AS (SELECT 'l_discount' AS "column", l_discount AS v FROM l UNION ALL SELECT 'l_extendedprice', l_extendedprice FROM l
      UNION ALL SELECT 'l_quantity', l_quantity FROM l)
SELECT "column", round(avg(v), 5) AS mean, min(v) AS min, max(v) AS max, round(100e0 * (count(*) - count(v)) / count(*), 5) AS null_pct,
       round(quantile_cont(v, 0.5), 5) AS median FROM u GROUP BY 1""")
def _(spark, sf):
    li = table(spark, sf, "lineitem").select(F.nullif("l_discount", F.lit(0.0)).alias("l_discount"), "l_extendedprice", "l_quantity")
    return rounded(P.measure_profile(li, ["l_discount", "l_extendedprice", "l_quantity"]), 5)


@query("a06_weather_profile", "WITH " + WEATHER_SQL + """,
u AS (SELECT 't2m_max' AS "column", t2m_max AS v FROM weather UNION ALL SELECT 't2m_mean', t2m_mean FROM weather
      UNION ALL SELECT 'rh2m', rh2m FROM weather UNION ALL SELECT 'ws2m', ws2m FROM weather UNION ALL SELECT 'precipitation', precipitation FROM weather)
SELECT "column", round(avg(v), 4) AS mean, round(min(v), 4) AS min, round(max(v), 4) AS max,
       round(100e0 * (count(*) - count(v)) / count(*), 4) AS null_pct FROM u GROUP BY 1""")
def _(spark, sf):
    cols = ["t2m_max", "t2m_mean", "rh2m", "ws2m", "precipitation"]
    return rounded(P.measure_profile(weather(spark, sf), cols, median=False))


@query("a08_group_stats", "WITH " + PRICES_SQL + """
SELECT district, count(*) AS rows, count(DISTINCT market) AS unique_market, count(DISTINCT commodity) AS unique_commodity,
       CAST(min(arrival_date) AS VARCHAR) AS date_min, CAST(max(arrival_date) AS VARCHAR) AS date_max FROM prices GROUP BY 1""")
def _(spark, sf):
    return rounded(P.group_stats(prices(spark, sf), ["district"], "arrival_date", ["market", "commodity"]))


@query("a09_price_trend", "WITH " + PRICES_SQL + """
SELECT CAST(arrival_date AS VARCHAR) AS date, round(avg(modal_price), 0) AS price FROM prices
WHERE commodity = 'PROMO' AND arrival_date >= (SELECT max(arrival_date) FROM prices) - 120 GROUP BY 1""")
def _(spark, sf):
    return rounded(P.price_trend(prices(spark, sf), "PROMO", 120), 0)


@query("a10_top_commodities", "WITH " + PRICES_SQL + """
SELECT commodity, count(*) AS rows FROM prices GROUP BY 1 ORDER BY rows DESC, commodity LIMIT 30""")
def _(spark, sf):
    return P.top_groups(prices(spark, sf), "commodity", 30)


@query("a10_top_markets_of_commodity", "WITH " + PRICES_SQL + """
SELECT market, count(*) AS rows FROM prices WHERE commodity = 'SMALL' GROUP BY 1 ORDER BY rows DESC, market LIMIT 50""")
def _(spark, sf):
    return P.top_groups(prices(spark, sf), "market", 50, commodity="SMALL")


@query("a11_monthly_stats", "WITH " + PRICES_SQL + """
SELECT district, extract(year FROM arrival_date) AS year, extract(month FROM arrival_date) AS month,
       round(avg(modal_price) + 3e-7, 3) AS mean, round(stddev_samp(modal_price) + 3e-7, 3) AS std, count(modal_price) AS count
FROM prices GROUP BY 1, 2, 3""")
def _(spark, sf):
    return rounded(P.monthly_stats(prices(spark, sf)), 3, 3e-7)


@query("a12_medians", "WITH " + WEATHER_SQL + """
SELECT round(quantile_cont(t2m_max, 0.5), 4) AS t2m_max, round(quantile_cont(rh2m, 0.5), 4) AS rh2m, 25e0 AS ws2m,
       (SELECT count(*) FROM weather) AS rows FROM weather""")
def _(spark, sf):
    from harvestline.operators.quantiles import medians
    w = weather(spark, sf)
    m = medians(w, ["t2m_max", "rh2m", "ws2m"], 25.0)
    return w.agg(F.count("*").alias("rows")).withColumns({c: r(F.lit(float(v))) for c, v in m.items()})


@query("a16_discover", """
SELECT 'c_mktsegment' AS "column", c_mktsegment AS value, count(*) AS rows FROM customer GROUP BY 2
UNION ALL SELECT 'c_nationkey', CAST(c_nationkey AS VARCHAR), count(*) FROM customer GROUP BY 2""")
def _(spark, sf):
    return P.discover(table(spark, sf, "customer"), ["c_mktsegment", "c_nationkey"])


@query("a17_mapping_report", "WITH " + RAW_DISTRICT_SQL + """
SELECT raw, canonical AS mapped, count(*) AS rows FROM mapped GROUP BY 1, 2""")
def _(spark, sf):
    named = J.normalize_key(raw_names(spark, sf), "raw", nation_aliases(spark, sf), out="canonical")
    return P.mapping_report(named, "raw", "canonical")


@query("a18_null_profile", "WITH " + JOINED_SQL + """,
n AS (SELECT count(*) AS n, count(*) - count(t2m_max) AS a, count(*) - count(t2m_mean) AS b, count(*) - count(humidity) AS c, 0 AS d FROM joined)
SELECT 't2m_max' AS "column", a AS nulls, round(a * 100e0 / n, 4) AS null_pct, CAST(a * 100e0 / n > 10 AS INT) AS warn FROM n
UNION ALL SELECT 't2m_mean', b, round(b * 100e0 / n, 4), 0 FROM n UNION ALL SELECT 'humidity', c, round(c * 100e0 / n, 4), 0 FROM n
UNION ALL SELECT 'market', d, round(d * 100e0 / n, 4), 0 FROM n""")
def _(spark, sf):
    joined = J.join_daily(prices(spark, sf), weather(spark, sf)).select("t2m_max", "t2m_mean", "humidity", "market")
    return rounded(P.null_profile(joined, critical=["t2m_max", "market"]))


@query("a18_scope_share", """
SELECT count(*) AS rows, count(CASE WHEN c_mktsegment = 'BUILDING' THEN 1 END) AS in_scope,
       round(100e0 * count(CASE WHEN c_mktsegment = 'BUILDING' THEN 1 END) / count(*), 4) AS in_scope_pct FROM customer""")
def _(spark, sf):
    return rounded(P.scope_share(table(spark, sf, "customer"), F.col("c_mktsegment") == "BUILDING"))


@query("a20_dashboard", "WITH " + PRICES_SQL + """
SELECT printf('%.1fM+', count(*) / 1e6) AS total_records, count(DISTINCT market) AS total_markets,
       count(DISTINCT commodity) AS total_commodities, count(DISTINCT district) AS total_districts FROM prices""")
def _(spark, sf):
    return P.dashboard(prices(spark, sf))


@query("a21_share", "WITH " + PRICES_SQL + """,
g AS (SELECT variety, count(*) AS rows FROM prices GROUP BY 1)
SELECT variety, rows, round(rows / CAST((SELECT sum(rows) FROM g) AS DOUBLE), 6) AS share,
       rank() OVER (ORDER BY rows DESC) AS rank FROM g""")
def _(spark, sf):
    counts = P.value_counts(prices(spark, sf), "variety").withColumn("_all", F.lit(1))
    return rounded(P.ranked(P.share(counts, "rows"), "rows", ["_all"]).drop("_all"), 6)


@query("a22_snapshot_counts", """
SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS partition_date, count(*) AS rows FROM events GROUP BY 1 ORDER BY 1 DESC LIMIT 10""")
def _(spark, sf):
    e = table(spark, sf, "events").withColumn("partition_date", F.to_date("ts"))
    return rounded(P.snapshot_counts(e))


@query("a23_file_stats", """
SELECT l_returnflag AS file, count(*) AS read, count(CASE WHEN l_linenumber <> 7 AND l_quantity > 10 THEN 1 END) AS kept,
       count(CASE WHEN l_linenumber <> 7 AND l_quantity <= 10 THEN 1 END) AS dropped,
       count(CASE WHEN l_linenumber = 7 THEN 1 END) AS errors FROM lineitem GROUP BY 1""")
def _(spark, sf):
    li = table(spark, sf, "lineitem").withColumn("file", F.col("l_returnflag"))
    return P.file_stats(li, F.col("l_quantity") > 10, F.col("l_linenumber") == 7)


FILL = ["t2m_max", "humidity"]


@query("a24_imputation_stats", "WITH " + JOINED_SQL + """
SELECT count(*) AS total_rows, count(CASE WHEN has_weather = 1 THEN 1 END) AS rows_with_weather_before,
       count(CASE WHEN has_weather = 0 THEN 1 END) AS rows_missing_before, count(*) AS rows_with_weather_after,
       2 * count(*) - count(t2m_max) - count(humidity) AS missing_values_before, CAST(0 AS BIGINT) AS missing_values_after,
       100e0 AS imputation_coverage FROM joined""")
def _(spark, sf):
    joined = J.join_daily(prices(spark, sf), weather(spark, sf))
    rows = stored(joined.select("district", "arrival_date", *ORDER, "has_weather", *FILL), "joined")
    filled = I.impute(rows, FILL, order=ORDER)
    return rounded(I.imputation_stats(filled, FILL))
