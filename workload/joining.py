"""Join operators."""

from pyspark.sql import functions as F

from harvestline.operators import encode as E, joins as J, profile as P
from harvestline.plans import datasets as Ds
from harvestline.session import work_dir
from workload.base import (JOINED_SQL, PRICES_SQL, RAW_DISTRICT_SQL, WEATHER_SQL, nation_aliases, nations, prices, query, r,
                           raw_names, rounded, table, weather)


@query("j01_join_daily", "WITH " + JOINED_SQL + """
SELECT district, has_weather, count(*) AS rows, round(max(t2m_max), 4) AS t2m_max, round(min(t2m_min), 4) AS t2m_min,
       sum(precipitation) AS rain, max(humidity) AS humidity FROM joined GROUP BY 1, 2""")
def _(spark, sf):
    joined = J.join_daily(prices(spark, sf), weather(spark, sf))
    return rounded(joined.groupBy("district", "has_weather").agg(
        F.count("*").alias("rows"), F.max("t2m_max").alias("t2m_max"), F.min("t2m_min").alias("t2m_min"),
        F.sum("precipitation").alias("rain"), F.max("humidity").alias("humidity")))


@query("j01_colocated_join", "WITH " + JOINED_SQL + """
SELECT l_orderkey, l_linenumber, market, modal_price, round(t2m_mean, 4) AS t2m_mean, humidity, precipitation, has_weather FROM joined""")
def _(spark, sf):
    """The same join from tables bucketed by district and day."""
    joined = Ds.colocated(prices(spark, sf), weather(spark, sf), work_dir(spark, "price-buckets"), work_dir(spark, "weather-buckets"), 16)
    return joined.select("l_orderkey", "l_linenumber", "market", "modal_price", r("t2m_mean").alias("t2m_mean"), "humidity",
                         "precipitation", "has_weather")


@query("j01_join_daily_rows", "WITH " + JOINED_SQL + """
SELECT l_orderkey, l_linenumber, market, modal_price, round(t2m_mean, 4) AS t2m_mean, humidity, precipitation, has_weather FROM joined""")
def _(spark, sf):
    joined = J.join_daily(prices(spark, sf), weather(spark, sf))
    return joined.select("l_orderkey", "l_linenumber", "market", "modal_price", r("t2m_mean").alias("t2m_mean"), "humidity",
                         "precipitation", "has_weather")


@query("j02_a01_commodity_dimension", "WITH " + PRICES_SQL + """,
v AS (SELECT commodity, variety, row_number() OVER (PARTITION BY commodity ORDER BY variety) AS rn
      FROM (SELECT DISTINCT commodity, variety FROM prices)),
l AS (SELECT commodity, string_agg(variety, '; ' ORDER BY variety) AS varieties, count(*) AS variety_count FROM v WHERE rn <= 10 GROUP BY 1),
t AS (SELECT commodity, min(commodity_code) AS commodity_code, count(DISTINCT variety) AS distinct_varieties, count(*) AS total_records
      FROM prices GROUP BY 1)
SELECT * FROM t JOIN l USING (commodity)""")
def _(spark, sf):
    return P.commodity_dimension(prices(spark, sf)).withColumn("varieties", F.concat_ws("; ", "varieties"))


@query("j03_normalize_key", "WITH " + RAW_DISTRICT_SQL + """
SELECT l_orderkey, l_linenumber, l_extendedprice, raw, canonical FROM mapped""")
def _(spark, sf):
    return J.normalize_key(raw_names(spark, sf), "raw", nation_aliases(spark, sf), out="canonical").select(
        "l_orderkey", "l_linenumber", "l_extendedprice", "raw", "canonical")


@query("j03_normalize_key_keep", "WITH " + RAW_DISTRICT_SQL + """
SELECT coalesce(canonical, raw) AS name, count(*) AS rows FROM mapped GROUP BY 1""")
def _(spark, sf):
    named = J.normalize_key(raw_names(spark, sf), "raw", nation_aliases(spark, sf), out="name", unmapped="keep")
    return named.groupBy("name").agg(F.count("*").alias("rows"))


@query("j04_lookup_first", "WITH " + JOINED_SQL + """,
raw AS (SELECT date, district, t2m_max, 1 AS run FROM weather UNION ALL SELECT date, district, t2m_max + 1, 2 FROM weather),
f AS (SELECT * FROM raw WHERE run = 1)
SELECT l_orderkey, l_linenumber, market, modal_price, round(f.t2m_max, 4) AS t FROM prices p
JOIN f ON p.arrival_date = f.date AND p.district = f.district""")
def _(spark, sf):
    w = weather(spark, sf).select("date", "district", F.col("t2m_max").alias("t"))
    runs = w.withColumn("run", F.lit(1)).unionByName(w.select("date", "district", (F.col("t") + 1).alias("t"), F.lit(2).alias("run")))
    found = J.lookup_first(prices(spark, sf).withColumnRenamed("arrival_date", "date"), runs, ["date", "district"], ["run"])
    return found.select("l_orderkey", "l_linenumber", "market", "modal_price", r("t").alias("t"))


@query("j07_coverage", "WITH " + PRICES_SQL + "," + WEATHER_SQL + """,
dim AS (SELECT n_name AS district FROM nation UNION ALL SELECT 'Nowhere'),
p AS (SELECT district, count(*) AS price_rows, count(DISTINCT market) AS markets, count(DISTINCT commodity) AS commodities,
      min(arrival_date) AS date_min, max(arrival_date) AS date_max FROM prices GROUP BY 1),
w AS (SELECT DISTINCT district FROM weather)
SELECT d.district, coalesce(price_rows, 0) AS price_rows, coalesce(markets, 0) AS markets, coalesce(commodities, 0) AS commodities,
       CAST(date_min AS VARCHAR) AS date_min, CAST(date_max AS VARCHAR) AS date_max,
       CASE WHEN price_rows > 0 THEN 1 ELSE 0 END AS has_prices, CASE WHEN w.district IS NOT NULL THEN 1 ELSE 0 END AS has_weather,
       CASE WHEN price_rows > 0 AND w.district IS NOT NULL THEN 'full' WHEN w.district IS NOT NULL THEN 'weather_only'
            WHEN price_rows > 0 THEN 'prices_only' ELSE 'none' END AS data_status
FROM dim d LEFT JOIN p ON d.district = p.district LEFT JOIN w ON d.district = w.district""")
def _(spark, sf):
    dim = nations(spark, sf).unionByName(spark.range(1).select(F.lit("Nowhere").alias("district")))
    w = weather(spark, sf).withColumn("district", F.upper("district"))
    return rounded(J.coverage(dim, prices(spark, sf), w))


@query("j07_missing_members", """
WITH dim AS (SELECT CAST(p_partkey AS VARCHAR) || '/' || r_name AS part FROM part, region UNION ALL SELECT 'unknown'),
facts AS (SELECT CAST(l_partkey AS VARCHAR) || '/' || r_name AS part FROM lineitem JOIN supplier ON l_suppkey = s_suppkey
  JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)
SELECT part FROM dim WHERE part NOT IN (SELECT part FROM facts)""")
def _(spark, sf):
    """Parts that no line brings from a region, and a part that no line has."""
    regions = [r[0] for r in table(spark, sf, "region").select("r_name").collect()]
    named = lambda key: F.concat(F.col(key).cast("string"), F.lit("/"), "r_name").alias("part")
    dim = table(spark, sf, "part").withColumn("r_name", F.explode(F.array(*map(F.lit, regions)))).select(named("p_partkey"))
    dim = dim.unionByName(spark.range(1).select(F.lit("unknown").alias("part")))
    li, su, na, re = (table(spark, sf, t) for t in ("lineitem", "supplier", "nation", "region"))
    facts = (li.join(su, F.col("l_suppkey") == F.col("s_suppkey")).join(na, F.col("s_nationkey") == F.col("n_nationkey"))
             .join(re, F.col("n_regionkey") == F.col("r_regionkey")).select(named("l_partkey")))
    return J.missing_members(dim, facts, "part")


@query("j08_current_value", "WITH " + PRICES_SQL + """,
all_prices AS (SELECT commodity, market, arrival_date, modal_price, source FROM prices
  UNION ALL SELECT commodity, 'closed ' || market, arrival_date, modal_price, source FROM prices WHERE source = 'history'),
l AS (SELECT commodity, market, arg_max(struct_pack(d := arrival_date, p := modal_price), struct_pack(d := arrival_date, p := modal_price)) AS v
      FROM all_prices WHERE source = 'current' GROUP BY 1, 2),
h AS (SELECT commodity, market, arg_max(struct_pack(d := arrival_date, p := modal_price), struct_pack(d := arrival_date, p := modal_price)) AS v
      FROM all_prices WHERE source = 'history' GROUP BY 1, 2),
k AS (SELECT DISTINCT commodity, market FROM all_prices UNION ALL SELECT DISTINCT commodity, 'new ' || market FROM prices)
SELECT commodity, market, coalesce(l.v.p, h.v.p, 0) AS current_price,
       CAST(CASE WHEN l.v IS NOT NULL THEN l.v.d ELSE h.v.d END AS VARCHAR) AS price_date,
       CASE WHEN l.v IS NOT NULL THEN 'live' WHEN h.v IS NOT NULL THEN 'historical' ELSE 'none' END AS price_source
FROM k LEFT JOIN l USING (commodity, market) LEFT JOIN h USING (commodity, market)""")
def _(spark, sf):
    """All live and historical rows; every market also has a closed twin with history alone and a new one without prices."""
    p = prices(spark, sf).select("commodity", "market", "arrival_date", "modal_price", "source")
    twin = lambda kind: p.withColumn("market", F.concat(F.lit(f"{kind} "), "market"))
    known = p.unionByName(twin("closed").filter("source = 'history'"))
    live, history = (known.filter(F.col("source") == s) for s in ("current", "history"))
    return rounded(J.current_value(known.unionByName(twin("new")), live, history, ["commodity", "market"], "arrival_date", "modal_price"), 2)


@query("j09_compare_markets", "WITH " + PRICES_SQL + """,
m AS (SELECT commodity, market, max(modal_price) AS market_price FROM prices GROUP BY 1, 2),
c AS (SELECT *, avg(CAST(CAST(round(market_price * 100) AS BIGINT) AS DOUBLE)) OVER (PARTITION BY commodity) / 100 AS now FROM m),
d AS (SELECT CAST(s_suppkey AS VARCHAR) AS market, CAST(s_suppkey % 90 AS DOUBLE) AS distance_km FROM supplier WHERE s_suppkey % 5 <> 0),
x AS (SELECT c.*, coalesce(distance_km, 50) AS km FROM c LEFT JOIN d USING (market))
SELECT commodity, market, market_price, km AS distance_km, km * 2 AS transport_cost, round(market_price - km * 2, 2) AS net_price,
       round(market_price - km * 2 - now, 2) AS profit_margin, round((market_price - km * 2 - now) / now * 100, 4) AS profit_pct,
       CASE WHEN market_price - km * 2 - now > 0 THEN 1 ELSE 0 END AS profitable,
       rank() OVER (PARTITION BY commodity ORDER BY market_price - km * 2 - now DESC) AS rank FROM x""")
def _(spark, sf):
    m = prices(spark, sf).groupBy("commodity", "market").agg(F.max("modal_price").alias("market_price"))
    now = m.groupBy("commodity").agg((F.avg(F.round(F.col("market_price") * 100).cast("long").cast("double")) / 100).alias("now"))
    d = table(spark, sf, "supplier").filter("s_suppkey % 5 <> 0").select(
        F.col("s_suppkey").cast("string").alias("market"), (F.col("s_suppkey") % 90).cast("double").alias("distance_km"))
    compared = J.compare_markets(m.join(now, "commodity"), d, F.col("now"))
    out = P.ranked(compared, "profit_margin", ["commodity"]).drop("now")
    return out.select("commodity", "market", "market_price", "distance_km", "transport_cost", r("net_price", 2).alias("net_price"),
                      r("profit_margin", 2).alias("profit_margin"), r("profit_pct").alias("profit_pct"),
                      F.col("profitable").cast("int").alias("profitable"), "rank")


@query("j10_apply_codes", "WITH " + PRICES_SQL + """,
t AS (SELECT DISTINCT variety FROM prices WHERE arrival_date < DATE '1995-02-01'),
codes AS (SELECT variety, row_number() OVER (ORDER BY variety) - 1 AS code FROM t)
SELECT p.variety, coalesce(code, -1) AS variety_encoded, count(*) AS rows FROM prices p LEFT JOIN codes USING (variety) GROUP BY 1, 2""")
def _(spark, sf):
    p = prices(spark, sf)
    codes = E.fit_codes(p.filter(F.col("arrival_date") < "1995-02-01"), ["variety"])
    return J.apply_codes(p, codes, ["variety"]).groupBy("variety", "variety_encoded").agg(F.count("*").alias("rows"))


@query("j12_suggest", "WITH " + RAW_DISTRICT_SQL + """,
s AS (SELECT left(lower(n_name), 3) AS k, min(n_name) AS suggestion FROM nation GROUP BY 1)
SELECT DISTINCT upper(left(raw, 3)) || right(raw, 2) AS raw, suggestion FROM mapped
LEFT JOIN s ON left(lower(raw), 3) = k WHERE canonical IS NULL AND raw IS NOT NULL""")
def _(spark, sf):
    named = J.normalize_key(raw_names(spark, sf), "raw", nation_aliases(spark, sf), out="canonical")
    unmapped = named.filter(F.col("canonical").isNull() & F.col("raw").isNotNull()).select(
        F.concat(F.upper(F.left("raw", F.lit(3))), F.right("raw", F.lit(2))).alias("raw"))
    return J.suggest(unmapped, nations(spark, sf), "raw", "district")


@query("j13_build_dim", """
WITH a AS (SELECT n_name, unnest([lower(n_name), lower(n_name) || ' district', upper(n_name)]) AS alias FROM nation WHERE n_nationkey % 4 <> 0),
c AS (SELECT n_name, n_nationkey * 1.5e0 AS latitude, n_nationkey * 2.5e0 AS longitude FROM nation WHERE n_nationkey % 3 <> 0)
SELECT n.n_name AS canonical_district, coalesce(al, '') AS aliases, coalesce(latitude, 0) AS latitude, coalesce(longitude, 0) AS longitude
FROM nation n LEFT JOIN (SELECT n_name, string_agg(alias, '|' ORDER BY alias) AS al FROM a GROUP BY 1) USING (n_name) LEFT JOIN c USING (n_name)""")
def _(spark, sf):
    n = table(spark, sf, "nation")
    low = F.lower("n_name")
    aliases = n.filter("n_nationkey % 4 <> 0").select(F.col("n_name").alias("canonical"), F.explode(F.array(
        low, F.concat(low, F.lit(" district")), F.upper("n_name"))).alias("alias"))
    coords = n.filter("n_nationkey % 3 <> 0").select(F.col("n_name").alias("canonical_district"),
                                                     (F.col("n_nationkey") * 1.5).alias("latitude"),
                                                     (F.col("n_nationkey") * 2.5).alias("longitude"))
    return J.build_dim(n.select(F.col("n_name").alias("canonical_district")), aliases, coords)


@query("j14_scalars_without_join", """
SELECT l_returnflag, count(*) AS rows FROM lineitem WHERE l_tax > (SELECT avg(CAST(CAST(round(l_tax * 100) AS BIGINT) AS DOUBLE)) FROM lineitem) / 100
GROUP BY 1""")
def _(spark, sf):
    li = table(spark, sf, "lineitem")
    mean = li.agg(F.avg(F.round(F.col("l_tax") * 100).cast("long").cast("double")).alias("m")).scalar()
    return li.filter(F.col("l_tax") > mean / 100).groupBy("l_returnflag").agg(F.count("*").alias("rows"))
