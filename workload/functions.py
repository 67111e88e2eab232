"""Scalar functions over table columns."""

from pyspark.sql import functions as F

from harvestline.functions import dates as D, measures as M, text as T
from workload.base import JOINED_SQL, RAW_DISTRICT_SQL, WEATHER_SQL, query, r, raw_names, rounded, table, weather


@query("f01_same_text", "SELECT c_custkey, CAST(lower(trim(c_mktsegment)) = 'machinery' AS INT) AS same FROM customer")
def _(spark, sf):
    c = table(spark, sf, "customer")
    return c.select("c_custkey", T.same_text(F.concat(F.lit(" "), F.initcap("c_mktsegment")), "machinery").cast("int").alias("same"))


@query("f02_f03_clean_key", "WITH " + RAW_DISTRICT_SQL + """
SELECT raw, key, trim(split_part(key, '(', 1)) AS base, count(*) AS rows FROM cleaned GROUP BY 1, 2, 3""")
def _(spark, sf):
    return (raw_names(spark, sf).select("raw", T.clean_key(F.col("raw")).alias("key"))
            .withColumn("base", T.before_paren(F.col("key"))).groupBy("raw", "key", "base").agg(F.count("*").alias("rows")))


@query("f04_title_words", """
SELECT p_partkey, upper(left(split_part(p_name, ' ', 1), 1)) || lower(substr(split_part(p_name, ' ', 1), 2)) || ' '
       || upper(left(split_part(p_name, ' ', 2), 1)) || lower(substr(split_part(p_name, ' ', 2), 2)) || '-'
       || upper(left(p_type, 1)) || lower(substr(p_type, 2)) AS title FROM part""")
def _(spark, sf):
    joined = F.concat("p_name", F.lit("-"), "p_type")
    return table(spark, sf, "part").select("p_partkey", T.title_words(joined).alias("title"))


@query("f05_snake_case", r"""
SELECT DISTINCT trim(regexp_replace(lower(trim(o_orderpriority)), '[^a-z0-9]+', '_', 'g'), '_') AS name FROM orders""")
def _(spark, sf):
    return table(spark, sf, "orders").select(T.snake_case(F.col("o_orderpriority")).alias("name")).distinct()


@query("f06_market_name", """
SELECT s_suppkey, CASE WHEN s_suppkey % 2 = 0 THEN s_name ELSE s_name || ' (Yard)' END AS market FROM supplier""")
def _(spark, sf):
    even = F.col("s_suppkey") % 2 == 0
    raw = F.when(even, F.concat("s_name", F.lit(" APMC"))).otherwise(F.concat("s_name", F.lit("(Yard) APMC")))
    return table(spark, sf, "supplier").select("s_suppkey", T.market_name(raw).alias("market"))


@query("f07_file_safe", r"""
SELECT page_id, trim(regexp_replace(translate(replace(replace(replace(replace(url, '?', ''), '"', ''), '<', ''), '>', ''),
       '/\:*| ', '______'), '_+', '_', 'g'), '_') AS name FROM pages""")
def _(spark, sf):
    return table(spark, sf, "pages").select("page_id", T.file_safe(F.col("url")).alias("name"))


@query("f08_null_if_blank", """
SELECT o_orderpriority AS p, count(*) AS rows, count(v) AS kept FROM (
  SELECT o_orderpriority, CASE WHEN o_orderpriority IN ('1-URGENT', '5-LOW', '2-HIGH') THEN NULL ELSE o_orderpriority END AS v
  FROM orders) GROUP BY 1""")
def _(spark, sf):
    p = F.col("o_orderpriority")
    blank = F.when(p == "1-URGENT", "NaN").when(p == "5-LOW", "  ").when(p == "2-HIGH", "none").otherwise(p)
    return (table(spark, sf, "orders").select(p.alias("p"), T.null_if_blank(blank).alias("v")).groupBy("p")
            .agg(F.count("*").alias("rows"), F.count("v").alias("kept")))


@query("f09_join_list", "SELECT n_regionkey, string_agg(n_name, '; ' ORDER BY n_name) AS names FROM nation GROUP BY 1")
def _(spark, sf):
    lists = table(spark, sf, "nation").groupBy("n_regionkey").agg(F.array_sort(F.collect_set("n_name")).alias("names"))
    return lists.select("n_regionkey", T.join_list(F.col("names")).alias("names"))


@query("f10_redact_url", r"""
SELECT page_id, split_part(url, '#', 1) || (CASE WHEN url LIKE '%?%' THEN '&' ELSE '?' END) || 'api-key=[REDACTED]' ||
  CASE WHEN url LIKE '%#%' THEN '#' || split_part(url, '#', 2) ELSE '&monkey=' || page_id END AS url FROM pages""")
def _(spark, sf):
    url = F.col("url")
    p = table(spark, sf, "pages")
    # the key is the last parameter before the fragment, or is followed by another parameter
    tail = F.when(url.contains("#"), F.concat(F.lit("#"), F.split_part(url, F.lit("#"), F.lit(2)))).otherwise(F.concat(F.lit("&monkey="), F.col("page_id").cast("string")))
    raw = F.concat(F.split_part(url, F.lit("#"), F.lit(1)), F.when(url.contains("?"), "&").otherwise("?"), F.lit("api-key=s3cret"), tail)
    return p.select("page_id", T.redact_url(raw).alias("url"))


@query("f10_redact_map", """
SELECT c_custkey, '[REDACTED]' AS token, c_name AS name FROM customer""")
def _(spark, sf):
    params = F.create_map(F.lit("Auth"), F.col("c_mktsegment"), F.lit("name"), F.col("c_name"))
    return (table(spark, sf, "customer").select("c_custkey", T.redact_map(params).alias("m"))
            .select("c_custkey", F.col("m")["Auth"].alias("token"), F.col("m")["name"].alias("name")))


@query("d01_parse_date", """
SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 4 THEN NULL ELSE CAST(CAST(o_orderdate AS DATE) AS VARCHAR) END AS day FROM orders""")
def _(spark, sf):
    d, k = F.to_date("o_orderdate"), F.col("o_orderkey") % 5
    raw = (F.when(k == 0, F.date_format(d, "yyyy-MM-dd")).when(k == 1, F.date_format(d, "d/M/yyyy"))
           .when(k == 2, F.date_format(d, "dd-MMM-yyyy")).when(k == 3, F.date_format(d, "dd-MM-yyyy HH:mm:ss"))
           .otherwise("31/31/2024"))
    return table(spark, sf, "orders").select("o_orderkey", D.parse_date(raw).cast("string").alias("day"))


@query("d02_parse_date_by_consensus", """
SELECT o_orderkey, CASE WHEN o_orderkey % 10 < 7 THEN CAST(CAST(o_orderdate AS DATE) AS VARCHAR) END AS day FROM orders""")
def _(spark, sf):
    d = F.to_date("o_orderdate")
    raw = F.when(F.col("o_orderkey") % 10 < 7, F.date_format(d, "dd-MM-yyyy")).otherwise(F.date_format(d, "dd MMM yyyy"))
    o = table(spark, sf, "orders").select("o_orderkey", raw.alias("day"))
    return D.parse_date_by_consensus(o, "day").withColumn("day", F.col("day").cast("string"))


@query("d03_epoch_days", """
SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS day FROM orders""")
def _(spark, sf):
    n = F.datediff("o_orderdate", F.to_date(F.lit("1970-01-01"))).cast("double") + 0.25
    return table(spark, sf, "orders").select("o_orderkey", D.from_epoch_days(n).cast("string").alias("day"))


@query("d04_d08_calendar", """
SELECT o_orderkey, extract(year FROM o_orderdate) AS arrival_year, extract(month FROM o_orderdate) AS arrival_month,
       extract(isodow FROM o_orderdate) - 1 AS arrival_day_of_week, extract(week FROM o_orderdate) AS arrival_week_of_year,
       extract(day FROM o_orderdate) AS arrival_day_of_month, extract(quarter FROM o_orderdate) AS arrival_quarter,
       extract(dow FROM o_orderdate) AS sunday_based, extract(doy FROM o_orderdate) AS day_of_year,
       CASE WHEN extract(day FROM o_orderdate) <= 5 THEN 1 ELSE 0 END AS is_month_start,
       CASE WHEN extract(day FROM o_orderdate) >= 25 THEN 1 ELSE 0 END AS is_month_end,
       CASE WHEN extract(isodow FROM o_orderdate) >= 6 THEN 1 ELSE 0 END AS is_weekend,
       CASE WHEN extract(month FROM o_orderdate) BETWEEN 6 AND 9 THEN 'kharif'
            WHEN extract(month FROM o_orderdate) IN (10, 11, 12, 1, 2) THEN 'rabi' ELSE 'summer' END AS season,
       CASE WHEN extract(month FROM o_orderdate) BETWEEN 6 AND 9 THEN 0
            WHEN extract(month FROM o_orderdate) IN (10, 11, 12, 1, 2) THEN 1 ELSE 2 END AS agri_season
FROM orders""")
def _(spark, sf):
    d = F.to_date("o_orderdate")
    return table(spark, sf, "orders").select(
        "o_orderkey", *[c.alias(n) for n, c in {**D.calendar(d), **D.flags(d)}.items()],
        D.day_of_week(d, "sunday").alias("sunday_based"), F.dayofyear(d).alias("day_of_year"),
        D.season(d).alias("season"), D.season_code(d).alias("agri_season"))


@query("d06_date_arithmetic", """
SELECT l_orderkey, l_linenumber, l_suppkey, l_partkey, CAST(l_shipdate AS DATE) - CAST(o_orderdate AS DATE) AS days,
       CAST(CAST(o_orderdate AS DATE) + l_linenumber AS VARCHAR) AS due
FROM lineitem JOIN orders ON l_orderkey = o_orderkey""")
def _(spark, sf):
    both = table(spark, sf, "lineitem").join(table(spark, sf, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    return both.select("l_orderkey", "l_linenumber", "l_suppkey", "l_partkey",
                       F.datediff("l_shipdate", "o_orderdate").cast("long").alias("days"),
                       F.date_add("o_orderdate", F.col("l_linenumber")).cast("string").alias("due"))


@query("d09_spine_per_key", """
WITH s AS (SELECT l_suppkey AS market, min(CAST(l_shipdate AS DATE)) AS a, max(CAST(l_shipdate AS DATE)) AS b
           FROM lineitem GROUP BY 1),
days AS (SELECT market, unnest(generate_series(a, b, INTERVAL 1 DAY)) AS day FROM s)
SELECT market, extract(year FROM day) AS year, count(*) AS days FROM days GROUP BY 1, 2""")
def _(spark, sf):
    li = table(spark, sf, "lineitem").select(F.col("l_suppkey").alias("market"), F.to_date("l_shipdate").alias("day"))
    return D.spine_per_key(li, ["market"], "day").groupBy("market", F.year("day").alias("year")).agg(
        F.count("*").alias("days"))


@query("m01_spread", """
SELECT l_orderkey, l_linenumber, l_suppkey, l_partkey, round(l_extendedprice * 2 * l_discount, 4) AS spread,
       round(l_discount * 200, 1) AS pct FROM lineitem""")
def _(spark, sf):
    p, d = F.col("l_extendedprice"), F.col("l_discount")
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_suppkey", "l_partkey", r(M.spread(p * (1 + d), p * (1 - d))).alias("spread"),
        r(M.spread_pct(p * (1 + d), p * (1 - d), p), 1).alias("pct"))


@query("m02_cyclic", """
SELECT o_orderkey, round(sin(2 * pi() * extract(month FROM o_orderdate) / 12), 6) AS month_sin,
       round(cos(2 * pi() * extract(month FROM o_orderdate) / 12), 6) AS month_cos,
       round(sin(2 * pi() * (extract(isodow FROM o_orderdate) - 1) / 7), 6) AS dow_sin,
       round(cos(2 * pi() * (extract(isodow FROM o_orderdate) - 1) / 7), 6) AS dow_cos FROM orders""")
def _(spark, sf):
    d = F.to_date("o_orderdate")
    cols = {**D.cyclic(F.month(d), 12, "month"), **D.cyclic(D.day_of_week(d), 7, "dow")}
    return table(spark, sf, "orders").select("o_orderkey", *[(r(c, 6) + F.lit(0.0)).alias(n) for n, c in cols.items()])


@query("m03_m06_agronomy", "WITH " + WEATHER_SQL + """,
f AS (SELECT date, district, t2m_max, t2m_min, coalesce(t2m_mean, (t2m_max + t2m_min) / 2) AS t, rh2m, precipitation FROM weather),
v AS (SELECT *, 0.6108e0 * exp(17.27e0 * t / (t + 237.3e0)) * (1 - rh2m / 100) AS vpd FROM f)
SELECT CAST(date AS VARCHAR) AS date, district, round(t, 4) AS t, round(greatest(0, (t2m_max + t2m_min) / 2 - 10), 4) AS gdd,
       round(vpd, 4) AS vpd, round(vpd / (1 + precipitation / 50), 4) AS drought FROM v""")
def _(spark, sf):
    w = weather(spark, sf).withColumn("t", M.mean_of_extremes(F.col("t2m_mean"), F.col("t2m_max"), F.col("t2m_min")))
    vpd = M.vapour_pressure_deficit(F.col("t"), F.col("rh2m"))
    return rounded(w.select("date", "district", "t", M.growing_degree_days(F.col("t2m_max"), F.col("t2m_min")).alias("gdd"),
                            vpd.alias("vpd"), M.drought_index(vpd, F.col("precipitation")).alias("drought")))


@query("m07_number", """
SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE c_acctbal END AS value FROM customer""")
def _(spark, sf):
    raw = F.when(F.col("c_custkey") % 3 == 0, F.concat(F.col("c_acctbal").cast("string"), F.lit("x"))).otherwise(
        F.concat(F.lit(" "), F.col("c_acctbal").cast("string")))
    return table(spark, sf, "customer").select("c_custkey", M.number(raw).alias("value"))


@query("m08_sentinel", """
SELECT c_nationkey, count(*) AS rows, count(CASE WHEN c_custkey % 4 <> 0 THEN c_acctbal END) AS known FROM customer GROUP BY 1""")
def _(spark, sf):
    raw = F.when(F.col("c_custkey") % 4 == 0, F.lit(-999.0)).otherwise(F.col("c_acctbal"))
    c = table(spark, sf, "customer").withColumn("value", M.without_sentinel(raw))
    return c.groupBy("c_nationkey").agg(F.count("*").alias("rows"), F.count("value").alias("known"))


@query("m09_completeness", "WITH " + JOINED_SQL + """
SELECT (CASE WHEN t2m_max IS NOT NULL THEN 1 ELSE 0 END + CASE WHEN t2m_mean IS NOT NULL THEN 1 ELSE 0 END
      + CASE WHEN humidity IS NOT NULL THEN 1 ELSE 0 END) AS score, count(*) AS rows FROM joined GROUP BY 1""")
def _(spark, sf):
    from harvestline.operators import joins as J
    from workload.base import prices
    joined = J.join_daily(prices(spark, sf), weather(spark, sf))
    return joined.groupBy(M.completeness(F.col("t2m_max"), F.col("t2m_mean"), F.col("humidity")).alias("score")).agg(
        F.count("*").alias("rows"))


@query("m11_clamp", "SELECT p_partkey, greatest(least(p_size, 40), 5) AS size FROM part")
def _(spark, sf):
    return table(spark, sf, "part").select("p_partkey", M.clamp(F.col("p_size"), F.lit(5), F.lit(40)).alias("size"))


@query("c01_case", """
SELECT l_linestatus, l_returnflag, CASE l_linestatus WHEN 'O' THEN 2 WHEN 'F' THEN 1 ELSE 0 END AS rank, count(*) AS rows
FROM lineitem GROUP BY 1, 2, 3""")
def _(spark, sf):
    return (table(spark, sf, "lineitem").groupBy("l_linestatus", "l_returnflag",
                                                 M.source_rank(F.col("l_linestatus"), {"O": 2, "F": 1}).alias("rank"))
            .agg(F.count("*").alias("rows")))


@query("r01_arrays", """
SELECT doc_id, list_aggregate(list_sort(list_distinct(string_split(source || ' ' || lang || ' ' || source, ' ')))[1:2], 'string_agg', '|') AS words,
       CAST(contains(lower(text), 'license') AS INT) AS licensed FROM documents""")
def _(spark, sf):
    words = M.distinct_sorted(F.split(F.concat_ws(" ", "source", "lang", "source"), " "), 2)
    return table(spark, sf, "documents").select(
        "doc_id", T.join_list(words, "|").alias("words"), M.mentions(F.array("text"), "license").cast("int").alias("licensed"))


@query("r02_json_fields", """
SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events""")
def _(spark, sf):
    k = F.from_json("props", "map<string,bigint>")["k"]
    return table(spark, sf, "events").select("event_id", k.alias("k"))
