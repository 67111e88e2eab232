"""Projection, scope, filter, split and set operators."""

from pyspark.sql import functions as F

from harvestline import vocab
from harvestline.operators import quantiles as Qt, shape as S
from workload.base import (ORDER, ORDER_SQL, PRICES_SQL, RAW_DISTRICT_SQL, prices, query, r, raw_names, rounded, table)
from workload.base import JOINED_SQL, weather
from harvestline.operators import joins as J
from workload.base import nation_aliases


@query("p01_rename_by_alias", """
SELECT l_returnflag AS variety, l_linestatus AS grade, count(*) AS rows, round(sum(l_extendedprice), 2) AS total
FROM lineitem GROUP BY 1, 2""")
def _(spark, sf):
    raw = table(spark, sf, "lineitem").select(
        F.col("l_returnflag").alias("Variety Name"), F.col("l_linestatus").alias("QUALITY"),
        F.when(F.col("l_quantity") > 25, F.col("l_extendedprice")).alias("Modal_Price"),
        F.col("l_extendedprice").alias("modal"))
    named = S.rename_by_alias(raw, vocab.PRICE_ALIASES)
    return named.groupBy("variety", "grade").agg(F.count("*").alias("rows"), r(F.sum("modal_price"), 2).alias("total"))


@query("p02_conform", """
SELECT CAST(s_suppkey AS VARCHAR) AS market, s_name AS commodity, s_acctbal AS modal_price, CAST(NULL AS VARCHAR) AS grade,
       CAST(NULL AS DOUBLE) AS min_price FROM supplier""")
def _(spark, sf):
    raw = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("market"), F.col("s_name").alias("commodity"),
                                              F.col("s_acctbal").cast("string").alias("modal_price"))
    return S.conform(raw, {"market": "string", "commodity": "string", "grade": "string", "min_price": "double",
                           "modal_price": "double"})


@query("p03_keep_scope", """
SELECT 'BUILDING' AS segment, count(*) AS rows, round(sum(c_acctbal), 2) AS total FROM customer
WHERE lower(trim(c_mktsegment)) = 'building'""")
def _(spark, sf):
    c = table(spark, sf, "customer").withColumn("segment", F.concat(F.lit("  "), F.lower("c_mktsegment"), F.lit(" ")))
    return S.keep_scope(c, "segment", "BUILDING").groupBy("segment").agg(
        F.count("*").alias("rows"), r(F.sum("c_acctbal"), 2).alias("total"))


@query("p04_scope_violations", """
SELECT c_mktsegment, count(*) AS rows FROM customer WHERE c_mktsegment <> 'BUILDING' GROUP BY 1
ORDER BY rows DESC, c_mktsegment LIMIT 5""")
def _(spark, sf):
    return S.scope_violations(table(spark, sf, "customer"), "c_mktsegment", "building")


@query("p05_drop_unmapped", "WITH " + RAW_DISTRICT_SQL + """
SELECT canonical AS district, count(*) AS rows FROM mapped WHERE canonical IS NOT NULL GROUP BY 1""")
def _(spark, sf):
    named = J.normalize_key(raw_names(spark, sf), "raw", nation_aliases(spark, sf), out="district")
    return S.drop_unmapped(named, "district").groupBy("district").agg(F.count("*").alias("rows"))


@query("p06_trim_quantiles", """
WITH b AS (SELECT quantile_cont(l_extendedprice, 0.005) AS lo, quantile_cont(l_extendedprice, 0.995) AS hi FROM lineitem)
SELECT l_returnflag, count(*) AS rows, min(l_extendedprice) AS low, max(l_extendedprice) AS high
FROM lineitem, b WHERE l_extendedprice BETWEEN lo AND hi GROUP BY 1""")
def _(spark, sf):
    return (Qt.trim_quantiles(table(spark, sf, "lineitem"), "l_extendedprice").groupBy("l_returnflag")
            .agg(F.count("*").alias("rows"), F.min("l_extendedprice").alias("low"), F.max("l_extendedprice").alias("high")))


@query("p07_max_null_fraction", "WITH " + JOINED_SQL + """
SELECT district, count(*) AS rows FROM joined
WHERE (CASE WHEN t2m_max IS NULL THEN 1 ELSE 0 END + CASE WHEN t2m_mean IS NULL THEN 1 ELSE 0 END
     + CASE WHEN humidity IS NULL THEN 1 ELSE 0 END + CASE WHEN precipitation IS NULL THEN 1 ELSE 0 END) <= 1.2
GROUP BY 1""")
def _(spark, sf):
    joined = J.join_daily(prices(spark, sf), weather(spark, sf))
    return (S.max_null_fraction(joined, ["t2m_max", "t2m_mean", "humidity", "precipitation"], 0.3)
            .groupBy("district").agg(F.count("*").alias("rows")))


@query("p07_drop_incomplete", "WITH " + JOINED_SQL + """
SELECT district, count(*) AS rows FROM joined
WHERE t2m_max IS NOT NULL AND t2m_mean IS NOT NULL AND humidity IS NOT NULL GROUP BY 1""")
def _(spark, sf):
    joined = J.join_daily(prices(spark, sf), weather(spark, sf))
    return (S.drop_incomplete(joined, ["t2m_max", "t2m_mean", "humidity"]).groupBy("district")
            .agg(F.count("*").alias("rows")))


@query("p08_one_series", "WITH " + PRICES_SQL + """
SELECT CAST(arrival_date AS VARCHAR) AS arrival_date, l_orderkey, l_linenumber, modal_price FROM prices
WHERE commodity = 'PROMO' AND market = '7'""")
def _(spark, sf):
    return S.only(prices(spark, sf), commodity="PROMO", market="7").select(
        F.col("arrival_date").cast("string").alias("arrival_date"), "l_orderkey", "l_linenumber", "modal_price")


@query("p09_last_n_days", """
SELECT CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS day, count(*) AS rows FROM lineitem
WHERE CAST(l_shipdate AS DATE) >= (SELECT max(CAST(l_shipdate AS DATE)) FROM lineitem) - 45 GROUP BY 1""")
def _(spark, sf):
    li = table(spark, sf, "lineitem").withColumn("day", F.to_date("l_shipdate"))
    return S.last_n_days(li, "day", 45).groupBy(F.col("day").cast("string").alias("day")).agg(F.count("*").alias("rows"))


@query("p10_from_year", """
SELECT extract(year FROM l_shipdate) AS year, count(*) AS rows, round(sum(l_quantity), 2) AS quantity FROM lineitem
WHERE extract(year FROM l_shipdate) >= 1998 GROUP BY 1""")
def _(spark, sf):
    return (S.from_year(table(spark, sf, "lineitem"), "l_shipdate", 1998).groupBy(F.year("l_shipdate").alias("year"))
            .agg(F.count("*").alias("rows"), r(F.sum("l_quantity"), 2).alias("quantity")))


@query("p11_time_split", "WITH " + PRICES_SQL + """
SELECT CASE WHEN arrival_date < DATE '2000-01-01' THEN 'train' WHEN arrival_date < DATE '2001-01-01' THEN 'validation'
       ELSE 'test' END AS part, count(*) AS rows, CAST(min(arrival_date) AS VARCHAR) AS first,
       CAST(max(arrival_date) AS VARCHAR) AS last FROM prices GROUP BY 1""")
def _(spark, sf):
    return rounded(S.time_split(prices(spark, sf), "arrival_date", "2000-01-01", "2001-01-01").groupBy("part").agg(
        F.count("*").alias("rows"), F.min("arrival_date").alias("first"), F.max("arrival_date").alias("last")))


@query("p11_ordered_split", "WITH " + PRICES_SQL + f""",
placed AS (SELECT *, row_number() OVER (ORDER BY {ORDER_SQL}, market, commodity) AS rn, count(*) OVER () AS n FROM prices)
SELECT CASE WHEN rn <= floor(n * 0.8e0) THEN 'train' ELSE 'test' END AS part, count(*) AS rows,
       CAST(min(arrival_date) AS VARCHAR) AS first, CAST(max(arrival_date) AS VARCHAR) AS last,
       sum(l_orderkey) AS orderkeys FROM placed GROUP BY 1""")
def _(spark, sf):
    return rounded(S.ordered_split(prices(spark, sf), "arrival_date", [*ORDER, "market", "commodity"], 0.8)
                   .groupBy("part").agg(F.count("*").alias("rows"), F.min("arrival_date").alias("first"),
                                        F.max("arrival_date").alias("last"), F.sum("l_orderkey").alias("orderkeys")))


@query("p12_required_columns", "SELECT l_returnflag, count(*) AS rows FROM lineitem GROUP BY 1")
def _(spark, sf):
    li = S.require(table(spark, sf, "lineitem"), ["l_orderkey", "l_returnflag"])
    return li.groupBy("l_returnflag").agg(F.count("*").alias("rows"))


@query("p13_project_and_tag", """
SELECT CAST(o_orderdate AS DATE)::VARCHAR AS day, count(*) AS rows, round(max(o_totalprice), 2) AS high, 'history' AS source,
       '2026-01-01 00:00:00' AS ingested_at_utc FROM orders GROUP BY 1""")
def _(spark, sf):
    o = table(spark, sf, "orders").select(F.to_date("o_orderdate").cast("string").alias("day"),
                                          F.col("o_totalprice").alias("high"))
    daily = o.groupBy("day").agg(F.count("*").alias("rows"), r(F.max("high"), 2).alias("high"))
    return S.add_ingestion_metadata(daily, "history", "2026-01-01 00:00:00").withColumn(
        "ingested_at_utc", F.col("ingested_at_utc").cast("string"))


@query("o01_sort", """
SELECT * FROM (SELECT n_regionkey, n_name, n_nationkey FROM nation) ORDER BY n_regionkey, n_name""")
def _(spark, sf):
    return table(spark, sf, "nation").select("n_regionkey", "n_name", "n_nationkey").orderBy("n_regionkey", "n_name")


@query("o02_head", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 25")
def _(spark, sf):
    return (table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
            .orderBy(F.desc("o_totalprice"), "o_orderkey").limit(25))


@query("o03_top_k", """
SELECT p_brand, count(*) AS rows FROM part GROUP BY 1 ORDER BY rows DESC, p_brand LIMIT 10""")
def _(spark, sf):
    counts = table(spark, sf, "part").groupBy("p_brand").agg(F.count("*").alias("rows"))
    return S.top_k(counts, "rows", "p_brand", 10)


@query("u01_union_all", """
SELECT side, count(*) AS rows, count(balance) AS balances, count(price) AS prices FROM (
  SELECT 'customer' AS side, c_acctbal AS balance, NULL AS price FROM customer
  UNION ALL SELECT 'supplier', s_acctbal, NULL FROM supplier
  UNION ALL SELECT 'part', NULL, p_retailprice FROM part) GROUP BY 1""")
def _(spark, sf):
    c = table(spark, sf, "customer").select(F.lit("customer").alias("side"), F.col("c_acctbal").alias("balance"))
    s = table(spark, sf, "supplier").select(F.col("s_acctbal").alias("balance"), F.lit("supplier").alias("side"))
    p = table(spark, sf, "part").select(F.lit("part").alias("side"), F.col("p_retailprice").alias("price"))
    return S.union_all(c, s, p).groupBy("side").agg(F.count("*").alias("rows"), F.count("balance").alias("balances"),
                                                    F.count("price").alias("prices"))


@query("u02_key_difference", """
SELECT DISTINCT l_orderkey AS key FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderpriority <> '1-URGENT')""")
def _(spark, sf):
    """Orders with lines that are not among the orders without haste."""
    li = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("key"))
    return S.key_difference(li, table(spark, sf, "orders").filter("o_orderpriority <> '1-URGENT'").select(F.col("o_orderkey").alias("key")), "key")


@query("u03_key_intersection", """
SELECT DISTINCT c_custkey AS key FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders)""")
def _(spark, sf):
    c = table(spark, sf, "customer").select(F.col("c_custkey").alias("key"))
    return S.key_intersection(c, table(spark, sf, "orders").select(F.col("o_custkey").alias("key")), "key")


@query("u04_sorted_distinct", "SELECT DISTINCT p_type, p_brand FROM part ORDER BY 1, 2")
def _(spark, sf):
    return S.sorted_distinct(table(spark, sf, "part"), "p_type", "p_brand")
