"""Deduplication, upsert, latest rows and duplicate statistics."""

from pyspark.sql import functions as F

from harvestline.operators import dedup
from workload.base import ORDER, PRICES_SQL, WEATHER_SQL, prices, query, rounded, table, weather

KEY = ["l_orderkey", "l_linenumber"]
LINE = ["l_orderkey", "l_linenumber", "l_suppkey", "l_partkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
        "l_returnflag", "l_linestatus", "l_shipdate"]
TIES = "l_suppkey, l_partkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate"


def lines(spark, sf):
    return table(spark, sf, "lineitem").select(*LINE)


def shown(df):
    return df.select("l_orderkey", "l_linenumber", "l_suppkey", "l_partkey", "l_extendedprice", "l_linestatus",
                     F.to_date("l_shipdate").cast("string").alias("day"))


SHOWN = """l_orderkey, l_linenumber, l_suppkey, l_partkey, l_extendedprice, l_linestatus,
  CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS day"""


@query("w01_dedup_priority", f"""
SELECT {SHOWN} FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY
  CASE l_linestatus WHEN 'O' THEN 2 WHEN 'F' THEN 1 ELSE 0 END DESC,
  (CASE WHEN nullif(l_discount, 0) IS NOT NULL THEN 1 ELSE 0 END + CASE WHEN nullif(l_tax, 0) IS NOT NULL THEN 1 ELSE 0 END
   + 1) DESC, coalesce(l_extendedprice, 0) DESC, {TIES}) AS rn FROM lineitem) WHERE rn = 1""")
def _(spark, sf):
    li = lines(spark, sf).withColumns({"_d": F.nullif("l_discount", F.lit(0.0)), "_t": F.nullif("l_tax", F.lit(0.0))})
    return shown(dedup.dedup_priority(li, KEY, "l_linestatus", ["_d", "_t", "l_extendedprice"], "l_extendedprice",
                                      {"O": 2, "F": 1}))


@query("w02_dedup_observations", "WITH " + WEATHER_SQL + """,
raw AS (SELECT * FROM weather UNION ALL SELECT date, district, t2m_max, NULL, NULL, NULL, precipitation, NULL, NULL FROM weather)
SELECT CAST(date AS VARCHAR) AS date, district, round(t2m_max, 4) AS t2m_max, round(t2m_min, 4) AS t2m_min, rh2m FROM (
  SELECT *, row_number() OVER (PARTITION BY date, district ORDER BY
    (CASE WHEN t2m_min IS NOT NULL THEN 1 ELSE 0 END + CASE WHEN rh2m IS NOT NULL THEN 1 ELSE 0 END) DESC) AS rn FROM raw)
WHERE rn = 1""")
def _(spark, sf):
    w = weather(spark, sf)
    poor = w.select("date", "district", "t2m_max", "precipitation")
    return rounded(dedup.dedup_observations(w.unionByName(poor, allowMissingColumns=True))
                   .select("date", "district", "t2m_max", "t2m_min", "rh2m"))


@query("w03_keep_last", f"""
SELECT {SHOWN} FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC,
  l_extendedprice DESC, l_suppkey, l_partkey, l_quantity, l_discount, l_tax, l_returnflag, l_linestatus) AS rn FROM lineitem)
WHERE rn = 1""")
def _(spark, sf):
    return shown(dedup.keep_last(lines(spark, sf), KEY, ["l_shipdate", "l_extendedprice"]))


def _upsert_sql(first, second):
    return f"""
SELECT {SHOWN} FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY
  CASE l_linestatus WHEN '{first}' THEN 0 ELSE 1 END, l_extendedprice DESC, {TIES}) AS rn FROM lineitem) WHERE rn = 1"""


@query("w04_upsert_updates_win", _upsert_sql("O", "F"))
def _(spark, sf):
    li = lines(spark, sf)
    return shown(dedup.upsert(li.filter("l_linestatus = 'F'"), li.filter("l_linestatus = 'O'"), KEY,
                              order=[F.col("l_extendedprice").desc()]))


@query("w04_upsert_base_wins", _upsert_sql("F", "O"))
def _(spark, sf):
    li = lines(spark, sf)
    return shown(dedup.upsert(li.filter("l_linestatus = 'F'"), li.filter("l_linestatus = 'O'"), KEY, prefer="base",
                              order=[F.col("l_extendedprice").desc()]))


@query("w05_distinct_union", """
SELECT l_returnflag, l_linestatus, l_linenumber, l_suppkey FROM lineitem
UNION SELECT l_returnflag, l_linestatus, l_linenumber, l_suppkey FROM lineitem""")
def _(spark, sf):
    li = lines(spark, sf).select("l_returnflag", "l_linestatus", "l_linenumber", "l_suppkey")
    return li.unionByName(li).distinct()


@query("w06_duplicates", f"""
SELECT {SHOWN} FROM (SELECT *, count(*) OVER (PARTITION BY l_orderkey, l_linenumber) AS n FROM lineitem) WHERE n > 1""")
def _(spark, sf):
    return shown(dedup.duplicates(lines(spark, sf), KEY))


@query("a07_duplicate_stats", """
WITH g AS (SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2)
SELECT CAST(sum(n) AS BIGINT) AS total_rows, count(*) AS unique_rows, CAST(sum(CASE WHEN n > 1 THEN n END) AS BIGINT) AS duplicate_rows,
       count(CASE WHEN n > 1 THEN 1 END) AS duplicate_keys, CAST(sum(n) - count(*) AS BIGINT) AS rows_to_remove,
       round((sum(n) - count(*)) * 100e0 / sum(n), 4) AS dedup_pct FROM g""")
def _(spark, sf):
    return rounded(dedup.duplicate_stats(lines(spark, sf), KEY))


@query("w17_latest", "WITH " + PRICES_SQL + """
SELECT commodity, market, CAST(arrival_date AS VARCHAR) AS arrival_date, modal_price FROM (
  SELECT *, row_number() OVER (PARTITION BY commodity, market ORDER BY arrival_date DESC, l_orderkey DESC, l_linenumber DESC,
    modal_price DESC) AS rn FROM prices) WHERE rn = 1""")
def _(spark, sf):
    newest = dedup.latest(prices(spark, sf), ["commodity", "market"], ["arrival_date", "l_orderkey", "l_linenumber", "modal_price"])
    return rounded(newest.select("commodity", "market", "arrival_date", "modal_price"), 2)
