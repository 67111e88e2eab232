"""Registry and the roles that the star-schema tables play."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from harvestline.session import written
from harvestline.sources.rules import SCHEMA as RULE_SCHEMA, flatten_rules

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return register


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def stored(df: DataFrame, label: str) -> DataFrame:
    """The table written once to the shared working folder, for results that are scanned several times."""
    return written(df, label)


def r(c: Column | str, digits: int = 4) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.round(c, digits)


def text(c: Column | str) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return c.cast("string")


def rounded(df: DataFrame, digits: int = 4, nudge: float = 0.0) -> DataFrame:
    """Doubles rounded and dates as text, so that engines can be compared value by value.

    ``nudge`` moves values off exact halves, which differ in the last bit by the order of a sum.
    """
    out = []
    for f in df.schema.fields:
        kind = f.dataType.typeName()
        if kind == "double":
            value = F.col(f.name) + nudge if nudge else F.col(f.name)
            out.append(F.round(value, digits).alias(f.name))
        elif kind == "date":
            out.append(F.col(f.name).cast("string").alias(f.name))
        elif kind == "boolean":
            out.append(F.col(f.name).cast("int").alias(f.name))
        else:
            out.append(F.col(f.name))
    return df.select(*out)


# Price fact: line items of suppliers (markets) selling parts (commodities), a nation as the district.
PRICES_SQL = """
prices AS (
  SELECT 'Home' AS state, n_name AS district, CAST(l_suppkey AS VARCHAR) AS market, p_type AS commodity,
         p_brand AS variety, l_returnflag AS grade, CAST(l_shipdate AS DATE) AS arrival_date,
         l_extendedprice * (1 - l_discount) AS min_price, l_extendedprice * (1 + l_discount) AS max_price,
         l_extendedprice AS modal_price, CAST(p_size AS DOUBLE) AS commodity_code,
         CASE l_linestatus WHEN 'O' THEN 'current' ELSE 'history' END AS source, l_orderkey, l_linenumber
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
  JOIN part ON l_partkey = p_partkey)"""


def prices(spark: SparkSession, sf: str) -> DataFrame:
    li, su, na, pa = (table(spark, sf, t) for t in ("lineitem", "supplier", "nation", "part"))
    return (li.join(su, F.col("l_suppkey") == F.col("s_suppkey")).join(na, F.col("s_nationkey") == F.col("n_nationkey"))
            .join(pa, F.col("l_partkey") == F.col("p_partkey"))
            .select(F.lit("Home").alias("state"), F.col("n_name").alias("district"),
                    F.col("l_suppkey").cast("string").alias("market"), F.col("p_type").alias("commodity"),
                    F.col("p_brand").alias("variety"), F.col("l_returnflag").alias("grade"),
                    F.col("l_shipdate").cast("date").alias("arrival_date"),
                    (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("min_price"),
                    (F.col("l_extendedprice") * (1 + F.col("l_discount"))).alias("max_price"),
                    F.col("l_extendedprice").alias("modal_price"), F.col("p_size").cast("double").alias("commodity_code"),
                    F.when(F.col("l_linestatus") == "O", "current").otherwise("history").alias("source"),
                    "l_orderkey", "l_linenumber"))


ORDER = ["l_orderkey", "l_linenumber", "modal_price", "variety", "grade", "source"]
ORDER_SQL = "arrival_date, l_orderkey, l_linenumber, modal_price, variety, grade, source"

# Daily observations: orders of a customer nation per day.
WEATHER_SQL = """
weather AS (
  SELECT CAST(o_orderdate AS DATE) AS date, n_name AS district, max(o_totalprice) / 12347e0 AS t2m_max,
         min(o_totalprice) / 24989e0 AS t2m_min,
         CASE WHEN count(*) % 3 <> 0 THEN (max(o_totalprice) + min(o_totalprice)) / 31991e0 END AS t2m_mean,
         CASE WHEN count(*) % 4 <> 0 THEN least(100e0, 40e0 + 5e0 * count(*)) END AS rh2m,
         CAST(sum(o_custkey % 20) AS DOUBLE) AS precipitation, CAST(NULL AS DOUBLE) AS ws2m,
         CAST(max(o_orderkey % 50) AS DOUBLE) AS srad
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
  GROUP BY 1, 2)"""


def weather(spark: SparkSession, sf: str) -> DataFrame:
    o, c, n = (table(spark, sf, t) for t in ("orders", "customer", "nation"))
    price, rows = F.col("o_totalprice"), F.count("*")
    return (o.join(c, F.col("o_custkey") == F.col("c_custkey")).join(n, F.col("c_nationkey") == F.col("n_nationkey"))
            .groupBy(F.col("o_orderdate").cast("date").alias("date"), F.col("n_name").alias("district")).agg(
                (F.max(price) / 12347.0).alias("t2m_max"), (F.min(price) / 24989.0).alias("t2m_min"),
                F.when(rows % 3 != 0, (F.max(price) + F.min(price)) / 31991.0).alias("t2m_mean"),
                F.when(rows % 4 != 0, F.least(F.lit(100.0), 40.0 + 5.0 * rows)).alias("rh2m"),
                F.sum(F.col("o_custkey") % 20).cast("double").alias("precipitation"),
                F.lit(None).cast("double").alias("ws2m"),
                F.max(F.col("o_orderkey") % 50).cast("double").alias("srad")))


JOINED_SQL = PRICES_SQL + "," + WEATHER_SQL + """,
joined AS (
  SELECT p.*, w.t2m_max, w.t2m_min, w.t2m_mean, w.rh2m AS humidity, w.precipitation, w.srad AS solar_radiation,
         CASE WHEN w.date IS NOT NULL THEN 1 ELSE 0 END AS has_weather
  FROM prices p LEFT JOIN weather w ON p.arrival_date = w.date AND p.district = w.district)"""

# District dimension and raw spellings of it.
RAW_DISTRICT_SQL = """
raw_names AS (
  SELECT l_orderkey, l_linenumber, l_extendedprice, n_name,
         CASE l_orderkey % 7 WHEN 0 THEN n_name WHEN 1 THEN ' ' || lower(n_name) || ' ' WHEN 2 THEN n_name || ' District'
              WHEN 3 THEN 'Dist. ' || n_name WHEN 4 THEN n_name || ' (Rural)' WHEN 5 THEN 'Old ' || n_name
              ELSE NULL END AS raw
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey),
cleaned AS (
  SELECT *, trim(replace(trim(replace(trim(replace(lower(trim(raw)), 'district', '')), 'dist.', '')), 'dist', '')) AS key
  FROM raw_names),
mapped AS (
  SELECT c.*, coalesce(a.n_name, CASE WHEN position('(' IN key) > 0 THEN b.n_name END) AS canonical
  FROM cleaned c LEFT JOIN nation a ON c.key = lower(a.n_name)
  LEFT JOIN nation b ON trim(split_part(c.key, '(', 1)) = lower(b.n_name))"""


def raw_names(spark: SparkSession, sf: str) -> DataFrame:
    li, su, na = (table(spark, sf, t) for t in ("lineitem", "supplier", "nation"))
    k, name = F.col("l_orderkey") % 7, F.col("n_name")
    raw = (F.when(k == 0, name).when(k == 1, F.concat(F.lit(" "), F.lower(name), F.lit(" ")))
           .when(k == 2, F.concat(name, F.lit(" District"))).when(k == 3, F.concat(F.lit("Dist. "), name))
           .when(k == 4, F.concat(name, F.lit(" (Rural)"))).when(k == 5, F.concat(F.lit("Old "), name)))
    return (li.join(su, F.col("l_suppkey") == F.col("s_suppkey")).join(na, F.col("s_nationkey") == F.col("n_nationkey"))
            .select("l_orderkey", "l_linenumber", "l_extendedprice", "n_name", raw.alias("raw")))


def nation_aliases(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "nation").select(F.lower("n_name").alias("alias"), F.col("n_name").alias("canonical"))


def nations(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "nation").select(F.col("n_name").alias("district"))


# A rule document whose crops are the part types.
def _stage(name, a, b, critical):
    return {"name": name, "start_day": a, "end_day": b, "critical": critical}


RULE_DOC = {
    "risk_classification": {"low_max": 25, "medium_max": 50},
    "soil_thresholds": {"ph_min": 5.5, "ph_max": 8.0, "nitrogen_min_kg_ha": 200, "phosphorus_min_kg_ha": 15,
                        "potassium_min_kg_ha": 110},
    "crops": {
        kind: {
            "aliases": [f"{kind.title()} Grain", f"{kind.lower()}-x"], "crop_type": "kharif" if i % 2 else "rabi",
            "total_duration_days": 90 + 10 * i, "sowing_window": {"start_month": 6 + i % 3, "end_month": 8 + i % 3},
            "optimal_conditions": {"temp_optimal": 18 + 2 * i},
            "stages": [_stage("early", 0, 20 + i, True), _stage("mid", 21 + i, 60 + i, False),
                       _stage("late", 61 + i, 90 + 10 * i, True)],
            "sensitive_windows": [
                {"stage": "early", "risk_factor": "drought_stress", "severity": "high", "threshold_rainfall_7d_min": 20 + i},
                {"stage": "early", "risk_factor": "heat_stress", "severity": "medium", "threshold_temp_max": 35},
                {"stage": "mid", "risk_factor": "waterlogging", "severity": "medium", "threshold_rainfall_7d": 40 + i},
                {"stage": "late", "risk_factor": "high_humidity", "severity": "low", "threshold_humidity": 60},
                {"stage": "late", "risk_factor": "frost", "severity": "high", "threshold_temp_min": 5},
            ],
        }
        for i, kind in enumerate(["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"])
    },
}


def rules(spark: SparkSession) -> dict[str, DataFrame]:
    doc = spark.range(1).select(F.from_json(F.lit(json.dumps(RULE_DOC)), RULE_SCHEMA).alias("d")).select("d.*")
    return flatten_rules(doc)


def _values(rows: list[tuple]) -> str:
    def lit(v):
        if v is None:
            return "NULL"
        if isinstance(v, bool):
            return str(v).upper()
        return f"'{v}'" if isinstance(v, str) else str(v)
    return ", ".join("(" + ", ".join(lit(v) for v in row) + ")" for row in rows)


RULES_SQL = (
    "stages(crop, stage, start_day, end_day, critical) AS (VALUES " + _values([
        (c, s["name"], s["start_day"], s["end_day"], s["critical"])
        for c, d in RULE_DOC["crops"].items() for s in d["stages"]]) + "), "
    "windows(crop, rank, stage, risk_factor, severity, rain_max, rain_min, t_max, t_min, rh_max) AS (VALUES " + _values([
        (c, i, w["stage"], w["risk_factor"], w["severity"], w.get("threshold_rainfall_7d"),
         w.get("threshold_rainfall_7d_min"), w.get("threshold_temp_max"), w.get("threshold_temp_min"),
         w.get("threshold_humidity")) for c, d in RULE_DOC["crops"].items() for i, w in enumerate(d["sensitive_windows"])])
    + "), "
    "crops(crop, crop_type, total_duration_days, start_month, end_month, temp_optimal) AS (VALUES " + _values([
        (c, d["crop_type"], d["total_duration_days"], d["sowing_window"]["start_month"], d["sowing_window"]["end_month"],
         d["optimal_conditions"]["temp_optimal"]) for c, d in RULE_DOC["crops"].items()]) + "), "
    "crop_aliases(rank, alias, crop) AS (VALUES " + _values([
        (1000 * i + j, a.lower(), c) for i, (c, d) in enumerate(RULE_DOC["crops"].items())
        for j, a in enumerate([c, *d["aliases"]])]) + ")")

# Naive forecasts: the price h rows ago stands for the forecast of h rows ahead.
NAIVE = [1, 3, 7, 14]
PREDICTIONS_SQL = PRICES_SQL + f""",
lagged AS (SELECT *, {", ".join(f"lag(modal_price, {h}) OVER w AS l{h}" for h in NAIVE)} FROM prices
  WINDOW w AS (PARTITION BY commodity, market ORDER BY {ORDER_SQL})),
predictions AS (
  {" UNION ALL ".join(f"SELECT {h} AS horizon, modal_price AS y, l{h} AS yhat FROM lagged WHERE l{h} IS NOT NULL" for h in NAIVE)})"""
