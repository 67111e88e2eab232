"""Crop rules: stages, scores, labels, samples and batch assessment."""

from pyspark.sql import functions as F

from harvestline.operators import joins as J, risk as Rk, windows as W
from workload.features import WEATHER_FEATURES_SQL
from workload.base import PRICES_SQL, RULES_SQL, WEATHER_SQL, prices, query, r, rounded, rules, table, weather

CASES_SQL = RULES_SQL + "," + PRICES_SQL + "," + WEATHER_SQL + """,
cases AS (SELECT p.l_orderkey, p.l_linenumber, p.market, p.modal_price, p.commodity AS crop,
  CAST(p.arrival_date AS DATE) - CAST(o_orderdate AS DATE) AS days_since_sowing, w.precipitation AS rainfall_7d, w.t2m_max AS temp_max,
  w.t2m_min AS temp_min, w.t2m_mean AS temp_mean, w.rh2m AS humidity
  FROM prices p JOIN orders ON l_orderkey = o_orderkey LEFT JOIN weather w ON p.arrival_date = w.date AND p.district = w.district),
staged AS (SELECT c.*, coalesce(s.stage, 'post_harvest') AS stage, coalesce(s.critical, FALSE) AS critical
  FROM cases c LEFT JOIN stages s ON c.crop = s.crop AND days_since_sowing BETWEEN start_day AND end_day),
hit AS (SELECT s.*, coalesce(CASE w.severity WHEN 'low' THEN 0.25e0 WHEN 'high' THEN 1e0 ELSE 0.5e0 END, 0) AS weight, w.risk_factor,
  CASE WHEN rainfall_7d > rain_max THEN 30 ELSE 0 END + CASE WHEN rainfall_7d < rain_min THEN 30 ELSE 0 END
  + CASE WHEN temp_max > t_max THEN 25 ELSE 0 END + CASE WHEN temp_min < t_min THEN 25 ELSE 0 END + CASE WHEN humidity > rh_max THEN 20 ELSE 0 END AS points,
  CASE WHEN abs(temp_mean - temp_optimal) > 8 THEN 15 WHEN abs(temp_mean - temp_optimal) > 5 THEN 8 ELSE 0 END AS extra
  FROM staged s LEFT JOIN windows w ON s.crop = w.crop AND s.stage = w.stage LEFT JOIN crops k ON s.crop = k.crop),
scored AS (SELECT l_orderkey, l_linenumber, market, modal_price, crop, stage, critical, days_since_sowing, rainfall_7d, temp_max,
  least(sum(points * weight) + max(extra), 100) AS rule_score,
  count(CASE WHEN points > 0 THEN 1 END) + max(CASE WHEN extra = 15 THEN 1 ELSE 0 END) AS factors,
  max(CASE WHEN points > 0 AND risk_factor = 'drought_stress' THEN 1 ELSE 0 END) AS drought FROM hit GROUP BY ALL)"""


def cases(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("sown"))
    w = weather(spark, sf).select("date", "district", F.col("precipitation").alias("rainfall_7d"), F.col("t2m_max").alias("temp_max"),
                                  F.col("t2m_min").alias("temp_min"), F.col("t2m_mean").alias("temp_mean"), F.col("rh2m").alias("humidity"))
    p = prices(spark, sf).join(o, F.col("l_orderkey") == F.col("o_orderkey"))  # days before sowing are negative
    return (p.join(w, (F.col("arrival_date") == w["date"]) & (p["district"] == w["district"]), "left")
            .select("l_orderkey", "l_linenumber", "market", "modal_price", F.col("commodity").alias("crop"),
                    F.datediff("arrival_date", "sown").alias("days_since_sowing"), "rainfall_7d", "temp_max", "temp_min", "temp_mean", "humidity"))


def scored(spark, sf):
    k = rules(spark)
    return Rk.rule_score(J.stage_of(cases(spark, sf), k["stages"]), k["windows"], k["crops"])


ID = ["l_orderkey", "l_linenumber", "market", "modal_price", "crop", "stage"]
IDS = ", ".join(ID)


@query("j05_stage_of", "WITH " + CASES_SQL + f"""
SELECT {IDS}, CAST(critical AS INT) AS critical FROM staged""")
def _(spark, sf):
    return J.stage_of(cases(spark, sf), rules(spark)["stages"]).select(*ID, F.col("critical").cast("int").alias("critical"))


@query("g01_j06_rule_score", "WITH " + CASES_SQL + f"""
SELECT {IDS}, round(CAST(rule_score AS DOUBLE), 4) AS rule_score, CAST(factors AS BIGINT) AS factors, drought FROM scored""")
def _(spark, sf):
    drought = F.exists("risk_factors", lambda f: f.startswith("drought_stress")).cast("int")
    return scored(spark, sf).select(*ID, r("rule_score").alias("rule_score"), F.size("risk_factors").cast("long").alias("factors"),
                                    drought.alias("drought"))


@query("g02_risk_label", "WITH " + CASES_SQL + """,
x AS (SELECT *, rule_score * CASE WHEN critical THEN 1.25e0 ELSE 1 END AS s FROM scored)
SELECT crop, stage, CASE WHEN s < 25 THEN 0 WHEN s < 50 THEN 1 ELSE 2 END AS risk_level, count(*) AS rows FROM x GROUP BY 1, 2, 3""")
def _(spark, sf):
    return scored(spark, sf).groupBy("crop", "stage", Rk.risk_label(F.col("rule_score"), F.col("critical")).alias("risk_level")).agg(
        F.count("*").alias("rows"))


SOIL_SQL = CASES_SQL + """,
soiled AS (SELECT *, l_orderkey % 3 AS ml_risk, 4.5e0 + (l_orderkey % 10) * 0.5e0 AS ph, CAST(l_orderkey % 400 AS DOUBLE) AS n_kg, CAST(l_orderkey % 37 AS DOUBLE) AS p_kg FROM scored),
soil AS (SELECT *, CASE WHEN ph < 5.5 OR ph > 8 THEN 20 ELSE 0 END + CASE WHEN n_kg < 200 THEN 10 ELSE 0 END + CASE WHEN p_kg < 15 THEN 10 ELSE 0 END AS soil_score,
  (CASE WHEN ph < 5.5 OR ph > 8 THEN 1 ELSE 0 END + CASE WHEN n_kg < 200 THEN 1 ELSE 0 END + CASE WHEN p_kg < 15 THEN 1 ELSE 0 END) AS soil_factors FROM soiled),
base AS (SELECT *, CASE WHEN rule_score > 80 THEN 2 WHEN rule_score < 15 AND ml_risk = 2 THEN 1 ELSE ml_risk END AS b FROM soil),
decided AS (SELECT *, CASE WHEN soil_score > 30 AND b < 2 THEN b + 1 ELSE b END AS risk_level_code FROM base)"""


def decided(spark, sf):
    k = F.col("l_orderkey")
    s = scored(spark, sf).withColumns({"ml_risk": (k % 3).cast("int"), "ph": 4.5 + (k % 10) * 0.5,
                                       "nitrogen_kg_ha": (k % 400).cast("double"), "phosphorus_kg_ha": (k % 37).cast("double")})
    return Rk.hybrid_decision(Rk.soil_score(s), soil="soil_score")


@query("g09_soil_score", "WITH " + SOIL_SQL + f"SELECT {IDS}, soil_score, soil_factors FROM soil")
def _(spark, sf):
    return decided(spark, sf).select(*ID, "soil_score", F.size("soil_factors").alias("soil_factors"))


@query("g04_hybrid_decision", "WITH " + SOIL_SQL + f"""
SELECT {IDS}, CAST(risk_level_code AS INT) AS risk_level_code, CASE risk_level_code WHEN 0 THEN 'Low' WHEN 1 THEN 'Medium' ELSE 'High' END AS risk_level,
  CASE WHEN rule_score > 80 THEN 'Rule override: Critical risk factors detected'
       WHEN rule_score < 15 AND ml_risk = 2 THEN 'Hybrid adjustment: ML moderated by favorable conditions' END AS override_reason FROM decided""")
def _(spark, sf):
    return decided(spark, sf).select(*ID, "risk_level_code", "risk_level", "override_reason")


def _advice_sql():
    """The texts in their order, each under its condition."""
    cases = [("high", "lvl = 2"), ("drain_field", "lvl = 2 AND rainfall_7d > 100"), ("mulch", "lvl = 2 AND temp_max > 38"), ("channels", "lvl = 2 AND wl"),
             ("irrigate", "lvl = 2 AND drought = 1"), ("moderate", "lvl = 1"), ("updates", "lvl = 1"), ("favorable", "lvl = 0"), ("calendar", "lvl = 0")]
    quoted = lambda n: "'" + Rk.ADVICE[n].replace("'", "''") + "'"
    return "concat_ws('|', " + ", ".join(f"CASE WHEN {c} THEN {quoted(n)} END" for n, c in cases) + ")"


@query("g10_recommendations", "WITH " + SOIL_SQL + """,
told AS (SELECT d.*, CAST(risk_level_code AS INT) AS lvl, d.stage = 'mid' AND d.rainfall_7d > (SELECT rain_max FROM windows w WHERE w.crop = d.crop AND w.risk_factor = 'waterlogging') AS wl FROM decided d)
SELECT crop, stage, lvl AS level, """ + _advice_sql() + """ AS advice, count(*) AS rows FROM told GROUP BY 1, 2, 3, 4""")
def _(spark, sf):
    d = decided(spark, sf)
    advice = Rk.recommendations(F.col("risk_level_code"), F.col("risk_factors"), F.col("rainfall_7d"), F.col("temp_max"), F.lit(0))
    return d.groupBy("crop", "stage", F.col("risk_level_code").alias("level"), F.array_join(advice, "|").alias("advice")).agg(F.count("*").alias("rows"))


@query("j11_resolve_synonym", "WITH " + RULES_SQL + """,
asked AS (SELECT DISTINCT p_type, CASE p_size % 4 WHEN 0 THEN p_type WHEN 1 THEN lower(p_type) || ' GRAIN' WHEN 2 THEN substr(p_type, 1, 4)
  ELSE 'z' || p_brand END AS raw FROM part),
m AS (SELECT a.raw, c.crop, row_number() OVER (PARTITION BY a.raw ORDER BY CASE WHEN c.alias = lower(a.raw) THEN 0 ELSE 1 END, c.rank) AS rn
  FROM (SELECT DISTINCT raw FROM asked) a LEFT JOIN crop_aliases c ON position(lower(a.raw) IN c.alias) > 0 OR position(c.alias IN lower(a.raw)) > 0)
SELECT p_type, asked.raw, crop FROM asked JOIN m ON asked.raw = m.raw AND rn = 1""")
def _(spark, sf):
    k, kind = F.col("p_size") % 4, F.col("p_type")
    raw = (F.when(k == 0, kind).when(k == 1, F.concat(F.lower(kind), F.lit(" GRAIN"))).when(k == 2, F.substring(kind, 1, 4))
           .otherwise(F.concat(F.lit("z"), "p_brand")))
    asked = table(spark, sf, "part").select("p_type", raw.alias("raw"))
    return J.resolve_synonym(asked, "raw", rules(spark)["aliases"]).select("p_type", "raw", "crop").distinct()


@query("s11_rule_tables", "WITH " + RULES_SQL + "," + PRICES_SQL + """
SELECT s.crop, s.stage, s.start_day, s.end_day, CAST(s.critical AS INT) AS critical, crop_type, total_duration_days, count(*) AS rows,
  (SELECT count(*) FROM windows w WHERE w.crop = s.crop AND w.stage = s.stage) AS windows
FROM prices p JOIN stages s ON p.commodity = s.crop JOIN crops k ON k.crop = s.crop GROUP BY ALL""")
def _(spark, sf):
    k = rules(spark)
    n = k["windows"].groupBy("crop", "stage").agg(F.count("*").alias("windows"))
    rows = prices(spark, sf).groupBy(F.col("commodity").alias("crop")).agg(F.count("*").alias("rows"))
    return (k["stages"].join(k["crops"].select("crop", "crop_type", "total_duration_days"), "crop").join(rows, "crop")
            .join(n, ["crop", "stage"], "left").select("crop", "stage", "start_day", "end_day", F.col("critical").cast("int").alias("critical"),
                                                       "crop_type", "total_duration_days", "rows", F.coalesce("windows", F.lit(0)).cast("long").alias("windows")))


def samples(spark, sf, per_crop=6000):
    return Rk.training_samples(W.weather_features(weather(spark, sf)), rules(spark), per_crop)


def _drawn(k, *more):
    """The number that a sample draws, as the operator states it."""
    keys = ", ".join(["crop", "year", "sample", *more])
    return f"(CAST('0x' || substr(md5(concat_ws('|', {42 + k}, {keys})), 1, 13) AS BIGINT) / 4503599627370496e0)"


SAMPLES_SQL = RULES_SQL + "," + WEATHER_FEATURES_SQL + f""",
wf AS MATERIALIZED (SELECT *, temp_max_7d - temp_min_7d AS temp_range_7d, vpd_7d / (1 + rainfall_7d / 50) AS drought_7d FROM feat
  WHERE rainfall_7d IS NOT NULL AND temp_mean_7d IS NOT NULL),
span AS (SELECT extract(year FROM min(date)) AS a, extract(year FROM max(date)) AS b, count(DISTINCT extract(year FROM date)) AS n,
  list(DISTINCT district ORDER BY district) AS places FROM wf),
draws AS (SELECT c.*, places, y.year, s.sample FROM crops c, span, unnest(range(a + 1, b)) y(year),
  unnest(range(1, greatest(1, 6000 // greatest(1, n - 2)) + 1)) s(sample) WHERE b - a >= 2),
sown AS (SELECT crop, year, sample, temp_optimal, places[1 + CAST(floor({_drawn(30)} * len(places)) AS INT)] AS district,
  make_date(CAST(year AS INT), CAST(start_month + floor({_drawn(10)} * (end_month - start_month + 1)) AS INT), 1 + CAST(floor({_drawn(20)} * 27) AS INT)) AS sowing FROM draws),
dated AS (SELECT s.*, g.stage, g.critical, sowing + CAST(start_day + floor({_drawn(40, "g.stage").replace("crop,", "s.crop,")} * (end_day - start_day + 1)) AS INT) AS day
  FROM sown s JOIN stages g ON s.crop = g.crop),
seen AS (SELECT d.*, w.* EXCLUDE (district, date) FROM dated d JOIN wf w ON d.district = w.district AND d.day = w.date),
hit AS (SELECT s.*, coalesce(CASE w.severity WHEN 'low' THEN 0.25e0 WHEN 'high' THEN 1e0 ELSE 0.5e0 END, 0) AS weight,
  CASE WHEN rainfall_7d > rain_max THEN 30 ELSE 0 END + CASE WHEN rainfall_7d < rain_min THEN 30 ELSE 0 END
  + CASE WHEN temp_max_7d > t_max THEN 25 ELSE 0 END + CASE WHEN temp_min_7d < t_min THEN 25 ELSE 0 END + CASE WHEN humidity_7d > rh_max THEN 20 ELSE 0 END AS points,
  CASE WHEN abs(temp_mean_7d - temp_optimal) > 8 THEN 15 WHEN abs(temp_mean_7d - temp_optimal) > 5 THEN 8 ELSE 0 END AS extra
  FROM seen s LEFT JOIN windows w ON s.crop = w.crop AND s.stage = w.stage),
sums AS (SELECT crop, year, sample, stage, critical, district, day, least(sum(points * weight) + max(extra), 100) AS score FROM hit
  WHERE """ + " AND ".join(f"{c} IS NOT NULL" for c in ["rainfall_3d", "rainfall_14d", "rainfall_max_day_7d", "rainfall_days_7d", "temp_max_7d", "temp_min_7d",
                                                         "temp_std_7d", "humidity_7d", "humidity_max_7d", "hot_days_7d", "cold_days_7d", "wet_days_7d",
                                                         "gdd_7d", "gdd_14d", "vpd_7d", "drought_7d"]) + f""" GROUP BY ALL),
labelled AS (SELECT *, score * CASE WHEN critical THEN 1.25e0 ELSE 1 END
  + sqrt(-2 * ln(1 - {_drawn(50, "stage")})) * cos(2 * pi() * {_drawn(51, "stage")}) * 12 AS s FROM sums)"""


@query("g03_samples_by_year", "WITH " + SAMPLES_SQL + """
SELECT crop, stage, CAST(extract(year FROM day) AS INT) AS year, district, count(*) AS rows, round(sum(score), 2) AS scores, CAST(min(day) AS VARCHAR) AS first, CAST(max(day) AS VARCHAR) AS last
FROM labelled GROUP BY ALL""")
def _(spark, sf):
    return samples(spark, sf).groupBy("crop", "stage", F.year("current_date").alias("year"), "district").agg(
        F.count("*").alias("rows"), r(F.sum("rule_score"), 2).alias("scores"), F.min("current_date").cast("string").alias("first"),
        F.max("current_date").cast("string").alias("last"))


@query("g03_training_samples", "WITH " + SAMPLES_SQL + """
SELECT crop, stage, CASE WHEN s < 25 THEN 0 WHEN s < 50 THEN 1 ELSE 2 END AS risk_level, count(*) AS rows FROM labelled GROUP BY 1, 2, 3""")
def _(spark, sf):
    return samples(spark, sf).groupBy("crop", "stage", "risk_level").agg(F.count("*").alias("rows"))


FORECAST_START = "2000-03-01"


def requests(spark, sf):
    o = table(spark, sf, "orders").join(table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey")).join(
        table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    kinds = F.array(*[F.lit(x) for x in ("Economy Grain", "large", "MEDIUM", "promo-x", "Small", "unknown grain", "standard")])
    return o.select("o_orderkey", F.get(kinds, (F.col("o_orderkey") % 7).cast("int")).alias("crop"), F.col("n_name").alias("district"),
                    F.to_date("o_orderdate").alias("sowing_date"),
                    F.date_add("o_orderdate", (F.col("o_orderkey") % 160).cast("int") - 10).alias("as_of"))


@query("g11_assess", "WITH " + RULES_SQL + """,
req AS (SELECT o_orderkey, list_extract(['ECONOMY', 'LARGE', 'MEDIUM', 'PROMO', 'SMALL', NULL, 'STANDARD'], CAST(o_orderkey % 7 + 1 AS INT)) AS crop,
  o_orderkey % 160 - 10 AS days FROM orders)
SELECT o_orderkey, CASE WHEN days < 0 THEN 'Sowing date is in the future' WHEN r.crop IS NULL THEN 'Unknown crop: unknown grain' END AS error,
  CASE WHEN days >= 0 THEN r.crop END AS crop, CASE WHEN days >= 0 AND r.crop IS NOT NULL THEN coalesce(stage, 'post_harvest') END AS current_stage,
  CASE WHEN days >= 0 AND r.crop IS NOT NULL THEN round(least(CAST(days AS DOUBLE) / total_duration_days, 1), 4) END AS stage_progress,
  CAST(days AS INT) AS days_since_sowing
FROM req r LEFT JOIN stages s ON r.crop = s.crop AND days BETWEEN start_day AND end_day LEFT JOIN crops k ON r.crop = k.crop""")
def _(spark, sf):
    out = Rk.assess(requests(spark, sf), weather(spark, sf), rules(spark), start=FORECAST_START)
    return rounded(out.select("o_orderkey", "error", "crop", "current_stage", "stage_progress", "days_since_sowing"))


ASSESS_SQL = RULES_SQL + "," + WEATHER_SQL + f""",
f AS (SELECT *, row_number() OVER (PARTITION BY district ORDER BY date) AS d FROM weather WHERE date >= DATE '{FORECAST_START}'),
st AS MATERIALIZED (SELECT district, coalesce(sum(precipitation) FILTER (d <= 7), 0) AS rainfall_7d, max(t2m_max) FILTER (d <= 7) AS temp_max,
  min(t2m_min) FILTER (d <= 7) AS temp_min, avg(t2m_mean) FILTER (d <= 7) AS temp_mean, avg(rh2m) FILTER (d <= 7) AS humidity,
  count(*) FILTER (d <= 7 AND t2m_max > 35) AS hot_days FROM f WHERE d <= 15 GROUP BY 1),
req AS (SELECT o_orderkey, n_name AS district, o_orderkey % 160 - 10 AS days,
  list_extract(['ECONOMY', 'LARGE', 'MEDIUM', 'PROMO', 'SMALL', NULL, 'STANDARD'], CAST(o_orderkey % 7 + 1 AS INT)) AS crop
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey),
asked AS (SELECT r.o_orderkey, r.crop, coalesce(s.stage, 'post_harvest') AS stage, w.* EXCLUDE (district) FROM req r
  LEFT JOIN st k ON k.district = r.district JOIN st w ON w.district = coalesce(k.district, (SELECT min(district) FROM st))
  LEFT JOIN stages s ON r.crop = s.crop AND days BETWEEN start_day AND end_day WHERE days >= 0 AND r.crop IS NOT NULL),
hit AS (SELECT a.*, coalesce(CASE w.severity WHEN 'low' THEN 0.25e0 WHEN 'high' THEN 1e0 ELSE 0.5e0 END, 0) AS weight, w.risk_factor,
  CASE WHEN rainfall_7d > rain_max THEN 30 ELSE 0 END + CASE WHEN rainfall_7d < rain_min THEN 30 ELSE 0 END
  + CASE WHEN temp_max > t_max THEN 25 ELSE 0 END + CASE WHEN temp_min < t_min THEN 25 ELSE 0 END + CASE WHEN humidity > rh_max THEN 20 ELSE 0 END AS points,
  CASE WHEN abs(temp_mean - temp_optimal) > 8 THEN 15 WHEN abs(temp_mean - temp_optimal) > 5 THEN 8 ELSE 0 END AS extra
  FROM asked a LEFT JOIN windows w ON a.crop = w.crop AND a.stage = w.stage LEFT JOIN crops k ON a.crop = k.crop),
fin AS (SELECT o_orderkey, crop, stage, rainfall_7d, temp_max, hot_days, least(sum(points * weight) + max(extra), 100) AS score,
  max(CASE WHEN points > 0 AND risk_factor LIKE '%waterlogging%' THEN 1 ELSE 0 END) AS wet,
  max(CASE WHEN points > 0 AND risk_factor LIKE '%drought%' THEN 1 ELSE 0 END) AS dry FROM hit GROUP BY ALL)
SELECT crop, stage AS current_stage, CASE WHEN score > 80 THEN 'High' ELSE 'Medium' END AS risk_level, round(CAST(score AS DOUBLE), 1) AS rule_based_score,
  count(*) AS rows, max(CASE WHEN score > 80 THEN 1 + CASE WHEN rainfall_7d > 100 THEN 1 ELSE 0 END + CASE WHEN temp_max > 38 THEN 1 ELSE 0 END + wet + dry
  ELSE 2 + CASE WHEN hot_days > 3 THEN 1 ELSE 0 END END) AS advice FROM fin GROUP BY 1, 2, 3, 4"""


@query("g11_assess_levels", "WITH " + ASSESS_SQL)
def _(spark, sf):
    out = Rk.assess(requests(spark, sf), weather(spark, sf), rules(spark), start=FORECAST_START).filter(F.col("error").isNull())
    return out.groupBy("crop", "current_stage", "risk_level", "rule_based_score").agg(
        F.count("*").alias("rows"), F.max(F.size("recommendations")).alias("advice"))
