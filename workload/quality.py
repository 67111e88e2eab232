"""Data contracts, repair, gates and report tables."""

from pyspark.sql import functions as F

from harvestline.operators import joins as J, quality as Q
from harvestline.operators.dedup import keep_first
from harvestline.operators.impute import impute
from harvestline.plans import reports as R
from workload.base import (JOINED_SQL, ORDER, PRICES_SQL, WEATHER_SQL, nations, prices, query, rounded, stored, table,
                           weather)

# Prices with planted faults, made from columns of the fact.
FAULTY_SQL = PRICES_SQL + """,
faulty AS (SELECT CASE WHEN l_orderkey % 11 = 0 THEN 'Away' ELSE state END AS state,
  CASE WHEN l_orderkey % 13 = 0 THEN '' ELSE district END AS district, market, commodity, variety, grade, arrival_date,
  CASE WHEN l_orderkey % 7 = 0 THEN -min_price WHEN l_orderkey % 5 = 0 THEN max_price ELSE min_price END AS min_price,
  CASE WHEN l_orderkey % 5 = 0 THEN min_price ELSE max_price END AS max_price,
  CASE WHEN l_orderkey % 17 = 0 THEN modal_price * 2 WHEN l_orderkey % 19 = 0 THEN NULL ELSE modal_price END AS modal_price,
  CASE WHEN l_orderkey % 23 = 0 THEN 'web' ELSE source END AS source, l_orderkey, l_linenumber FROM prices)"""


def faulty(spark, sf):
    k = lambda n: F.col("l_orderkey") % n == 0
    p = prices(spark, sf)
    return p.select(
        F.when(k(11), "Away").otherwise(F.col("state")).alias("state"), F.when(k(13), "").otherwise(F.col("district")).alias("district"),
        "market", "commodity", "variety", "grade", "arrival_date",
        F.when(k(7), -F.col("min_price")).when(k(5), F.col("max_price")).otherwise(F.col("min_price")).alias("min_price"),
        F.when(k(5), F.col("min_price")).otherwise(F.col("max_price")).alias("max_price"),
        F.when(k(17), F.col("modal_price") * 2).when(k(19), None).otherwise(F.col("modal_price")).alias("modal_price"),
        F.when(k(23), "web").otherwise(F.col("source")).alias("source"), "l_orderkey", "l_linenumber")


def _rule(name, bad, severity="error"):
    return f"SELECT count(*) AS rows, '{name}' AS rule, '{severity}' AS severity, count(CASE WHEN {bad} THEN 1 END) AS broken FROM faulty"


PRICE_RULES_SQL = [
    *[(f"{c}_filled", f"{c} IS NULL OR length({c}) < 1") for c in ("state", "district", "market", "commodity")],
    ("arrival_date_present", "arrival_date IS NULL"), ("state_scope", "lower(trim(state)) <> 'home'"),
    ("source_allowed", "source NOT IN ('history', 'current')"),
    *[(f"{c}_range", f"{c} < 0") for c in ("min_price", "max_price", "modal_price")],
    ("min_not_above_max", "min_price > max_price"), ("modal_inside", "modal_price < min_price OR modal_price > max_price"),
]


@query("v01_price_contract", "WITH " + FAULTY_SQL + " UNION ALL ".join(_rule(n, b) for n, b in PRICE_RULES_SQL))
def _(spark, sf):
    return Q.violation_report(faulty(spark, sf), Q.price_contract(scope="Home"))


@query("v01_split_valid", "WITH " + FAULTY_SQL + f"""
SELECT district, count(*) AS rows, max(modal_price) AS high FROM faulty
WHERE NOT coalesce({" OR ".join(f"coalesce({b}, FALSE)" for _, b in PRICE_RULES_SQL)}, FALSE) GROUP BY 1""")
def _(spark, sf):
    valid, _ = Q.split_valid(faulty(spark, sf), Q.price_contract(scope="Home"))
    return valid.groupBy("district").agg(F.count("*").alias("rows"), F.max("modal_price").alias("high"))


@query("v02_normalize_raw_prices", "WITH " + PRICES_SQL + """
SELECT state, upper(left(district, 1)) || lower(substr(district, 2)) AS district, CASE WHEN l_linenumber = 3 THEN NULL ELSE upper(left(grade, 1)) END AS grade,
  CAST(arrival_date AS VARCHAR) AS arrival_date, CASE WHEN l_linenumber = 2 THEN NULL WHEN l_linenumber = 4 THEN NULL ELSE modal_price END AS modal_price,
  l_orderkey, l_linenumber, market FROM prices WHERE l_linenumber <> 5""")
def _(spark, sf):
    p, n = prices(spark, sf), F.col("l_linenumber")
    raw = p.select(
        F.when(n == 5, "Elsewhere").otherwise(F.concat(F.lit(" "), F.upper("state"))).alias("State_Name"),
        F.concat(F.lit(" "), F.upper("district"), F.lit(" ")).alias("District Name"), F.col("market").alias("Mandi"),
        F.lower("commodity").alias("Commodity"), F.col("variety"), F.when(n == 3, "NaN").otherwise(F.lower("grade")).alias("Grade"),
        F.date_format("arrival_date", "dd/MM/yyyy").alias("Price Date"),
        F.when(n == 2, "n/a").when(n == 4, "-5").otherwise(F.col("modal_price").cast("string")).alias("Modal Price"),
        "l_orderkey", "l_linenumber")
    valid, _ = Q.normalize_raw_prices(raw, "Home")
    return rounded(valid.select("state", "district", "grade", "arrival_date", "modal_price", "l_orderkey", "l_linenumber", "market"))


def _range(c, lo, hi, t="weather"):
    parts = ([f"{c} < {lo}"] if lo is not None else []) + ([f"{c} > {hi}"] if hi is not None else [])
    return f"SELECT count(*) AS rows, '{c}_range' AS rule, 'error' AS severity, count(CASE WHEN {' OR '.join(parts)} THEN 1 END) AS broken FROM {t}"


@query("v03_weather_contract", "WITH " + WEATHER_SQL + """
SELECT count(*) AS rows, 'date_present' AS rule, 'error' AS severity, CAST(0 AS BIGINT) AS broken FROM weather
UNION ALL SELECT count(*), 'district_filled', 'error', 0 FROM weather UNION ALL """ + " UNION ALL ".join(
    _range(c, *lim) for c, lim in Q.OBSERVED_RANGES.items()))
def _(spark, sf):
    w = weather(spark, sf)
    return Q.violation_report(w, Q.weather_contract(w.columns))


@query("v04_file_report", "WITH " + FAULTY_SQL + """,
e AS (SELECT source AS file, count(*) AS rows,
  sum(CASE WHEN modal_price IS NULL THEN 1 ELSE 0 END) + sum(CASE WHEN modal_price < 0 OR modal_price > 1000000 THEN 1 ELSE 0 END)
  + sum(CASE WHEN min_price < 0 THEN 1 ELSE 0 END) + sum(CASE WHEN max_price < 0 THEN 1 ELSE 0 END) AS errors,
  sum(CASE WHEN modal_price < min_price * 0.9e0 OR modal_price > max_price * 1.1e0 THEN 1 ELSE 0 END) AS warnings FROM faulty GROUP BY 1)
SELECT file, rows, CAST(errors AS BIGINT) AS errors, CAST(warnings AS BIGINT) AS warnings,
  CASE WHEN errors > 0 THEN 2 WHEN warnings > 0 THEN 1 ELSE 0 END AS code,
  CASE WHEN errors > 0 THEN 'invalid' ELSE 'valid' END AS status FROM e""")
def _(spark, sf):
    return Q.file_report(faulty(spark, sf).withColumnRenamed("source", "file"), "prices")


REPAIRED_SQL = FAULTY_SQL + """,
n AS (SELECT *, CASE WHEN min_price >= 0 THEN min_price END AS lo, CASE WHEN max_price >= 0 THEN max_price END AS hi,
      CASE WHEN modal_price >= 0 THEN modal_price END AS mid FROM faulty),
s AS (SELECT *, CASE WHEN lo > hi THEN hi ELSE lo END AS low, CASE WHEN lo > hi THEN lo ELSE hi END AS high,
      lo IS NOT NULL AND hi IS NOT NULL AS complete FROM n)"""


@query("v05_repair_prices", "WITH " + REPAIRED_SQL + """
SELECT l_orderkey, l_linenumber, market, round(low, 6) AS min_price, round(high, 6) AS max_price,
  round(CASE WHEN complete AND mid < low THEN low WHEN complete AND mid > high THEN high ELSE mid END, 6) AS modal_price,
  (CASE WHEN min_price < 0 THEN 1 ELSE 0 END + CASE WHEN max_price < 0 THEN 1 ELSE 0 END + CASE WHEN modal_price < 0 THEN 1 ELSE 0 END) AS negative_prices,
  CASE WHEN lo > hi THEN 1 ELSE 0 END AS min_gt_max, CASE WHEN complete AND (mid < low OR mid > high) THEN 1 ELSE 0 END AS modal_out_of_range FROM s""")
def _(spark, sf):
    return rounded(Q.repair_prices(faulty(spark, sf)).select(
        "l_orderkey", "l_linenumber", "market", "min_price", "max_price", "modal_price", "negative_prices", "min_gt_max",
        "modal_out_of_range"), 6)


@query("a19_price_violation_counts", "WITH " + REPAIRED_SQL + """,
c AS (SELECT count(CASE WHEN min_price < 0 THEN 1 END) + count(CASE WHEN max_price < 0 THEN 1 END) + count(CASE WHEN modal_price < 0 THEN 1 END) AS a,
  count(CASE WHEN lo > hi THEN 1 END) AS b, count(CASE WHEN complete AND (mid < low OR mid > high) THEN 1 END) AS d FROM s)
SELECT a AS negative_prices, b AS min_gt_max, d AS modal_out_of_range, a + b + d AS rows_fixed FROM c""")
def _(spark, sf):
    return Q.price_violation_counts(Q.repair_prices(faulty(spark, sf)))


@query("v06_output_gate", "WITH " + PRICES_SQL + """,
g AS (SELECT (SELECT count(*) FROM prices) = (SELECT count(*) FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM prices)) AS u,
  NOT EXISTS (SELECT 1 FROM prices WHERE district NOT IN (SELECT n_name FROM nation)) AS m, NOT EXISTS (SELECT 1 FROM prices WHERE lower(state) <> 'home') AS s)
SELECT CAST(u AS INT) AS unique_keys, CAST(m AS INT) AS known_members, CAST(s AS INT) AS scope_kept, CAST(u AND m AND s AS INT) AS passed FROM g""")
def _(spark, sf):
    gate = Q.output_gate(prices(spark, sf), ["l_orderkey", "l_linenumber"], nations(spark, sf), "district", "state", "Home")
    return rounded(gate)


def with_absent(spark, sf):
    """All districts, and one that no table has."""
    return nations(spark, sf).unionByName(spark.range(1).select(F.lit("Nowhere").alias("district")))


@query("v07_missing_after_filter", "WITH " + PRICES_SQL + """
SELECT 'Nowhere' AS district UNION ALL SELECT n_name FROM nation WHERE n_name NOT IN (SELECT district FROM prices)""")
def _(spark, sf):
    return J.missing_members(with_absent(spark, sf), prices(spark, sf), "district")


def _profile(section, col, source, median=False):
    """The figures of a measure as text rounded to three digits."""
    stats = [("mean", f"avg({col})"), ("min", f"min({col})"), ("max", f"max({col})"), ("null_pct", f"avg(CASE WHEN {col} IS NULL THEN 1 ELSE 0 END) * 100")]
    stats += [("median", f"quantile_cont({col}, 0.5)")] if median else []
    names, values = ", ".join(f"'{col}_{n}'" for n, _ in stats), ", ".join(f"printf('%.3f', round({e} + 3e-7, 3))" for _, e in stats)
    return f"SELECT '{section}', unnest([{names}]), unnest([{values}]) FROM {source}"


def _values(report, sections=("prices", "measures")):
    """Reports with the figures of measures at three digits, which engines agree on."""
    figure = F.format_string("%.3f", F.round(F.col("value").cast("double") + 3e-7, 3))
    return report.withColumn("value", F.when(F.col("section").isin(*sections) & F.col("value").isNotNull(), figure).otherwise(F.col("value")))


@query("g15_price_report", "WITH " + PRICES_SQL + """,
g AS (SELECT state, district, market, commodity, variety, grade, arrival_date, count(*) AS n FROM prices GROUP BY ALL)
SELECT * FROM (
 SELECT 'summary' AS section, unnest(['total_rows', 'date_min', 'date_max', 'unique_dates', 'unique_state', 'unique_district', 'unique_market', 'unique_commodity']) AS metric,
  unnest([CAST(count(*) AS VARCHAR), CAST(min(arrival_date) AS VARCHAR), CAST(max(arrival_date) AS VARCHAR), CAST(count(DISTINCT arrival_date) AS VARCHAR),
   CAST(count(DISTINCT state) AS VARCHAR), CAST(count(DISTINCT district) AS VARCHAR), CAST(count(DISTINCT market) AS VARCHAR), CAST(count(DISTINCT commodity) AS VARCHAR)]) AS value FROM prices
 UNION ALL SELECT 'summary', unnest(['duplicate_rows', 'duplicate_keys', 'rows_to_remove']),
  unnest([CAST(coalesce(sum(CASE WHEN n > 1 THEN n END), 0) AS VARCHAR), CAST(count(CASE WHEN n > 1 THEN 1 END) AS VARCHAR), CAST(sum(n) - count(*) AS VARCHAR)]) FROM g
 UNION ALL SELECT 'sources', source, CAST(count(*) AS VARCHAR) FROM prices GROUP BY 2
 UNION ALL """ + " UNION ALL ".join(_profile("prices", c, "prices", True) for c in ("min_price", "max_price", "modal_price")) + ")")
def _(spark, sf):
    return _values(R.price_report(prices(spark, sf)))


@query("g15_coverage_report", "WITH " + PRICES_SQL + """,
few AS (SELECT DISTINCT district FROM prices),
w AS (SELECT DISTINCT n_name AS district FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey),
dim AS (SELECT n_name FROM nation UNION ALL SELECT 'Nowhere'),
c AS (SELECT n_name, n_name IN (SELECT district FROM few) AS p, n_name IN (SELECT district FROM w) AS h FROM dim),
a AS (SELECT count(CASE WHEN NOT p THEN 1 END) AS np, count(CASE WHEN NOT h THEN 1 END) AS nw FROM c)
SELECT 'coverage' AS section, CASE WHEN p AND h THEN 'full' WHEN h THEN 'weather_only' WHEN p THEN 'prices_only' ELSE 'none' END AS metric,
  CAST(count(*) AS VARCHAR) AS value FROM c GROUP BY 2
UNION ALL SELECT 'recommendation', 'prices', 'Complete coverage - missing ' || np || ' districts' FROM a WHERE np > 0
UNION ALL SELECT 'recommendation', 'weather', 'Complete coverage - missing ' || nw || ' districts' FROM a WHERE nw > 0""")
def _(spark, sf):
    return R.coverage_report(with_absent(spark, sf), prices(spark, sf), weather(spark, sf))


def _metrics(section, cols, source):
    names = ", ".join(f"'{n}'" for n, _ in cols)
    values = ", ".join(f"CAST({e} AS VARCHAR)" for _, e in cols)
    return f"SELECT '{section}' AS section, unnest([{names}]) AS metric, unnest([{values}]) AS value FROM {source}"


_DUPS = [("total_rows", "coalesce(sum(n), 0)"), ("unique_rows", "count(*)"), ("duplicate_rows", "coalesce(sum(CASE WHEN n > 1 THEN n END), 0)"),
         ("duplicate_keys", "count(CASE WHEN n > 1 THEN 1 END)"), ("rows_to_remove", "coalesce(sum(n), 0) - count(*)")]


_PCT = "printf('%.3f', coalesce(CAST(sum(n) - count(*) AS DOUBLE) / sum(n) * 100, 0))"


@query("g15_dedup_report", "WITH g AS (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber), h AS (SELECT 1 AS n FROM g) "
       + _metrics("before", _DUPS + [("dedup_pct", _PCT)], "g") + " UNION ALL " + _metrics("after", _DUPS + [("dedup_pct", _PCT)], "h"))
def _(spark, sf):
    li, key = table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"]
    out = R.dedup_report(li, keep_first(li, key, ["l_shipdate"]), key)
    share = F.format_string("%.3f", F.col("value").cast("double"))
    return out.withColumn("value", F.when(F.col("metric") == "dedup_pct", share).otherwise(F.col("value")))


@query("g15_weather_report", "WITH " + WEATHER_SQL + ", g AS (SELECT count(*) AS n FROM weather GROUP BY date, district) "
       + _metrics("summary", [("total_rows", "count(*)"), ("date_min", "min(date)"), ("date_max", "max(date)"),
                              ("unique_dates", "count(DISTINCT date)"), ("unique_district", "count(DISTINCT district)")], "weather")
       + " UNION ALL " + _metrics("summary", _DUPS[2:], "g")
       + "".join(" UNION ALL " + _profile("measures", c, "weather") for c in ("precipitation", "t2m_max", "t2m_min", "t2m_mean", "rh2m", "ws2m", "srad")))
def _(spark, sf):
    return _values(R.weather_report(weather(spark, sf)))


@query("g15_imputation_report", "WITH " + JOINED_SQL + ", " + """i AS (SELECT count(*) AS n, sum(has_weather) AS w, count(t2m_max) AS t FROM joined) """
       + _metrics("imputation", [("total_rows", "n"), ("rows_with_weather_before", "w"), ("rows_missing_before", "n - w"), ("rows_with_weather_after", "n"),
                                 ("missing_values_before", "n - t"), ("missing_values_after", "0"), ("imputation_coverage", "'100.0'")], "i"))
def _(spark, sf):
    joined = J.join_daily(prices(spark, sf), weather(spark, sf)).select("district", "arrival_date", *ORDER, "has_weather", "t2m_max")
    return R.imputation_report(impute(stored(joined, "joined"), ["t2m_max"], order=ORDER), ["t2m_max"])


@query("g15_violations_report", "WITH " + FAULTY_SQL + " SELECT 'violations' AS section, rule AS metric, CAST(broken AS VARCHAR) AS value FROM ("
       + " UNION ALL ".join(_rule(n, b) for n, b in PRICE_RULES_SQL) + ") WHERE broken > 0")
def _(spark, sf):
    return R.violations_report(faulty(spark, sf), Q.price_contract(scope="Home"))


@query("v07_completeness", "WITH " + PRICES_SQL + """,
dim AS (SELECT n_name FROM nation UNION ALL SELECT 'Nowhere')
SELECT 'current' AS "table", n_name AS missing FROM dim WHERE n_name NOT IN (SELECT district FROM prices WHERE source = 'current')
UNION ALL SELECT 'history', n_name FROM dim WHERE n_name NOT IN (SELECT district FROM prices WHERE source = 'history')""")
def _(spark, sf):
    p = prices(spark, sf)
    return R.completeness({n: p.filter(F.col("source") == n) for n in ("current", "history")}, with_absent(spark, sf))
