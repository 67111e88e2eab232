import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from harvestline.operators import decisions as X, risk as Rk, windows as W
from harvestline.plans import outlook as Ol
from harvestline.sources.rules import load_rules

DOC = {
    "risk_classification": {"low_max": 25, "medium_max": 50}, "soil_thresholds": {"ph_min": 5.5, "ph_max": 8.0},
    "crops": {"Wheat": {
        "aliases": ["Wheat (Lokwan)"], "crop_type": "rabi", "total_duration_days": 140, "sowing_window": {"start_month": 10, "end_month": 12},
        "optimal_conditions": {"temp_optimal": 20},
        "stages": [{"name": "germination", "start_day": 0, "end_day": 10, "critical": True},
                   {"name": "heading", "start_day": 71, "end_day": 95, "critical": True}],
        "sensitive_windows": [{"stage": "germination", "risk_factor": "drought_stress", "severity": "high", "threshold_rainfall_7d_min": 10},
                              {"stage": "heading", "risk_factor": "heat_stress", "severity": "medium", "threshold_temp_max": 32},
                              {"stage": "heading", "risk_factor": "waterlogging", "severity": "high", "threshold_rainfall_7d": 0}]}}}


@pytest.fixture(scope="module")
def rules(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("rules") / "rules.json"
    path.write_text(json.dumps(DOC, indent=1))
    return load_rules(spark, str(path))


def test_rule_tables(rules, rows):
    assert rows(rules["aliases"], "alias", "crop") == [("wheat", "Wheat"), ("wheat (lokwan)", "Wheat")]
    assert rules["stages"].count() == 2 and rules["windows"].count() == 3
    assert rules["thresholds"].first()["ph_min"] == 5.5


def case(spark, stage, rain=50.0, tmax=30.0, tmin=10.0, tmean=20.0, rh=60.0):
    return spark.createDataFrame([("Wheat", stage, rain, tmax, tmin, tmean, rh)],
                                 "crop string, stage string, rainfall_7d double, temp_max double, temp_min double, temp_mean double, humidity double")


@pytest.mark.parametrize("stage, change, score, factors", [
    ("germination", {}, 0.0, []),
    ("germination", {"rain": 3.0}, 30.0, ["drought_stress: low rainfall (3mm)"]),
    ("heading", {"rain": 0.0, "tmax": 33.0}, 12.5, ["heat_stress: high temp (33.0°C)"]),
    ("heading", {"rain": 5.0, "tmean": 29.0}, 45.0, ["waterlogging: excess rainfall (5mm)", "Temperature deviation: 9.0°C from optimal"]),
    ("germination", {"tmean": 26.0}, 8.0, []),
    ("post_harvest", {"rain": None, "tmean": None}, 0.0, [])])
def test_rule_score(spark, rules, stage, change, score, factors):
    r = Rk.rule_score(case(spark, stage, **change), rules["windows"], rules["crops"]).first()
    assert (r["rule_score"], r["risk_factors"]) == (score, factors)


@pytest.mark.parametrize("score, critical, level", [(19.9, True, 0), (20.0, True, 1), (20.0, False, 0), (40.0, True, 2), (49.9, False, 1), (50.0, False, 2)])
def test_risk_label(spark, score, critical, level):
    df = spark.createDataFrame([(score, critical)], "s double, c boolean")
    assert df.select(Rk.risk_label(F.col("s"), F.col("c"))).first()[0] == level


@pytest.mark.parametrize("score, guess, soil, level, text", [
    (81.0, 0, 0, "High", "Rule"), (10.0, 2, 0, "Medium", "Hybrid"), (20.0, 2, 0, "High", None), (20.0, 0, 40, "Medium", None),
    (90.0, 0, 40, "High", "Rule"), (20.0, 1, 30, "Medium", None)])
def test_hybrid(spark, score, guess, soil, level, text):
    df = spark.createDataFrame([(score, guess, soil)], "rule_score double, ml_risk int, soil_score int")
    r = Rk.hybrid_decision(df, soil="soil_score").first()
    assert r["risk_level"] == level and (r["override_reason"] or "").startswith(text or "")
    assert (r["override_reason"] is None) == (text is None)


def test_soil(spark):
    df = spark.createDataFrame([(5.0, 100.0, 10.0), (8.5, 300.0, 20.0), (None, None, None)], "ph double, nitrogen_kg_ha double, phosphorus_kg_ha double")
    assert [(r["soil_score"], len(r["soil_factors"])) for r in Rk.soil_score(df).collect()] == [(40, 3), (20, 1), (0, 0)]


def test_recommendations(spark):
    df = spark.createDataFrame([(2, ["drought_stress: x"], 120.0, 39.0, 0.0), (1, [], 0.0, 0.0, 4.0), (0, [], 0.0, 0.0, 0.0)],
                               "l int, f array<string>, r double, t double, h double")
    out = df.select(Rk.recommendations(*[F.col(c) for c in "lfrth"]).alias("x")).collect()
    assert [len(r["x"]) for r in out] == [4, 3, 2]
    assert out[0]["x"][-1] == Rk.ADVICE["irrigate"]


def test_assess(spark, rules):
    asked = spark.createDataFrame(
        [("wheat (LOKWAN)", "Pune", dt.date(2024, 1, 1), dt.date(2024, 1, 5)), ("wheat", "Nowhere", dt.date(2024, 1, 1), dt.date(2024, 12, 1)),
         ("rice", "Pune", dt.date(2024, 1, 1), dt.date(2024, 1, 5)), ("wheat", "Pune", dt.date(2024, 2, 1), dt.date(2024, 1, 5))],
        "crop string, district string, sowing_date date, as_of date")
    forecast = spark.createDataFrame([("Pune", dt.date(2024, 1, d), 1.0, 30.0, 20.0, 25.0) for d in range(1, 17)],
                                     "district string, date date, precipitation double, t2m_max double, t2m_min double, t2m_mean double")
    got = {(r["requested_crop"], r["sowing_date"].month, r["district"]): r for r in Rk.assess(asked, forecast, rules).collect()}
    first = got[("wheat (LOKWAN)", 1, "Pune")]
    assert (first["crop"], first["current_stage"], first["rule_based_score"], first["risk_level"]) == ("Wheat", "germination", 30.0, "Medium")
    assert first["weather_summary"]["rainfall_7d"] == 7.0 and first["weather_summary"]["humidity"] == 65.0
    assert got[("wheat", 1, "Nowhere")]["current_stage"] == "post_harvest" and got[("wheat", 1, "Nowhere")]["stage_progress"] == 1.0
    assert got[("rice", 1, "Pune")]["error"] == "Unknown crop: rice" and got[("rice", 1, "Pune")]["risk_level"] is None
    assert got[("wheat", 2, "Pune")]["error"] == "Sowing date is in the future"


def test_samples_do_not_depend_on_partitions(spark, rules, rows):
    days = spark.sql("SELECT explode(sequence(date'2020-01-01', date'2023-12-31')) AS date")
    w = days.select("date", F.explode(F.array(F.lit("A"), F.lit("B"))).alias("district")).withColumns({
        "t2m_max": 20.0 + F.month("date"), "t2m_min": 10.0 + F.month("date"), "t2m_mean": F.lit(None).cast("double"),
        "rh2m": F.lit(60.0), "precipitation": (F.dayofyear("date") % 5).cast("double")})
    a = Rk.training_samples(W.weather_features(w), rules, 40)
    b = Rk.training_samples(W.weather_features(w.repartition(9)), rules, 40)
    assert a.count() == 2 * 2 * 20 and rows(a) == rows(b)
    inside = a.filter(~F.col("sowing_month").between(10, 12) | ((F.col("stage") == "germination") & (F.col("days_since_sowing") > 10)))
    assert inside.count() == 0


@pytest.fixture
def forecasts(spark):
    return spark.createDataFrame([("c", "m", h, p, 100.0) for h, p in [(1, 101.0), (3, 103.0), (7, 111.0), (14, 104.0), (15, 111.0)]],
                                 "commodity string, market string, horizon int, price double, current_price double")


def test_curve_hits_its_knots(forecasts):
    got = {r["day"]: r for r in X.daily_curve(forecasts, W.SERIES, F.lit(70.0), 30).collect()}
    assert [got[d]["predicted_price"] for d in (1, 2, 3, 5, 7, 14, 15, 30)] == [101, 102, 103, 107, 111, 104, 111, 111]
    assert (got[7]["lower_bound"], got[7]["upper_bound"], got[30]["upper_bound"]) == (41, 181, 321)
    assert (got[1]["confidence"], got[30]["confidence"]) == (93.8, 70.0)


def test_recommendation_prefers_the_earlier_of_equal_horizons(forecasts):
    r = X.recommend(forecasts.withColumns({"lower": F.col("price") - 3, "upper": F.col("price") + 3}), W.SERIES).first()
    assert (r["recommendation"], r["best_sell_day"], r["confidence"]) == ("HOLD", 7, "high")
    assert r["reason"] == "Price expected to rise 11.0% in 7 days (90% CI: 108-114)"
    falling = forecasts.withColumn("price", F.col("price") - 50)
    r = X.recommend(falling, W.SERIES).first()
    assert (r["recommendation"], r["confidence"]) == ("SELL", "unknown") and "fall" in r["reason"]


def test_outlook(forecasts, spark):
    history = spark.createDataFrame([("c", "m", dt.date(2024, 1, 1), 100.0)], "commodity string, market string, arrival_date date, modal_price double")
    calibration = spark.createDataFrame([(5.0, 7.0, 9.0)], "q80 double, q90 double, q95 double")
    r = Ol.outlook(forecasts.drop("current_price"), history, history.limit(0), calibration, 14).first()
    assert (r["price_source"], r["price_trend"], r["forecast_7d"], r["forecast_14d"], r["forecast_15d"]) == ("historical", "up", 111.0, 104.0, 111.0)
    assert (r["expected_change_percent"], r["model_confidence"], len(r["forecasts"])) == (4.0, 86.0, 14)


def test_forecast_measures_under_other_names(spark):
    days = [("d", dt.date(2024, 1, k), 30.0 + k, 20.0, float(k)) for k in range(1, 6)]
    usual = W.forecast_stats(spark.createDataFrame(days, "district string, date date, t2m_max double, t2m_min double, precipitation double")).first()
    other = W.forecast_stats(spark.createDataFrame(days, "district string, date date, tmax double, temp_min double, prcp double")).first()
    assert usual.asDict() == other.asDict() and usual["rainfall_3d"] == 6.0
    late = W.forecast_stats(spark.createDataFrame(days, "district string, date date, tmax double, tmin double, rain double"), start="2024-01-04").first()
    assert late["forecast_days"] == 2 and late["rainfall_3d"] == 9.0


def test_hash_normal_is_normal_and_repeatable(spark):
    draws = spark.range(20_000).select(Rk.hash_normal(5, 12.0, F.col("id")).alias("x"))
    got = draws.agg(F.avg("x").alias("mean"), F.stddev_samp("x").alias("sd"), F.avg((F.abs("x") < 12).cast("int")).alias("within")).first()
    assert abs(got["mean"]) < 0.4 and abs(got["sd"] - 12) < 0.4 and abs(got["within"] - 0.683) < 0.02
    assert draws.filter(F.col("x").isNull() | F.isnan("x")).isEmpty()
    assert draws.limit(5).collect() == draws.limit(5).collect()
