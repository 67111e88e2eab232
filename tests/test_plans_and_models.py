import datetime as dt
import random

import pytest
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import functions as F

from harvestline import vocab
from harvestline.models import crop_risk as C, price as M
from harvestline.operators import joins as J, profile as P, windows as W
from harvestline.plans import datasets as Ds, reports as R

RAW = "State string, District string, Market string, Commodity string, Variety string, Grade string, `Arrival Date` string, `Min Price` string, `Max Price` string, `Modal Price` string"


@pytest.fixture(scope="module")
def inputs(spark):
    rng = random.Random(1)
    rec = lambda d, i, modal, state="Maharashtra": (state, d, f"m{i % 2}", "Onion", "Red" if i % 3 else "nan", "FAQ",
                                                    (dt.date(2016, 1, 1) + dt.timedelta(days=i)).strftime("%d/%m/%Y"), str(modal - 5), str(modal + 5), str(modal))
    history = [rec(rng.choice(["Pune", "nasik", "Atlantis"]), i, 100 + i) for i in range(60)] + [rec("Pune", 1, 1, "Goa"), rec("Pune", -400, 5)]
    current = [rec("Pune District", i, 200 + i) for i in range(50, 70)]
    weather = [("Pune", (dt.date(2016, 1, 1) + dt.timedelta(days=i)).strftime("%Y%m%d"), 30.0 + i % 4, 20.0, -999.0 if i % 5 == 0 else 0.5) for i in range(0, 60, 2)]
    return {"history": spark.createDataFrame(history, RAW), "current": spark.createDataFrame(current, RAW),
            "weather": spark.createDataFrame(weather, "District string, Date string, T2M_MAX double, T2M_MIN double, PRECTOTCORR double")}


@pytest.fixture(scope="module")
def dim(spark):
    return spark.createDataFrame([(d,) for d in vocab.DISTRICTS], "district string")


def test_build(spark, inputs, dim, tmp_path):
    def write(name, df):
        df.write.parquet(str(tmp_path / name))
        return spark.read.schema(df.schema).parquet(str(tmp_path / name))
    out = Ds.build(inputs, J.district_alias_table(spark), dim, "Maharashtra", "2026-01-01 00:00:00", write)
    assert out["prices"].columns == list(vocab.PRICE_COLUMNS) and out["weather"].columns == list(vocab.WEATHER_COLUMNS)
    assert {r["district"] for r in out["prices"].select("district").distinct().collect()} == {"Pune", "Nashik"}
    assert out["prices"].filter("variety = 'nan' or variety = 'Nan'").isEmpty()
    model = out["model"]
    assert model.count() == out["joined"].count() and model.filter("arrival_date < '2016-01-01'").isEmpty()
    assert model.filter("t2m_max is null or t2m_min is null or precipitation is null").isEmpty()
    assert model.filter("wind_speed is not null").isEmpty()
    nashik = model.filter("district = 'Nashik'").select("t2m_min", "weather_imputed").distinct().collect()
    assert [tuple(r) for r in nashik] == [(20.0, 1)]
    report = {r["metric"]: r["value"] for r in R.imputation_report(model, ["t2m_max", "t2m_min"]).collect()}
    assert report["missing_values_after"] == "0"
    qc = {(r["section"], r["metric"]): r["value"] for r in R.price_report(out["prices"]).collect()}
    assert qc[("summary", "duplicate_rows")] == "0" and ("prices", "modal_price_median") in qc


def test_building_twice_gives_the_same_table(spark, inputs, dim, rows):
    run = lambda: Ds.build(inputs, J.district_alias_table(spark), dim, "Maharashtra", "2026-01-01 00:00:00", steps=["prices"])["prices"]
    assert rows(run()) == rows(run())


def test_gate_and_steps(spark, inputs, dim):
    aliases = J.district_alias_table(spark)
    with pytest.raises(ValueError, match="gate"):
        Ds.build(inputs, aliases, dim.filter("district <> 'Pune'"), "Maharashtra", "2026-01-01 00:00:00", steps=["prices"])
    with pytest.raises(ValueError, match="unknown"):
        Ds.build(inputs, aliases, dim, "Maharashtra", "2026-01-01 00:00:00", steps=["x"])
    dry = Ds.build(inputs, aliases, dim, "Maharashtra", "2026-01-01 00:00:00", dry_run=True)
    assert set(dry) == set(Ds.STEPS)


def test_forecast_table(spark):
    raw = spark.createDataFrame([("pune", "2024-01-02", 30.0, 1), ("pune", "2024-01-02", 31.0, 2)], "district string, date string, temperature_2m_max double, file_time int")
    out = Ds.canonical_weather(raw, J.district_alias_table(spark), forecast=True)
    assert out.columns == list(vocab.FORECAST_COLUMNS) and out.first()["temperature_max"] == 31.0
    assert "t2m_mean" in Ds.serving_forecast(out).columns


@pytest.fixture(scope="module")
def training(spark, tmp_path_factory):
    rng = random.Random(2)
    rows = [(f"c{s % 2}", f"m{s}", "D", "v", "g", dt.date(2024, 1, 1) + dt.timedelta(days=i), 100.0 + 10 * s + i * 0.5 + rng.random())
            for s in range(4) for i in range(90)]
    df = spark.createDataFrame(rows, "commodity string, market string, district string, variety string, grade string, arrival_date date, modal_price double")
    table, codes = Ds.training_table(df, ["variety", "grade"], M.FEATURES)
    path = str(tmp_path_factory.mktemp("training"))
    table.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path), codes


def tree(label):
    return GBTRegressor(featuresCol="features", labelCol=label, predictionCol="yhat", maxDepth=2, maxIter=2, seed=1)


def test_price_models(spark, training, tmp_path):
    table, codes = training
    names = M.present(table)
    assert len(M.FEATURES) == 60 and "price_lag_30d" in names and "humidity" not in names
    models, scored = M.train_horizons(table, names, "2024-03-01", "2024-03-25", [1, 15], regressor=tree)
    assert set(models) == {1, 15}
    metrics = {r["horizon"]: r["mae"] for r in P.regression_metrics(scored, "y", "yhat", ["horizon"]).collect()}
    assert metrics[1] < 30
    M.save_models(models, str(tmp_path / "m"))
    last = table.filter(F.col("arrival_date") == "2024-03-20")
    again = M.predict(M.load_models(str(tmp_path / "m"), [1, 15]), last, W.SERIES)
    assert again.count() == 8
    none, empty = M.train_horizons(table, names, "2024-03-01", "2024-03-01", [1], regressor=tree)
    assert none == {} and empty is None
    cv = M.cross_validate(table, names, "target_1d", ["market"], 3, regressor=tree, min_train=5).first()
    assert cv["folds"] == 2


def test_crop_model(spark, tmp_path):
    rng = random.Random(4)
    rows = []
    for i in range(400):
        stats = [round(rng.random() * 10, 3) for _ in vocab.WEATHER_STATS]
        rows.append(("Wheat" if i % 2 else "Gram", "Pune", f"s{i % 3}", dt.date(2024, 1, 1) + dt.timedelta(days=i), i % 2, i, i / 400, 10, 11, *stats,
                     2 if stats[0] > 8 else 1 if stats[0] > 5 else 0))
    schema = ("crop string, district string, stage string, current_date date, is_critical_stage int, days_since_sowing int, stage_progress double, "
              "sowing_month int, current_month int, " + ", ".join(f"{c} double" for c in vocab.WEATHER_STATS) + ", risk_level int")
    samples = spark.createDataFrame(rows, schema)
    forest = RandomForestClassifier(featuresCol="features", labelCol="risk_level", weightCol="class_weight", predictionCol="ml_risk_raw",
                                    probabilityCol="ml_proba", maxDepth=4, numTrees=3, seed=1)
    model, scored = C.train(samples, forest)
    assert scored.count() == 80
    assert P.classification_metrics(scored, "y", "yhat").first()["accuracy"] > 0.6
    model.save(str(tmp_path / "m"))
    gap = samples.limit(3).withColumn("humidity", F.lit(None).cast("double"))
    out = C.RiskModel.load(str(tmp_path / "m")).transform(gap.unionByName(samples.limit(2)))
    assert out.count() == 5 and out.filter("ml_risk is null").isEmpty()
    share = C.importance(spark, model.fitted, [*C.CATEGORIES, *C.NUMBERS])
    assert abs(share.agg(F.sum("share")).first()[0] - 1) < 1e-9
    assert C.cross_validate(samples, forest, 2).count() == 2
