import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from harvestline.operators import profile as P, quantiles as Q

PROBS = [0.0, 0.005, 0.25, 0.5, 0.8, 0.95, 0.995, 1.0]


def shapes():
    rng = random.Random(3)
    return {
        "uniform": [rng.uniform(-5, 5) for _ in range(4000)],
        "one value holds most rows": [7.0] * 3000 + [rng.uniform(0, 100) for _ in range(1000)],
        "far outliers": [rng.gauss(10, 1) for _ in range(3000)] + [1e12, -1e12],
        "two rows": [1.0, 4.0],
        "one row": [3.0],
    }


@pytest.mark.parametrize("name", list(shapes()))
@pytest.mark.parametrize("buckets", [16, 4096])
def test_equal_to_numpy(spark, monkeypatch, name, buckets):
    monkeypatch.setattr(Q, "BUCKETS", buckets)
    values = shapes()[name]
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "x double")
    got = Q.quantiles(df, ["x"], PROBS)["x"]
    assert np.allclose(got, np.quantile(values, PROBS), rtol=1e-12, atol=1e-9)


def test_groups_and_columns(spark):
    rng = random.Random(5)
    rows = [(i % 3 if i % 3 else None, rng.random(), rng.gauss(0, 1) if i % 4 else None) for i in range(900)]
    df = spark.createDataFrame(rows, "g int, a double, b double")
    got = {(r["g"], r["column"]): r["value"] for r in Q.quantile_table(df, ["a", "b"], [0.9], ["g"]).collect()}
    for g in (None, 1, 2):
        for i, c in ((1, "a"), (2, "b")):
            assert np.isclose(got[(g, c)], np.quantile([r[i] for r in rows if r[0] == g and r[i] is not None], 0.9))


def test_empty_and_null_columns(spark):
    df = spark.createDataFrame([(None, 1.0)], "a double, b double")
    assert Q.medians(df, ["a", "b"], 25.0) == {"a": 25.0, "b": 1.0}
    assert Q.medians(df.limit(0), ["a"]) == {"a": None}
    assert Q.trim_quantiles(df.limit(0), "b").count() == 0


def test_trim_is_inclusive(spark):
    df = spark.range(1001).select(F.col("id").cast("double").alias("x"))
    kept = Q.trim_quantiles(df, "x").agg(F.min("x"), F.max("x"), F.count("*")).first()
    assert tuple(kept) == (5.0, 995.0, 991)


def test_any_number_of_groups_and_the_null_group(spark):
    df = spark.range(25_000).select(F.when(F.col("id") % 12_500 > 0, F.col("id") % 12_500).alias("g"), F.col("id").cast("double").alias("y"), F.lit(0.0).alias("yhat"))
    got = P.calibrate(df, "y", "yhat", ["g"])
    assert got.count() == 12_500
    assert got.filter("g is null").first()["q90"] == pytest.approx(11_250)


def test_calibration_uses_population_deviation(spark):
    df = spark.createDataFrame([(1.0, 0.0), (0.0, 3.0), (2.0, 0.0), (None, 1.0)], "y double, yhat double")
    r = P.calibrate(df, "y", "yhat").first()
    assert (r["mean_residual"], r["rows"]) == (2.0, 3)
    assert np.isclose(r["std_residual"], np.std([1, 3, 2])) and np.isclose(r["q90"], 2.8)


def test_one_group_of_half_the_rows_equals_numpy(spark):
    """Far more rows than a sketch holds, ties, and small groups beside it; no group's values meet in one buffer."""
    rng = np.random.default_rng(11)
    hot = np.round(rng.lognormal(3, 2, 60_000), 2)
    small = rng.normal(size=(60, 1000))
    frame = [(None, float(v)) for v in hot] + [(int(g), float(v)) for g, part in enumerate(small) for v in part]
    df = spark.createDataFrame(frame, "g int, x double").repartition(6, "x")
    got = {(r["g"], r["prob"]): r["value"] for r in Q.quantile_table(df, ["x"], PROBS, ["g"]).collect()}
    assert len(got) == 61 * len(PROBS)
    for g, values in ((None, hot), (0, small[0]), (59, small[59])):
        assert np.allclose([got[g, p] for p in PROBS], np.quantile(values, PROBS), rtol=1e-12, atol=1e-12)
    plan = Q.quantile_table(df, ["x"], [0.9], ["g"])._jdf.queryExecution().executedPlan().toString()
    assert "percentile" not in plan and "collect_" not in plan


def test_large_groups_are_not_joined_by_shuffle(spark, monkeypatch):
    """The bounds of a large group go to its rows; small groups and null are joined as before, with equal results."""
    monkeypatch.setattr(Q, "LARGE_ROWS", 5000)
    rng = np.random.default_rng(5)
    groups = {None: rng.lognormal(3, 2, 20_000), 1: rng.normal(size=8000), 2: rng.normal(size=5000), 3: rng.normal(size=7)}
    df = spark.createDataFrame([(g, float(v)) for g, part in groups.items() for v in part], "g int, x double").repartition(4, "x")
    found = Q.quantile_table(df, ["x"], PROBS, ["g"])
    got = {(r["g"], r["prob"]): (r["value"], r["n"]) for r in found.collect()}
    assert len(got) == 4 * len(PROBS)
    for g, values in groups.items():
        assert np.allclose([got[g, p][0] for p in PROBS], np.quantile(values, PROBS), rtol=1e-12, atol=1e-12)
        assert {got[g, p][1] for p in PROBS} == {len(values)}
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        plan = Q.quantile_table(df, ["x"], [0.9], ["g"])._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert plan.count("BroadcastHashJoin") == 2 and plan.count("SortMergeJoin") == 1


def test_a_rank_outside_its_bounds_is_an_error(spark, monkeypatch):
    monkeypatch.setattr(Q, "SKETCH", 8)
    monkeypatch.setattr(Q, "MARGIN", 1e-4)
    df = spark.range(200_000).select(F.lit(1).alias("g"), F.rand(4).alias("x"))
    with pytest.raises(Exception, match="outside the bounds"):
        Q.quantile_table(df, ["x"], [0.3, 0.5, 0.7, 0.9], ["g"]).collect()
