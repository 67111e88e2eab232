import datetime as dt

import pytest
from pyspark.sql import functions as F

from harvestline.operators import encode as E, joins as J, profile as P
from harvestline.plans import reports as R


@pytest.mark.parametrize("raw, expected", [
    ("Sholapur", "Solapur"), ("Gondiya", "Gondia"), ("Amarawati", "Amravati"), ("Dharashiv (Usmanabad)", "Osmanabad"),
    ("Mumbai", "Mumbai City"), ("Vashim", "Washim"), ("Jalana", "Jalna"), ("Murum", "Osmanabad"), ("Unknown District", None),
    ("  PUNE district ", "Pune"), ("Pune (Rural)", "Pune"), ("Mumbai (Suburban)", "Mumbai Suburban"), ("Dist. Nasik", "Nashik"),
    ("", None), (None, None)])
def test_district_names(spark, raw, expected):
    df = spark.createDataFrame([(raw,)], "district string")
    assert J.normalize_key(df, "district", J.district_alias_table(spark)).first()["district"] == expected


def test_alias_modes(spark):
    df = spark.createDataFrame([("Pune",), ("Atlantis",)], "d string")
    aliases = J.district_alias_table(spark)
    assert aliases.count() == 71
    kept = J.normalize_key(df, "d", aliases, out="c", unmapped="keep")
    assert [r["c"] for r in kept.orderBy("d").collect()] == ["Atlantis", "Pune"]
    with pytest.raises(ValueError, match="Atlantis"):
        J.normalize_key(df, "d", aliases, unmapped="fail")


def test_alias_join_is_broadcast(spark):
    df = spark.range(10).select(F.concat(F.lit("pune"), F.col("id").cast("string")).alias("d"))
    plan = J.normalize_key(df, "d", J.district_alias_table(spark))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("BroadcastHashJoin") == 2 and "SortMergeJoin" not in plan


def test_join_daily_flags_missing_weather(spark, rows):
    p = spark.createDataFrame([(dt.date(2024, 1, 1), "A", 1.0), (dt.date(2024, 1, 2), "A", 2.0), (dt.date(2024, 1, 1), None, 3.0)],
                              "arrival_date date, district string, modal_price double")
    w = spark.createDataFrame([(dt.date(2024, 1, 1), "A", 30.0, 50.0)], "date date, district string, t2m_max double, rh2m double")
    out = J.join_daily(p, w)
    assert out.columns == ["arrival_date", "district", "modal_price", "t2m_max", "humidity", "has_weather"]
    assert rows(out, "modal_price", "t2m_max", "humidity", "has_weather") == [(1.0, 30.0, 50.0, 1), (2.0, None, None, 0), (3.0, None, None, 0)]


def test_coverage_has_a_row_per_member(spark, rows):
    dim = spark.createDataFrame([("A",), ("B",), ("C",), ("D",)], "district string")
    p = spark.createDataFrame([("a", "m", "c", dt.date(2024, 1, 1)), ("B", "m", "c", dt.date(2024, 1, 2))],
                              "district string, market string, commodity string, arrival_date date")
    w = spark.createDataFrame([("A",), ("C",)], "district string")
    assert rows(J.coverage(dim, p, w), "district", "price_rows", "data_status") == [
        ("A", 1, "full"), ("B", 1, "prices_only"), ("C", 0, "weather_only"), ("D", 0, "none")]
    assert rows(J.missing_members(dim, p, "district")) == [("C",), ("D",)]
    report = {(r["section"], r["metric"]): r["value"] for r in R.coverage_report(dim, p, w).collect()}
    assert report[("coverage", "full")] == "1" and "2 districts" in report[("recommendation", "weather")]
    assert rows(R.completeness({"prices": p, "weather": w}, dim)) == [("prices", "C"), ("prices", "D"), ("weather", "B"), ("weather", "D")]


def test_current_value_prefers_live(spark, rows):
    keys = spark.createDataFrame([("a",), ("b",), ("c",)], "k string")
    live = spark.createDataFrame([("a", 1, 10.0), ("a", 2, 11.0)], "k string, d int, v double")
    old = spark.createDataFrame([("a", 9, 99.0), ("b", 1, 5.0), ("b", 1, 6.0)], "k string, d int, v double")
    assert rows(J.current_value(keys, live, old, ["k"], "d", "v")) == [
        ("a", 11.0, 2, "live"), ("b", 6.0, 1, "historical"), ("c", 0.0, None, "none")]


def test_compare_markets(spark):
    p = spark.createDataFrame([("x", 1000.0), ("y", 1200.0)], "market string, market_price double")
    d = spark.createDataFrame([("x", 10.0)], "market string, distance_km double")
    out = {r["market"]: (r["net_price"], r["profit_margin"], r["profitable"]) for r in J.compare_markets(p, d, F.lit(1000.0)).collect()}
    assert out == {"x": (980.0, -20.0, False), "y": (1100.0, 100.0, True)}


@pytest.mark.parametrize("raw, expected", [("Soyabean", "Soybean"), ("SOYA", "Soybean"), ("black soya meal", "Soybean"),
                                           ("pigeon", "Tur"), ("granite", None)])
def test_synonyms(spark, raw, expected):
    aliases = spark.createDataFrame([("soybean", "Soybean", 0), ("soyabean", "Soybean", 1), ("soya", "Soybean", 2),
                                     ("tur", "Tur", 10), ("pigeon pea", "Tur", 11)], "alias string, crop string, rank int")
    df = spark.createDataFrame([(raw,)], "name string")
    assert J.resolve_synonym(df, "name", aliases).first()["crop"] == expected


def test_synonyms_equal_a_scan_of_all_aliases(spark):
    """Short, long and repeated texts against many aliases; the first by rank counts, an equal one before all."""
    import random

    rng = random.Random(2)
    word = lambda n: "".join(rng.choice("abcde") for _ in range(n))
    aliases = [(word(rng.choice([1, 2, 3, 4, 5, 8])) if i > 40 else word(12), f"c{i % 7}", rng.randrange(2000)) for i in range(400)]
    names = [*{word(rng.randrange(1, 10)).upper() for _ in range(300)}, "", None, "zz", "z"]
    df = spark.createDataFrame([(n,) for n in names] * 2, "name string")
    out = J.resolve_synonym(df, "name", spark.createDataFrame(aliases, "alias string, crop string, rank int"))

    def scan(name):
        low = name.lower()
        hits = [(a != low, r, a, c) for a, c, r in aliases if a in low or low in a]
        return min(hits)[3] if hits else None

    got = [(r["name"], r["crop"]) for r in out.collect()]
    assert len(got) == 2 * len(names)
    assert dict(got) == {n: None if n is None else scan(n) for n in names}


def test_many_aliases_are_looked_up_not_scanned(spark):
    aliases = spark.range(100_000).select(F.concat(F.lit("crop"), F.hex(F.xxhash64("id"))).alias("alias"), F.col("id").cast("string").alias("crop"),
                                          F.col("id").cast("int").alias("rank"))
    df = spark.range(50).select(F.concat(F.lit("Old "), F.hex(F.xxhash64(F.col("id") * 1000)), F.lit("s")).alias("name"), "id")
    named = spark.range(50).select(F.concat(F.lit("my CROP"), F.hex(F.xxhash64(F.col("id") * 1000)), F.lit("s")).alias("name"), "id")
    assert J.resolve_synonym(df, "name", aliases).filter("crop is not null").count() == 0
    out = J.resolve_synonym(named, "name", aliases)
    assert out.filter("crop = cast(id * 1000 as string)").count() == 50
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan and "collect_" not in plan


def test_stage_boundaries(spark, rows):
    stages = spark.createDataFrame([("W", "a", 0, 10, True), ("W", "b", 11, 20, False)],
                                   "crop string, stage string, start_day int, end_day int, critical boolean")
    df = spark.createDataFrame([("W", d) for d in (0, 10, 11, 21)] + [("X", 5)], "crop string, days_since_sowing int")
    assert rows(J.stage_of(df, stages), "crop", "days_since_sowing", "stage", "critical") == [
        ("W", 0, "a", True), ("W", 10, "a", True), ("W", 11, "b", False), ("W", 21, "post_harvest", False), ("X", 5, "post_harvest", False)]


def test_codes_of_unseen_values(spark, rows):
    train = spark.createDataFrame([("b",), ("a",), ("Z",), (None,)], "c string")
    codes = E.fit_codes(train, ["c"])
    assert rows(codes) == [("c", "Z", 0), ("c", "a", 1), ("c", "b", 2)]
    df = spark.createDataFrame([("a",), ("new",), (None,)], "c string")
    assert rows(J.apply_codes(df, codes, ["c"])) == [("a", 1), ("new", -1), (None, -1)]


def test_suggestions(spark, rows):
    dim = spark.createDataFrame([("Nagpur",), ("Nashik",), ("Nanded",)], "district string")
    df = spark.createDataFrame([("nagpoor",), ("Xyz",)], "raw string")
    assert rows(J.suggest(df, dim, "raw", "district")) == [("Xyz", None), ("nagpoor", "Nagpur")]


def test_commodity_dimension_lists_ten_and_counts_all(spark):
    df = spark.createDataFrame([("onion", f"v{i:02d}", float(i)) for i in range(15)] + [("onion", None, None)],
                               "commodity string, variety string, commodity_code double")
    r = P.commodity_dimension(df).first()
    assert (r["varieties"], r["variety_count"], r["distinct_varieties"], r["total_records"], r["commodity_code"]) == (
        [f"v{i:02d}" for i in range(10)], 10, 15, 16, 0.0)


def test_class_never_predicted(spark):
    df = spark.createDataFrame([(0, 0), (0, 1), (1, 1), (2, 1)], "y int, yhat int")
    rep = {r["class"]: (r["precision"], r["recall"], r["support"]) for r in P.class_report(df, "y", "yhat").collect()}
    assert rep == {0: (1.0, 0.5, 2), 1: (1 / 3, 1.0, 1), 2: (0.0, 0.0, 1)}
    m = P.classification_metrics(df, "y", "yhat", 2).first()
    assert (m["accuracy"], m["recall_focus"], m["n"]) == (0.5, 0.0, 4)


def test_mape_denominator_is_at_least_one(spark):
    df = spark.createDataFrame([(0.0, 2.0), (10.0, 5.0)], "y double, yhat double")
    assert P.regression_metrics(df, "y", "yhat").first()["mape"] == 125.0
