import datetime as dt

import pytest

from harvestline import vocab
from harvestline.operators import quality as Q, shape as S


def test_rename_merges_synonyms_in_alias_order(spark, rows):
    df = spark.createDataFrame([("a", None, 1), ("b", "c", 2)], "`Mandi` string, `Market Name` string, `Odd Col` int")
    out = S.rename_by_alias(df, vocab.PRICE_ALIASES)
    assert out.columns == ["market", "odd_col"]
    assert rows(out) == [("a", 1), ("c", 2)]


def test_conform_casts_and_adds(spark):
    df = spark.createDataFrame([("12x", 1)], "modal_price string, extra int")
    out = S.conform(df, {"state": "string", "modal_price": "double"})
    assert out.dtypes == [("state", "string"), ("modal_price", "double")]
    assert tuple(out.first()) == (None, None)


def test_scope(spark, rows):
    df = spark.createDataFrame([(" maharashtra ",), ("MAHARASHTRA",), ("Goa",), ("Goa",), (None,)], "state string")
    assert S.keep_scope(df, "state", "Maharashtra").count() == 2
    assert rows(S.scope_violations(df, "state", "Maharashtra")) == [("Goa", 2), (None, 1)]
    with pytest.raises(ValueError, match="Goa"):
        S.enforce_scope(df, "state", "Maharashtra")
    assert S.enforce_scope(df, "state", "Maharashtra", strict=False).count() == 2


def test_time_split_keeps_the_remainder(spark):
    df = spark.createDataFrame([(dt.date(2025, 9, 30),), (dt.date(2025, 10, 1),), (dt.date(2025, 12, 31),), (None,)], "d date")
    assert [r["part"] for r in S.time_split(df, "d", "2025-10-01", "2025-12-31").collect()] == ["train", "validation", "test", None]


def test_null_filters(spark):
    df = spark.createDataFrame([(1, 1, 1), (None, 1, 1), (None, None, 1)], "a int, b int, c int")
    assert S.max_null_fraction(df, ["a", "b", "c"], 0.34).count() == 2
    assert S.drop_incomplete(df, ["b", "c"]).count() == 2
    with pytest.raises(ValueError):
        S.require(df, ["z"])


def test_year_bound_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame([(dt.date(2015, 1, 1), 1), (dt.date(2017, 1, 1), 2)], "d date, x int").write.parquet(path)
    out = S.from_year(spark.read.parquet(path), "d", 2016)
    assert out.count() == 1
    assert "GreaterThanOrEqual(d,2016-01-01)" in out._jdf.queryExecution().executedPlan().toString()


PRICE = "state string, district string, market string, commodity string, arrival_date date, min_price double, max_price double, modal_price double, source string"


@pytest.mark.parametrize("change, broken", [
    ({}, []), ({"district": ""}, ["district_filled"]), ({"state": "Goa"}, ["state_scope"]), ({"source": "web"}, ["source_allowed"]),
    ({"source": None}, []), ({"min_price": -1.0}, ["min_price_range"]), ({"min_price": 500.0}, ["min_not_above_max", "modal_inside"]),
    ({"modal_price": 999.0}, ["modal_inside"]), ({"modal_price": None}, []), ({"arrival_date": None}, ["arrival_date_present"])])
def test_price_contract(spark, change, broken):
    row = {"state": "Home", "district": "D", "market": "M", "commodity": "C", "arrival_date": dt.date(2024, 1, 1),
           "min_price": 10.0, "max_price": 20.0, "modal_price": 15.0, "source": "current", **change}
    df = spark.createDataFrame([tuple(row.values())], PRICE)
    assert Q.with_violations(df, Q.price_contract(scope="Home")).first()["violations"] == broken


@pytest.mark.parametrize("col, value, ok", [
    ("latitude", 15.5, True), ("latitude", 10.0, False), ("rh2m", 100.0, True), ("rh2m", 100.1, False), ("t2m_max", 56.0, False),
    ("precipitation", -0.1, False), ("srad", None, True)])
def test_weather_contract(spark, col, value, ok):
    df = spark.createDataFrame([(dt.date(2024, 1, 1), "D", value)], f"date date, district string, {col} double")
    valid, bad = Q.split_valid(df, Q.weather_contract(df.columns))
    assert (valid.count(), bad.count()) == ((1, 0) if ok else (0, 1))


def test_lenient_weather_ranges(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 1), "D", 60.0, -45.0)], "date date, district string, latitude double, t2m_min double")
    assert Q.split_valid(df, Q.weather_contract(df.columns, lenient=True))[0].count() == 1


@pytest.mark.parametrize("modal, code", [(15.0, 0), (21.0, 0), (30.0, 1), (None, 2), (2e6, 2)])
def test_file_report(spark, modal, code):
    df = spark.createDataFrame([("f", "S", "D", "M", "C", dt.date(2024, 1, 1), 10.0, 20.0, modal)],
                               "file string, state string, district string, market string, commodity string, arrival_date date, "
                               "min_price double, max_price double, modal_price double")
    assert Q.file_report(df, "prices").first()["code"] == code


def test_repair(spark):
    df = spark.createDataFrame([(-1.0, 5.0, 9.0), (8.0, 2.0, 5.0), (2.0, 8.0, 9.0), (None, 8.0, 9.0)],
                               "min_price double, max_price double, modal_price double")
    fixed = Q.repair_prices(df)
    assert [tuple(r)[:3] for r in fixed.collect()] == [(None, 5.0, 9.0), (2.0, 8.0, 5.0), (2.0, 8.0, 8.0), (None, 8.0, 9.0)]
    assert tuple(Q.price_violation_counts(fixed).first()) == (1, 1, 1, 3)


def test_raw_prices_end_to_end(spark):
    raw = spark.createDataFrame(
        [(" MAHARASHTRA", "pune", "pune apmc", "ONION", None, "15/01/2024", "1200"),
         ("Maharashtra", "nashik", "nashik", "onion", "nan", "16/01/2024", "-5"),
         ("Goa", "panaji", "panaji", "onion", "red", "17/01/2024", "7"),
         ("Maharashtra", "pune", "pune", "onion", "red", "never", "7")],
        "State string, `District Name` string, Market string, Commodity string, Variety string, `Price Date` string, `Modal Price` string")
    valid, rejects = Q.normalize_raw_prices(raw, "Maharashtra")
    got = {r["district"]: (r["variety"], r["arrival_date"], r["modal_price"], r["market"]) for r in valid.collect()}
    assert got == {"Pune": (None, dt.date(2024, 1, 15), 1200.0, "Pune Apmc"), "Nashik": (None, dt.date(2024, 1, 16), None, "Nashik")}
    assert sorted(r["violations"] for r in rejects.collect()) == [["arrival_date_present"], ["state_scope"]]
    with pytest.raises(ValueError):
        Q.normalize_raw_prices(raw, "Maharashtra", strict=True)
    with pytest.raises(ValueError, match="arrival_date"):
        Q.normalize_raw_prices(raw.drop("Price Date"), "Maharashtra")


def test_a_listed_file_without_rows_is_invalid(spark):
    schema = "file string, state string, district string, market string, commodity string, arrival_date date, min_price double, max_price double, modal_price double"
    df = spark.createDataFrame([("f", "S", "D", "M", "C", dt.date(2024, 1, 1), 10.0, 20.0, 15.0)], schema)
    files = spark.createDataFrame([("f",), ("empty",)], "file string")
    got = {r["file"]: (r["rows"], r["code"], r["status"]) for r in Q.file_report(df, "prices", files=files).collect()}
    assert got == {"f": (1, 0, "valid"), "empty": (0, 2, "invalid")}
    assert [r["code"] for r in Q.file_report(df.limit(0), "prices", files=files.limit(1)).collect()] == [2]


def test_raw_prices_are_cleaned_once(spark):
    """No rule and no filter holds the expressions that clean a column: they are computed in one place."""
    df = spark.createDataFrame([("home", " east side ", "m1", "rice", "1/2/2024", "5"), ("home", " ", "m2", "rice", "2/2/2024", "5")],
                               "State string, District string, Market string, Commodity string, Arrival_Date string, Modal_Price string")
    valid, rejects = Q.normalize_raw_prices(df, "Home")
    assert [r["district"] for r in valid.collect()] == ["East Side"] and rejects.count() == 1
    plan = valid._jdf.queryExecution().optimizedPlan().toString()
    assert not [line for line in plan.split("\n") if "Filter" in line and "initcap" in line]
