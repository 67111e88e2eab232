import datetime as dt

import pytest
from pyspark.sql import functions as F

from harvestline.functions import dates as D, measures as M, text as T


def one(spark, value, fn, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(fn(F.col("x")).alias("y")).first()["y"]


@pytest.mark.parametrize("raw, expected", [
    ("pune district", "pune"), (" Dist. Nashik ", "nashik"), ("Dharashiv (Usmanabad)", "dharashiv (usmanabad)"), (None, None)])
def test_clean_key(spark, raw, expected):
    assert one(spark, raw, T.clean_key) == expected


@pytest.mark.parametrize("raw, expected", [
    ("pune(moshi) market", "Pune(Moshi) Market"), ("o'neil-ROAD 2nd", "O'Neil-Road 2Nd"), (None, None), ("", "")])
def test_title_words(spark, raw, expected):
    assert one(spark, raw, T.title_words) == expected


@pytest.mark.parametrize("raw, expected", [
    ("Pune APMC", "Pune"), ("Pune(Moshi) APMC", "Pune (Moshi)"), ("Pune (Moshi)", "Pune (Moshi)"), ("APMC", "APMC")])
def test_market_name(spark, raw, expected):
    assert one(spark, raw, T.market_name) == expected


@pytest.mark.parametrize("raw, expected", [
    ("Maharashtra / Pune", "Maharashtra_Pune"), ('a:b*c?"<d>|e', "a_b_cd_e"), ("__x__", "x")])
def test_file_safe(spark, raw, expected):
    assert one(spark, raw, T.file_safe) == expected


@pytest.mark.parametrize("raw, expected", [("nan", None), ("NaN", None), (" None ", None), ("", None), (" x ", "x")])
def test_null_if_blank(spark, raw, expected):
    assert one(spark, raw, T.null_if_blank) == expected


def test_redaction_matches_whole_names(spark):
    url = "https://h/p?api-key=abc&filters[state.keyword]=MH&Token=1#f"
    assert one(spark, url, T.redact_url) == "https://h/p?api-key=[REDACTED]&filters[state.keyword]=MH&Token=[REDACTED]#f"
    got = one(spark, {"api-key": "a", "keyword": "b", "PASSWORD": "c"}, T.redact_map, "map<string,string>")
    assert got == {"api-key": "[REDACTED]", "keyword": "b", "PASSWORD": "[REDACTED]"}


@pytest.mark.parametrize("raw", ["15/01/2024", "15/1/2024", "2024-01-15", "15-01-2024", "2024/01/15", "15-Jan-2024",
                                 "15 Jan 2024", "2024-01-15 00:00:00", "15-01-2024 10:11:12"])
def test_parse_date_formats(spark, raw):
    assert one(spark, raw, D.parse_date) == dt.date(2024, 1, 15)


@pytest.mark.parametrize("raw", ["", "soon", "32/01/2024", None])
def test_unparsable_dates_are_null(spark, raw):
    assert one(spark, raw, D.parse_date) is None


def test_consensus_takes_the_first_format_that_fits(spark):
    df = spark.createDataFrame([("05/01/2024",), ("15/01/2024",), ("bad",)], "d string")
    got = [r["d"] for r in D.parse_date_by_consensus(df, "d").collect()]
    assert got == [dt.date(2024, 1, 5), dt.date(2024, 1, 15), None]


def test_date_helpers(spark):
    assert D.default_range(dt.date(2024, 3, 10), 7) == (dt.date(2024, 3, 1), dt.date(2024, 3, 8))
    assert D.date_spine(spark, dt.date(2024, 2, 27), dt.date(2024, 3, 1)).count() == 4
    sunday = dt.date(2024, 1, 7)
    assert one(spark, sunday, D.day_of_week, "date") == 6
    assert one(spark, sunday, lambda c: D.day_of_week(c, "sunday"), "date") == 0
    assert one(spark, 19737.0, D.from_epoch_days, "double") == dt.date(2024, 1, 15)


@pytest.mark.parametrize("month, name, code", [(6, "kharif", 0), (9, "kharif", 0), (10, "rabi", 1), (2, "rabi", 1), (3, "summer", 2)])
def test_season(spark, month, name, code):
    day = dt.date(2024, month, 1)
    assert (one(spark, day, D.season, "date"), one(spark, day, D.season_code, "date")) == (name, code)


def test_numbers(spark):
    assert one(spark, "12x", M.number) is None
    assert one(spark, " 1200 ", M.number) == 1200.0
    assert one(spark, -999.0, M.without_sentinel, "double") is None
    assert one(spark, None, lambda c: M.growing_degree_days(c, c), "double") is None
    assert one(spark, 4.0, lambda c: M.growing_degree_days(c, c), "double") == 0.0
    assert one(spark, 0.0, lambda c: M.spread_pct(c, c, c), "double") is None
    assert one(spark, None, lambda c: M.clamp(c, F.lit(1.0), F.lit(2.0)), "double") is None
    assert abs(one(spark, 25.0, lambda c: M.vapour_pressure_deficit(c, F.lit(50.0)), "double") - 1.5839) < 1e-3


def test_title_words_needs_marks_only_inside_words(spark):
    """Equal to the marked form for every text, and plain texts take the short way."""
    texts = ["NEW DELHI", "o'neil-smith", "a1b", " 12 ", "x.", "(rural) east", "a. b", "ÉCOLE d'été", "ßtraße", "ΑΣ. ΑΣ'α", "tab\tnext", "", None, "e\u0301a b"]
    marked = F.regexp_replace("t", r"(\P{L}+)", "$1\u0001 ")
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", F.replace(F.initcap(marked), F.lit("\u0001 "), F.lit("")).alias("old"), T.title_words(F.col("t")).alias("new"))
    got = df.collect()
    assert [r["new"] for r in got] == [r["old"] for r in got]
    plan = df.select("new")._jdf.queryExecution().executedPlan().toString()
    assert "RLIKE" in plan.upper()
