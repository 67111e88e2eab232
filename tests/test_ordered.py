"""Hot groups give the same results as plain windows."""

import random

import pytest
from pyspark.sql import Window, functions as F

from harvestline.operators import encode, impute as I, ordered, windows as W


@pytest.fixture(scope="module")
def series(spark):
    rng = random.Random(7)
    rows = []
    for i in range(1500):
        hot = rng.random() < 0.6
        commodity, market = ("onion", "m0") if hot else (rng.choice(["onion", "wheat", None]), f"m{rng.randrange(1, 6)}")
        day = 3 if hot and rng.random() < 0.4 else rng.randrange(0, 40)
        rows.append((commodity, market, day, i, None if rng.random() < 0.1 else round(rng.uniform(1, 100), 2)))
    df = spark.createDataFrame(rows, "commodity string, market string, d int, id int, modal_price double")
    return df.withColumn("arrival_date", F.date_add(F.to_date(F.lit("2024-01-01")), F.col("d"))).cache()


@pytest.mark.parametrize("limit", [25, 60, 300])
def test_blocks_equal_plain_windows(series, rows, limit):
    plain = W.features_and_targets(series, ["id"])
    cut = W.features_and_targets(series, ["id"], block_rows=limit)
    rounded = lambda df: df.select("id", *[F.round(c, 6).alias(c) for c in sorted(df.columns) if c.startswith(("price_", "target_"))])
    assert rows(rounded(cut)) == rows(rounded(plain))


def test_the_plan_does_not_depend_on_the_rows(series):
    """The same operators in the same order for a few rows and for many, and no job while the frame is built."""
    import re

    shape = lambda df: re.findall(r"\(\d+\) ([A-Z]\w+)", df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")))
    many = series.sparkSession.range(3_000_000).select(
        F.lit("onion").alias("commodity"), F.lit("m0").alias("market"), (F.col("id") % 40).cast("int").alias("d"),
        F.col("id").cast("int").alias("id"), F.rand(1).alias("modal_price"),
        F.date_add(F.to_date(F.lit("2024-01-01")), (F.col("id") % 40).cast("int")).alias("arrival_date"))
    few = many.filter("id < 3")
    strip = lambda names: [n for n in names if n not in ("Filter", "Range", "Project")]
    assert strip(shape(W.price_features(few, ["id"]))) == strip(shape(W.price_features(many, ["id"])))


def test_positions(series):
    placed = ordered.with_position(series, F.col("arrival_date"), ["id"])
    got = [r["id"] for r in placed.orderBy("position").collect()]
    expected = [r["id"] for r in series.orderBy("arrival_date", "id").collect()]
    assert got == expected
    assert [r["position"] for r in placed.orderBy("position").collect()] == list(range(series.count()))


def test_positions_inside_groups(series, rows):
    placed = ordered.with_position(series, F.col("arrival_date"), ["id"], by=["commodity", "market"])
    w = Window.partitionBy("commodity", "market").orderBy("arrival_date", "id")
    plain = series.withColumn("position", F.row_number().over(w) - 1)
    assert rows(placed, "id", "position") == rows(plain, "id", "position")


def test_result_does_not_depend_on_partitions(series, rows):
    one, many = (W.price_features(series.repartition(n), ["id"], block_rows=50) for n in (1, 13))
    cols = ["id", "price_lag_7d", "price_rolling_max_14d"]
    assert rows(one, *cols) == rows(many, *cols)


def test_impute_equals_a_sequential_fill(series, rows):
    data = series.withColumnRenamed("modal_price", "x").withColumn("district", F.coalesce("commodity", F.lit("none")))
    out = I.impute(data.select("district", "arrival_date", "id", "x"), ["x"], order=["id"], fallback={"x": -1.0})
    frame = data.select("district", "arrival_date", "id", "x").toPandas().sort_values(["district", "arrival_date", "id"])
    filled = frame.groupby("district")["x"].ffill()
    filled = filled.fillna(frame.assign(x=filled).groupby("district")["x"].bfill())
    expected = dict(zip(frame["id"], filled.round(6)))
    assert {r["id"]: round(r["x"], 6) for r in out.collect()} == expected


def test_impute_falls_back_for_an_empty_group(spark):
    df = spark.createDataFrame([("a", 1, None), ("a", 2, None), ("b", 1, 4.0), ("b", 2, 8.0), (None, 1, None)],
                               "district string, day int, x double")
    out = {(r["district"], r["day"]): (r["x"], r["x_imputed"]) for r in I.impute(df, ["x"], day="day").collect()}
    assert out == {("a", 1): (6.0, 1), ("a", 2): (6.0, 1), ("b", 1): (4.0, 0), ("b", 2): (8.0, 0), (None, 1): (6.0, 1)}


def test_folds_match_the_definition(series):
    folds = encode.fold_summary(encode.time_folds(series, "arrival_date", ["id"], 5), "arrival_date")
    sizes = {r["fold"]: r["rows"] for r in folds.collect()}
    n = series.count()
    assert sizes == {0: n - 5 * (n // 6), **{i: n // 6 for i in range(1, 6)}}


def test_whole_rows_are_shuffled_once(series):
    """The price only leaves its partition for the window; the cuts of large groups are made from keys and counts."""
    import re

    plan = W.price_features(series, ["id"])._jdf.queryExecution().executedPlan().toString()
    exchanges = re.findall(r"(?:hash|range)partitioning\([^)]*\)[^\n]*", plan)
    assert sum("_blk" in e for e in exchanges) == 1
    window = plan.index("_blk", plan.index("Exchange"))
    before = plan[window:]
    assert not re.search(r"SortMergeJoin", before[:before.index("BroadcastExchange")])


@pytest.mark.parametrize("back,ahead,size", [(1, 0, 1), (5, 3, 2), (0, 4, 7), (30, 15, 3), (2, 2, 100)])
def test_frames_across_blocks_of_uneven_days(spark, rows, back, ahead, size):
    """Days of one to forty rows, null days and null groups; every frame equals that of a plain window."""
    rng = random.Random(back * 100 + ahead)
    data = [(g, None if d == 0 else d, i) for i, (g, d) in enumerate(
        (g, d) for g in ("a", None, "b") for d in range(12) for _ in range(rng.choice([1, 1, 2, 40])))]
    df = spark.createDataFrame(data, "g string, day int, id int").repartition(5)
    build = lambda w: {"seen": F.collect_list("id").over(w.rowsBetween(-back, ahead))}
    got = ordered.over_rows(df, ["g"], "day", ["id"], build, back, ahead, size)
    plain = df.withColumns(build(Window.partitionBy("g").orderBy("day", "id")))
    assert rows(got, "id", "seen") == rows(plain, "id", "seen")


@pytest.mark.parametrize("block_rows", [1, 7, 100])
def test_a_hot_day_is_filled_in_blocks(series, rows, block_rows):
    """Half of all rows lie on one day of one district; blocks of a few rows give what one window gives."""
    data = series.withColumnRenamed("modal_price", "x").withColumn("district", F.coalesce("commodity", F.lit("none")))
    data = data.select("district", "arrival_date", "id", "x", F.when(F.col("id") % 3 == 0, F.col("x")).alias("y"))
    whole = I.impute(data, ["x", "y"], order=["id"], fallback={"x": -1.0, "y": -2.0})
    cut = I.impute(data, ["x", "y"], order=["id"], fallback={"x": -1.0, "y": -2.0}, block_rows=block_rows)
    assert rows(cut, "id", "x", "y", "x_imputed", "has_weather") == rows(whole, "id", "x", "y", "x_imputed", "has_weather")


def test_rolling_statistics_come_from_shorter_frames_and_equal_whole_frames(spark):
    """No frame of 30 rows is passed over for each row; gaps, short series, equal values and lengths off the chain count right."""
    values = [None, 5.0, 0.1, 0.1, 0.1, 0.1, 0.1, 0.1, 0.1, 0.1, 1e5, None, 7.25] * 4
    rows = [(s, i, v) for s, n in (("a", 52), ("b", 3), ("c", 1)) for i, v in enumerate(values[:n])]
    df = spark.createDataFrame(rows, "s string, i int, v double")
    w, ns = Window.partitionBy("s").orderBy("i"), [1, 2, 3, 7, 14, 30, 45]
    frames = {}
    for n in ns:
        frame = w.rowsBetween(-n, -1)
        frames |= {f"x_{n}_mean": F.avg("v").over(frame), f"x_{n}_std": F.stddev_samp("v").over(frame),
                   f"x_{n}_min": F.min("v").over(frame), f"x_{n}_max": F.max("v").over(frame)}
    got = ordered.with_stages(df.withColumns(frames), W.rolling_stages(w, "v", ns))
    assert not [c for c in got.columns if c.startswith("_")]
    for row in got.collect():
        for n in ns:
            for fn in ("mean", "std", "min", "max"):
                want, have = row[f"x_{n}_{fn}"], row[f"price_rolling_{fn}_{n}d"]
                assert have == want if want is None or fn in ("min", "max") else have == pytest.approx(want, rel=1e-12, abs=1e-12), (row["s"], row["i"], n, fn)
    equal = got.filter("s = 'a' and i = 9").first()
    assert equal["price_rolling_std_7d"] == 0.0
    plan = W.price_features(df.withColumnsRenamed({"s": "commodity", "v": "modal_price"}).withColumns(
        {"market": F.lit("m"), "arrival_date": F.date_add(F.lit("2024-01-01").cast("date"), F.col("i"))}), ["i"])
    assert "-30, -1" not in plan._jdf.queryExecution().analyzed().toString()


def test_newest_rows_sort_by_a_number_first(spark):
    """A hash stands before the texts of the key; short series are dropped before the features of the newest row are made."""
    import re

    day = F.date_add(F.lit("2024-01-01").cast("date"), F.col("id").cast("int"))
    one = spark.range(40).select(F.when(F.col("id") < 35, "long").otherwise("short").alias("commodity"), F.lit(None).cast("string").alias("market"),
                                 day.alias("arrival_date"), F.col("id").cast("double").alias("modal_price"))
    newest = W.latest_features(one, ["modal_price"])
    got = newest.collect()
    assert [(r["commodity"], r["modal_price"], r["price_lag_1d"]) for r in got] == [("long", 34.0, 33.0)] and "_s" not in newest.columns
    plan = newest._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("price_lag_1d") < plan.index("(_rows")
    assert re.search(r"Window \[.*\], \[_s#\d+, commodity#\d+", plan)


def test_folds_number_only_the_days_in_which_one_begins(spark, rows):
    """Rows of other days are not shuffled: their fold comes with a small table. Null days, hot days and equal rows count right."""
    rng = random.Random(5)
    days = [None] * 7 + [3] * 40 + [rng.randrange(0, 30) for _ in range(90)]
    data = [(d, i // 3, f"p{i}") for i, d in enumerate(days)]
    for size in (1, 4, 11, len(data)):
        df = spark.createDataFrame(data[:size], "day int, id int, payload string").repartition(3)
        folds = encode.time_folds(df, "day", ["id", "payload"], 5)
        first, each = size - size // 6 * 5, max(1, size // 6)
        place = ordered.with_position(df, F.col("day"), ["id", "payload"])
        fold = F.when(F.col("position") < first, 0).otherwise(F.floor((F.col("position") - first) / each) + 1).cast("int")
        assert rows(folds, "day", "id", "payload", "fold") == rows(place.withColumn("fold", fold), "day", "id", "payload", "fold")
        same = encode.time_folds(df.select("day", F.lit(1).alias("id")), "day", ["id"], 5).groupBy("fold").count()  # all rows of a day alike
        assert rows(same) == rows(folds.groupBy("fold").count())
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = folds._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "SortMergeJoin" not in plan and "_cut" in plan


def test_impute_shuffles_the_rows_once(spark, tmp_path):
    """Both branches, days of one kind and mixed days, read the same shuffle."""
    import re

    spark.range(500).selectExpr("concat('d', id % 3) AS district", "cast(id % 9 AS int) AS day", "id", "if(id % 5 > 0, id / 2, null) AS x").write.parquet(str(tmp_path / "t"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = I.impute(spark.read.parquet(str(tmp_path / "t")), ["x"], day="day", order=["id"], fallback={"x": -1.0})
        assert len(out.collect()) == 500
        plan = out._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert re.search(r"ReusedExchange \[district#\d+, day#\d+, id#\d+L, x#\d+\], Exchange hashpartitioning\(district#\d+, day#\d+", plan.split("== Initial Plan ==")[0])


def test_impute_keeps_rows_without_a_group_or_a_day(spark, rows):
    data = [("a", 1, 2.0), ("a", 1, None), ("a", 2, None), ("a", None, None), ("a", None, 7.0), (None, 1, None), (None, None, 5.0), ("b", 3, None)]
    df = spark.createDataFrame(data, "district string, day int, x double")
    out = I.impute(df, ["x"], day="day", order=["x"], fallback={"x": -1.0})
    want = [("a", 1, 2.0, 0), ("a", 1, 7.0, 1), ("a", 2, 2.0, 1), ("a", None, -1.0, 1), ("a", None, 7.0, 0), (None, 1, -1.0, 1), (None, None, 5.0, 0), ("b", 3, -1.0, 1)]
    assert rows(out, "district", "day", "x", "x_imputed") == sorted(want, key=lambda t: tuple((v is None, str(v)) for v in t))
