from pyspark.sql import functions as F

from harvestline import vocab
from harvestline.operators import dedup, quality as Q

COLS = ("state string, district string, market string, commodity string, variety string, grade string, arrival_date string, "
        "min_price double, max_price double, modal_price double, source string")


def price(modal, source, lo=1.0, variety="v"):
    return ("S", "D", "M", "C", variety, "G", "2024-01-01", lo, 9.0, modal, source)


def test_priority_is_source_then_completeness_then_price(spark):
    df = spark.createDataFrame([price(5.0, "history"), price(4.0, "current", lo=None), price(3.0, "current"),
                                price(2.0, "current"), price(8.0, "web")], COLS)
    assert [r["modal_price"] for r in dedup.dedup_priority(df).collect()] == [3.0]


def test_null_keys_form_one_group(spark, rows):
    df = spark.createDataFrame([price(1.0, "current", variety=None), price(2.0, "current", variety=None), price(3.0, "current")], COLS)
    assert rows(dedup.dedup_priority(df), "variety", "modal_price") == [("v", 3.0), (None, 2.0)]
    assert dedup.duplicates(df, vocab.PRICE_KEY).count() == 2
    stats = dedup.duplicate_stats(df, vocab.PRICE_KEY).first().asDict()
    assert stats == {"total_rows": 3, "unique_rows": 2, "duplicate_rows": 2, "duplicate_keys": 1, "rows_to_remove": 1,
                     "dedup_pct": 100 / 3}


def test_ties_do_not_depend_on_partitions(spark, rows):
    df = spark.createDataFrame([(1, float(i % 5), str(i)) for i in range(200)], "k int, v double, t string")
    picks = {tuple(dedup.keep_first(df.repartition(n), ["k"], [F.col("v").desc()]).first()) for n in (1, 3, 7)}
    assert len(picks) == 1


def test_hot_key_is_limited_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), "id")
    plan = dedup.keep_first(df, ["k"], ["id"])._jdf.queryExecution().executedPlan().toString()
    assert "row_number(), 1, Partial" in plan


def test_upsert(spark, rows):
    base = spark.createDataFrame([(1, "old"), (2, "old")], "k int, v string")
    new = spark.createDataFrame([(2, "new"), (3, "new")], "k int, v string")
    assert rows(dedup.upsert(base, new, ["k"])) == [(1, "old"), (2, "new"), (3, "new")]
    assert rows(dedup.upsert(base, new, ["k"], prefer="base")) == [(1, "old"), (2, "old"), (3, "new")]
    once = dedup.upsert(base, new, ["k"])
    assert rows(dedup.upsert(once, new, ["k"])) == rows(once)
    twice = new.unionByName(new)
    assert rows(dedup.upsert(base.limit(0), twice, ["k"])) == [(2, "new"), (3, "new")]


def test_newest_file_wins_for_observations(spark, rows):
    df = spark.createDataFrame([("2024-01-01", "D", 30.0, 20.0, 1), ("2024-01-01", "D", 31.0, None, 2),
                                ("2024-01-01", None, 9.0, 9.0, 9)], "date string, district string, t2m_max double, t2m_min double, file_time int")
    assert rows(dedup.dedup_observations(df, newest="file_time"), "t2m_max") == [(31.0,)]
    assert rows(dedup.dedup_observations(df.drop("file_time")), "t2m_max") == [(30.0,)]


def test_output_gate(spark):
    dim = spark.createDataFrame([("D",)], "district string")
    good = spark.createDataFrame([price(1.0, "current")], COLS)
    assert Q.output_gate(good, vocab.PRICE_KEY, dim, "district", "state", "S").first()["passed"]
    bad = good.unionByName(good).withColumn("district", F.lit("X"))
    r = Q.output_gate(bad, vocab.PRICE_KEY, dim, "district", "state", "T").first()
    assert (r["unique_keys"], r["known_members"], r["scope_kept"], r["passed"]) == (False, False, False, False)
