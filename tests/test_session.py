"""Tables that are written once leave no shuffle files behind, and go when nothing reads them again."""

import os
import time

from pyspark.sql import functions as F

from harvestline import session
from harvestline.sources import paths
from workload import base, learning


def shuffle_files(spark):
    found = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {found.apply(i).getName() for i in range(found.size()) if found.apply(i).getName().startswith("shuffle_")}


def test_written_tables_leave_no_shuffle_files(spark):
    df = spark.range(5000).select((F.col("id") % 700).alias("g"), F.col("id").cast("string").alias("t")).repartition(5, "g")
    setting, before = spark.conf.get(session.CLEANUP, None), shuffle_files(spark)
    out = session.written(df, "probe")
    end = time.time() + 10
    while shuffle_files(spark) - before and time.time() < end:
        time.sleep(0.1)
    assert not shuffle_files(spark) - before
    assert spark.conf.get(session.CLEANUP, None) == setting
    assert sorted(out.collect()) == sorted(df.collect())
    files = out.inputFiles()
    assert files and all(".zstd." in f for f in files)
    session.discard(out)
    assert not paths.exists(spark, os.path.dirname(files[0]))
    kept = spark.createDataFrame([(1,)], "x int")
    session.discard(kept)  # not a table of ours
    assert kept.count() == 1


def test_features_are_not_written_as_a_wide_table(spark, tmp_path, monkeypatch):
    """The rows that the features come from are written, not the ninety columns."""
    day = lambda n: F.date_add(F.lit("1995-01-01").cast("date"), n).cast("timestamp")
    n = spark.range(120)
    tables = {
        "lineitem": n.select((F.col("id") % 60).alias("l_orderkey"), (F.col("id") % 2).alias("l_partkey"), F.lit(1).cast("long").alias("l_suppkey"),
                             F.col("id").cast("int").alias("l_linenumber"), (F.col("id") % 13 + 1).cast("double").alias("l_extendedprice"), F.lit(0.1).alias("l_discount"),
                             F.lit("N").alias("l_returnflag"), F.lit("O").alias("l_linestatus"), day(F.col("id").cast("int")).alias("l_shipdate")),
        "supplier": spark.createDataFrame([(1, 3)], "s_suppkey long, s_nationkey int"),
        "part": spark.createDataFrame([(0, "A", "x", 1), (1, "B", "y", 2)], "p_partkey long, p_type string, p_brand string, p_size int"),
        "nation": spark.createDataFrame([(3, "N3")], "n_nationkey int, n_name string"),
        "customer": spark.createDataFrame([(5, 3)], "c_custkey long, c_nationkey int"),
        "orders": spark.range(60).select(F.col("id").alias("o_orderkey"), F.lit(5).cast("long").alias("o_custkey"), (F.col("id") + 100).cast("double").alias("o_totalprice"),
                                         day(F.col("id").cast("int")).alias("o_orderdate")),
    }
    for name, df in tables.items():
        df.write.parquet(str(tmp_path / f"{name}.parquet"))
    widths = {}

    def noted(df, label):
        widths[label] = len(df.columns)
        return base.stored(df, label)

    monkeypatch.setattr(learning, "stored", noted)
    rows = learning.training_table(spark, str(tmp_path))
    assert rows.count() == 120 and len(rows.columns) > 80
    assert widths and max(widths.values()) < 40


def test_a_table_goes_by_what_was_made_of_it(spark):
    """Scored rows lead to the vectors that they were made of."""
    out = session.written(spark.range(10).toDF("x"), "probe")
    folder = os.path.dirname(out.inputFiles()[0])
    session.discard(out.filter("x < 3").unionByName(out.filter("x > 7")))
    assert not paths.exists(spark, folder)
