import datetime as dt

import pytest
from pyspark.sql import functions as F

from harvestline.operators import dedup
from harvestline.sources import sinks
from harvestline.streaming import feeds as S

SCHEMA = "k string, ts timestamp, v double"


def at(day, hour=0):
    return dt.datetime(2024, 1, day, hour)


@pytest.fixture
def landing(spark, tmp_path):
    def land(rows):
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    land.path = str(tmp_path / "in")
    land.at = lambda name: str(tmp_path / name)
    return land


def open_stream(spark, landing):
    return S.read_stream(spark, landing.path, spark.createDataFrame([], SCHEMA).schema, files_per_trigger=1)


@pytest.mark.parametrize("partition", [None, "p"])
def test_upsert_equals_batch_and_resumes(spark, landing, rows, partition):
    def run():
        stream = open_stream(spark, landing).withColumn("p", F.col("k"))
        S.run_available(S.upsert_stream(stream, landing.at("out"), landing.at("mark"), ["k"], [F.col("ts").desc()], partition=partition))
    read = lambda: (sinks.read_merged if partition else sinks.read_version)(spark, landing.at("out"))
    landing([("a", at(1), 1.0), ("b", at(1), 2.0)])
    run()
    assert rows(read(), "k", "v") == [("a", 1.0), ("b", 2.0)]
    run()
    assert rows(read(), "k", "v") == [("a", 1.0), ("b", 2.0)]
    landing([("a", at(2), 5.0), ("c", at(2), 6.0)])
    run()
    batch = dedup.upsert(spark.createDataFrame([("a", 1.0), ("b", 2.0)], "k string, v double"),
                         spark.createDataFrame([("a", 5.0), ("c", 6.0)], "k string, v double"), ["k"])
    assert rows(read(), "k", "v") == rows(batch)


def test_dedup(spark, landing, rows):
    landing([("a", at(1), 1.0), ("a", at(1, 1), 1.0), ("b", at(1), 1.0)])
    landing([("a", at(1, 2), 1.0)])
    S.run_available(S.to_files(S.dedup_stream(open_stream(spark, landing), ["k"], "ts", "2 days"), landing.at("o"), landing.at("m")))
    assert rows(spark.read.parquet(landing.at("o")), "k") == [("a",), ("b",)]


@pytest.mark.parametrize("arrival", [0, 1, 2, 3])
def test_priority_dedup_equals_batch_for_any_arrival(spark, tmp_path, rows, arrival):
    """Files in any order, ties and nulls among them; the last one comes in a run of its own."""
    import random

    schema = "day timestamp, market string, source string, min_price double, max_price double, modal_price double, note string"
    rng = random.Random(arrival)
    pick = lambda *xs: rng.choice(xs)
    data = [(at(1 + k % 3), f"m{k % 4}", pick("history", "current", "other", None), pick(None, 1.0), pick(None, 2.0), pick(None, 1.5, 3.5, 3.5),
             pick(None, "a", "b")) for k in range(150)]
    rng.shuffle(data)
    keys, ranks = ["day", "market"], {"current": 2, "history": 1}
    path, mark, out = (str(tmp_path / n) for n in ("in", "mark", "out"))

    def land(part):
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(path)

    def run():
        stream = S.read_stream(spark, path, spark.createDataFrame([], schema).schema, files_per_trigger=1)
        S.run_available(S.changes_to_files(S.dedup_priority_stream(stream, keys, "day", "10 days", ranks=ranks), out, mark, keys))

    for k in range(2):
        land(data[60 * k:60 * k + 60])
    run()
    land(data[120:])
    run()
    batch = dedup.dedup_priority(spark.createDataFrame(data, schema), keys, ranks=ranks)
    assert rows(S.read_changes(spark, out), *batch.columns) == rows(batch)


def test_priority_dedup_emits_a_key_once_at_the_bound(spark, landing, rows):
    landing([("a", at(1), 1.0), ("a", at(1), 7.0), ("b", at(2), 2.0)])
    landing([("a", at(1), 9.0), ("c", at(5), 3.0)])
    landing([("d", at(20), 4.0), ("a", at(1), 99.0)])
    landing([("e", at(21), 5.0)])
    best = S.best_stream(open_stream(spark, landing), ["k"], "ts", "3 days", [-F.col("v")])
    S.run_available(S.to_files(best, landing.at("o"), landing.at("m")))
    got = rows(spark.read.parquet(landing.at("o")), "k", "v")
    assert ("b", 2.0) in got and ("c", 3.0) in got and ("d", 4.0) not in got
    assert [r for r in got if r[0] == "a"] in ([("a", 9.0)], [("a", 99.0)])


def test_discovery_by_sketches_has_constant_state(spark, landing):
    landing([(f"v{i % 50}", at(1), 1.0) for i in range(2000)] + [("often", at(1), 1.0)] * 500)
    landing([(f"w{i}", at(2), 1.0) for i in range(6000)] + [(None, at(2), 1.0)])
    query = S.changes_to_files(S.discovery_sketches(open_stream(spark, landing), ["k"]), landing.at("d"), landing.at("dm"), ["column"])
    S.run_available(query)
    assert [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]][-1] == 1
    found = S.discovered(S.read_changes(spark, landing.at("d")), 3).first()
    assert (found["column"], found["rows"]) == ("k", 8500) and abs(found["distinct_count"] - 6051) < 0.03 * 6051
    assert tuple(found["top"][0]) == ("often", 500) and len(found["top"]) == 3
    batch = S.discovered(S.discovery_sketches(spark.read.schema(SCHEMA).parquet(landing.path), ["k"])).first()
    assert (batch["rows"], batch["distinct_count"]) == (found["rows"], found["distinct_count"])


def test_discovery_and_latest_keep_state_between_batches(spark, landing, rows):
    landing([("a", at(1), 1.0), ("a", at(3), 3.0)])
    landing([("a", at(2), 2.0), ("b", at(2), 9.0)])
    stream = open_stream(spark, landing)
    S.run_available(S.changes_to_files(S.discover_stream(stream, ["k"]), landing.at("d"), landing.at("dm"), ["column", "value"]))
    assert rows(S.read_changes(spark, landing.at("d"))) == [("k", "a", 3), ("k", "b", 1)]
    S.run_available(S.changes_to_files(S.latest_stream(stream, ["k"], "ts", "v"), landing.at("l"), landing.at("lm"), ["k"]))
    assert rows(S.read_changes(spark, landing.at("l")), "k", "v") == [("a", 3.0), ("b", 9.0)]


def test_trend_emits_closed_days_and_drops_late_rows(spark, landing, rows):
    landing([("a", at(1), 1.0), ("a", at(1, 5), 3.0), ("a", at(4), 8.0)])
    mark, out = landing.at("m"), landing.at("o")
    run = lambda: S.run_available(S.to_files(S.daily_trend_stream(open_stream(spark, landing), ["k"], "ts", "v", "1 hour"), out, mark))
    run()
    landing([("a", at(1, 6), 100.0), ("a", at(6), 1.0)])
    run()
    got = spark.read.parquet(out).select(F.dayofmonth("day").alias("d"), "avg_value", "rows")
    assert rows(got) == [(1, 2.0, 2), (4, 8.0, 1)]


@pytest.mark.parametrize("partition", [None, "p"])
def test_a_bad_batch_keeps_the_last_good_table(spark, landing, rows, partition):
    seen = []
    gate = lambda df: df.agg(F.every(F.col("v") > 0).alias("positive"))
    read = lambda: (sinks.read_merged if partition else sinks.read_version)(spark, landing.at("out"))

    def run():
        stream = open_stream(spark, landing).withColumn("p", F.col("k"))
        S.run_available(S.upsert_stream(stream, landing.at("out"), landing.at("mark"), ["k"], [F.col("ts").desc()], partition=partition,
                                        gate=gate, rejected=lambda number, failed: seen.append((number, failed))))

    landing([("a", at(1), 1.0), ("b", at(1), 2.0)])
    run()
    landing([("a", at(2), -5.0), ("c", at(2), 6.0)])
    run()
    assert rows(read(), "k", "v") == [("a", 1.0), ("b", 2.0)] and seen == [(1, ["positive"])]
    landing([("c", at(3), 7.0)])
    run()
    assert rows(read(), "k", "v") == [("a", 1.0), ("b", 2.0), ("c", 7.0)]
