"""Streaming forms over the event feed; each runs over everything available and is read back from files."""

from pyspark.sql import functions as F

from harvestline.session import work_dir
from harvestline.sources import sinks
from harvestline.streaming import feeds as S
from workload.base import query, r, table


def stream(spark, sf):
    schema = table(spark, sf, "events").schema
    return S.read_stream(spark, f"{sf}/events.parquet*", schema)


@query("t01_upsert_stream", """
SELECT user_id, event_type, event_id, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS rn
FROM events) WHERE rn = 1""")
def _(spark, sf):
    root, mark = work_dir(spark, "upserted"), work_dir(spark, "mark")
    only = lambda b: b.select("user_id", "event_type", "event_id", "value", "ts")
    S.run_available(S.upsert_stream(stream(spark, sf), root, mark, ["user_id", "event_type"],
                                    [F.col("ts").desc(), F.col("event_id").desc()], prepare=only, partition="event_type"))
    return sinks.read_merged(spark, root).drop("ts")


@query("t01_gated_upsert", """
SELECT user_id, event_type, event_id, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS rn
FROM events) WHERE rn = 1""")
def _(spark, sf):
    """The second of two batches brings newer rows without a value for every third event; it fails the gate, and the first stays."""
    landing, root, mark = (work_dir(spark, n) for n in ("landing", "gated", "mark"))
    events = table(spark, sf, "events").select("user_id", "event_type", "event_id", "value", "ts")
    newer = events.filter("event_id % 3 = 0").withColumns({"value": F.lit(None).cast("double"), "ts": F.col("ts") + F.expr("interval 900 days")})
    gate = lambda df: df.agg((F.count("value") == F.count("*")).alias("every_value_known"))
    for batch in (events, newer):
        batch.withColumn("ts", F.col("ts").cast("timestamp")).write.mode("append").parquet(landing)
        feed = S.read_stream(spark, landing, "user_id long, event_type string, event_id long, value double, ts timestamp")
        S.run_available(S.upsert_stream(feed, root, mark, ["user_id", "event_type"], [F.col("ts").desc(), F.col("event_id").desc()],
                                        partition="event_type", gate=gate))
    return sinks.read_merged(spark, root).drop("ts")


@query("t02_priority_dedup_stream", """
SELECT l_suppkey, month, l_orderkey, l_linenumber, l_extendedprice, l_linestatus FROM (
  SELECT *, CAST(date_trunc('month', CAST(l_shipdate AS TIMESTAMP)) AS DATE)::VARCHAR AS month, row_number() OVER (
    PARTITION BY l_suppkey, date_trunc('month', CAST(l_shipdate AS TIMESTAMP)) ORDER BY CASE l_linestatus WHEN 'O' THEN 2 WHEN 'F' THEN 1 ELSE 0 END DESC,
    CASE WHEN l_discount <> 0 THEN 1 ELSE 0 END + CASE WHEN l_tax <> 0 THEN 1 ELSE 0 END DESC, l_extendedprice DESC, l_orderkey, l_linenumber) AS rn
  FROM lineitem) WHERE rn = 1""")
def _(spark, sf):
    """The line of each supplier and month that the batch deduplication would keep, from a stream."""
    out, mark = work_dir(spark, "best"), work_dir(spark, "mark")
    feed = S.read_stream(spark, f"{sf}/lineitem.parquet*", table(spark, sf, "lineitem").schema)
    lines = feed.select("l_suppkey", F.date_trunc("month", F.col("l_shipdate").cast("timestamp")).alias("month"), "l_orderkey", "l_linenumber",
                        "l_extendedprice", "l_linestatus", F.nullif("l_discount", F.lit(0.0)).alias("discount"), F.nullif("l_tax", F.lit(0.0)).alias("tax"))
    best = S.dedup_priority_stream(lines, ["l_suppkey", "month"], "month", "40000 days", "l_linestatus", ["discount", "tax"], "l_extendedprice", {"O": 2, "F": 1})
    S.run_available(S.changes_to_files(best, out, mark, ["l_suppkey", "month"]))
    return S.read_changes(spark, out).select("l_suppkey", F.to_date("month").cast("string").alias("month"), "l_orderkey", "l_linenumber",
                                             "l_extendedprice", "l_linestatus")


@query("t02_dedup_stream", """
SELECT user_id, event_type, day, count(*) AS keys FROM (SELECT DISTINCT user_id, event_type, CAST(CAST(ts AS DATE) AS VARCHAR) AS day FROM events) GROUP BY ALL""")
def _(spark, sf):
    out, mark = work_dir(spark, "deduped"), work_dir(spark, "mark")
    s = stream(spark, sf).select("user_id", "event_type", F.to_date("ts").cast("string").alias("day"), F.col("ts").cast("timestamp").alias("at"))
    S.run_available(S.to_files(S.dedup_stream(s, ["user_id", "event_type", "day"], "at", "40 days"), out, mark))
    return spark.read.parquet(out).groupBy("user_id", "event_type", "day").agg(F.count("*").alias("keys"))


@query("t03_discover_stream", """
SELECT 'event_type' AS "column", event_type AS value, count(*) AS rows FROM events GROUP BY 2
UNION ALL SELECT 'user_id', CAST(user_id AS VARCHAR), count(*) FROM events GROUP BY 2""")
def _(spark, sf):
    out, mark = work_dir(spark, "found"), work_dir(spark, "mark")
    S.run_available(S.changes_to_files(S.discover_stream(stream(spark, sf), ["event_type", "user_id"]), out, mark, ["column", "value"]))
    return S.read_changes(spark, out)


@query("t03_discovery_sketches", """
SELECT event_type AS value, count(*) AS rows, (SELECT count(*) FROM events) AS total, (SELECT count(DISTINCT event_type) FROM events) AS distinct_count
FROM events GROUP BY 1""")
def _(spark, sf):
    """State of one row per column; a column of few values is counted exactly."""
    out, mark = work_dir(spark, "sketched"), work_dir(spark, "mark")
    S.run_available(S.changes_to_files(S.discovery_sketches(stream(spark, sf), ["event_type", "user_id"]), out, mark, ["column"]))
    found = S.discovered(S.read_changes(spark, out), 100).filter("column = 'event_type'")
    return found.select(F.explode("top").alias("t"), F.col("rows").alias("total"), "distinct_count").select("t.value", "t.rows", "total", "distinct_count")


@query("t04_latest_stream", """
SELECT user_id, event_type, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, value DESC) AS rn FROM events) WHERE rn = 1""")
def _(spark, sf):
    out, mark = work_dir(spark, "latest"), work_dir(spark, "mark")
    S.run_available(S.changes_to_files(S.latest_stream(stream(spark, sf), ["user_id", "event_type"], "ts", "value"), out, mark, ["user_id", "event_type"]))
    return S.read_changes(spark, out).select("user_id", "event_type", "value")


@query("t05_daily_trend_stream", """
SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS day, event_type, round(avg(value) + 3e-7, 3) AS avg_value, count(*) AS rows FROM events
WHERE CAST(ts AS DATE) + 1 <= (SELECT max(ts) - INTERVAL 1 HOUR FROM events) GROUP BY 1, 2""")
def _(spark, sf):
    out, mark = work_dir(spark, "trend"), work_dir(spark, "mark")
    s = stream(spark, sf).select("event_type", "value", F.col("ts").cast("timestamp").alias("at"))
    S.run_available(S.to_files(S.daily_trend_stream(s, ["event_type"], "at", "value", "1 hour"), out, mark))
    return spark.read.parquet(out).select(F.to_date("day").cast("string").alias("day"), "event_type",
                                          r(F.col("avg_value") + 3e-7, 3).alias("avg_value"), "rows")
