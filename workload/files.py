"""Sources and sinks: tables are written to the shared working folder and read back through the readers."""

from pyspark.sql import functions as F

from harvestline.session import work_dir
from harvestline.sources import archives, feeds, paths, runlog, sinks, tables
from workload.base import PRICES_SQL, WEATHER_SQL, prices, query, r, rounded, table, weather
from harvestline import vocab


def by_flag(df):
    return df.groupBy("l_returnflag").agg(F.count("*").alias("rows"), r(F.sum(F.col("l_quantity").cast("double")), 2).alias("quantity"))


FLAG_SQL = "SELECT l_returnflag, count(*) AS rows, round(sum(l_quantity), 2) AS quantity FROM lineitem GROUP BY 1"


@query("s01_parquet_scan", """
SELECT source, l_returnflag, count(*) AS rows FROM (SELECT 'history' AS source, l_returnflag FROM lineitem
UNION ALL SELECT 'current', l_returnflag FROM lineitem) GROUP BY 1, 2""")
def _(spark, sf):
    path = f"{sf}/lineitem.parquet"
    both = tables.read_prices(spark, [path], "history").unionByName(tables.read_prices(spark, [path], "current"))
    return both.groupBy("source", "l_returnflag").agg(F.count("*").alias("rows"))


@query("s02_resolve", FLAG_SQL)
def _(spark, sf):
    found = paths.resolve(spark, [f"{sf}/optimised.parquet", f"{sf}/lineitem.parquet", f"{sf}/orders.parquet"])
    return by_flag(spark.read.parquet(found))


@query("s03_csv_with_comments", "SELECT c_custkey, c_name, c_acctbal FROM customer")
def _(spark, sf):
    out = work_dir(spark, "csv")
    c = table(spark, sf, "customer").select("c_custkey", "c_name", "c_acctbal")
    note = c.select(F.concat(F.lit("# note "), "c_name").alias("value"))
    rows = c.select(F.concat_ws(",", *[F.col(x).cast("string") for x in c.columns]).alias("value"))
    # The first file of the folder holds the header in every part, as separate exports do.
    rows.unionByName(note).write.text(out)
    return (spark.read.schema("c_custkey long, c_name string, c_acctbal double").options(comment="#").csv(out))


@query("s04_messy_csv", """
SELECT l_orderkey, l_linenumber, l_suppkey, CASE WHEN l_linenumber = 2 THEN NULL ELSE l_extendedprice END AS price FROM lineitem""")
def _(spark, sf):
    out = work_dir(spark, "messy")
    li = table(spark, sf, "lineitem").select(
        F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string"), F.col("l_suppkey").cast("string"),
        F.when(F.col("l_linenumber") == 2, "n/a").otherwise(F.col("l_extendedprice").cast("string")).alias("price"))
    li.write.option("header", True).option("compression", "gzip").csv(out)
    good, _ = tables.read_messy_csv(spark, out, ["l_orderkey", "l_linenumber", "l_suppkey", "price"])
    return good.select(F.col("l_orderkey").cast("long").alias("l_orderkey"), F.col("l_linenumber").cast("int").alias("l_linenumber"),
                       F.col("l_suppkey").cast("long").alias("l_suppkey"), F.col("price").try_cast("double").alias("price"))


@query("s04_malformed_lines", "SELECT count(*) AS bad FROM lineitem WHERE l_linenumber = 3")
def _(spark, sf):
    out = work_dir(spark, "malformed")
    a = F.concat_ws(",", F.col("l_orderkey").cast("string"), F.col("l_suppkey").cast("string"))
    table(spark, sf, "lineitem").select(
        F.when(F.col("l_linenumber") == 3, F.concat(a, F.lit(",x,y"))).otherwise(a).alias("value")).write.text(out)
    _, bad = tables.read_messy_csv(spark, out, ["a", "b"], header=False)
    return bad.agg(F.count("*").alias("bad"))


@query("s04_mixed_encodings", """
SELECT l_orderkey, l_linenumber, 'Sé ' || l_returnflag || 'ção' AS place, CASE WHEN l_orderkey % 2 = 0 THEN 'UTF-8' ELSE 'ISO-8859-1' END AS encoding
FROM lineitem""")
def _(spark, sf):
    """A folder of exports in two encodings, plain and compressed; each file is read once, in the encoding that its bytes allow."""
    out = work_dir(spark, "mixed")
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", F.concat(F.lit("Sé "), "l_returnflag", F.lit("ção")).alias("place"))
    for k, encoding in enumerate(("UTF-8", "ISO-8859-1")):
        li.filter(F.col("l_orderkey") % 2 == k).write.mode("append").options(
            header=True, encoding=encoding, compression=("none", "gzip")[k]).csv(out)
    good, _, _ = tables.read_mixed_csv(spark, out, li.columns)
    return good.select(F.col("l_orderkey").cast("long").alias("l_orderkey"), F.col("l_linenumber").cast("int").alias("l_linenumber"), "place", "encoding")


def write_zips(df, out, column):
    """One zip archive for each partition, with a CSV member for each value of a column."""
    def write(frames):
        import io
        import uuid
        import zipfile

        from pyarrow import fs

        held = io.BytesIO()
        with zipfile.ZipFile(held, "w", zipfile.ZIP_DEFLATED) as z:
            for k, frame in enumerate(frames):
                for value, part in frame.groupby(column):
                    z.writestr(f"{value}/{k}.csv", part.to_csv(index=False))
        system, folder = fs.FileSystem.from_uri(out)
        system.create_dir(folder)
        with system.open_output_stream(f"{folder}/{uuid.uuid4().hex}.zip") as f:
            f.write(held.getvalue())
        yield from ()

    df.mapInPandas(write, "done int").write.format("noop").mode("overwrite").save()


@query("s05_zip_members", """
SELECT l_returnflag || '/' AS folder, count(*) AS rows, sum(l_orderkey) AS orders, round(sum(l_quantity), 2) AS quantity FROM lineitem GROUP BY 1""")
def _(spark, sf):
    """Archives of many members, as many as the table has splits (five at least)."""
    out = work_dir(spark, "zips")
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_quantity", "l_returnflag")
    li = li.repartition(max(5, li.rdd.getNumPartitions()))
    write_zips(li.withColumn("l_quantity", F.col("l_quantity").cast("double")), out, "l_returnflag")
    good, _ = archives.read_zip_members(spark, f"{out}/*.zip", ["l_orderkey", "l_quantity"])
    return good.groupBy(F.regexp_extract("file", "^[^/]*/", 0).alias("folder")).agg(
        F.count("*").alias("rows"), F.sum(F.col("l_orderkey").cast("long")).alias("orders"), r(F.sum(F.col("l_quantity").cast("double")), 2).alias("quantity"))


@query("s05_read_any", FLAG_SQL)
def _(spark, sf):
    out = work_dir(spark, "any") + ".csv"
    sinks.write_csv(table(spark, sf, "lineitem").select("l_returnflag", "l_quantity"), out)
    return by_flag(tables.read_any(spark, out))


@query("s06_entity_dirs", "WITH " + PRICES_SQL + """
SELECT district, count(*) AS rows, max(modal_price) AS high FROM prices GROUP BY 1""")
def _(spark, sf):
    out = work_dir(spark, "entities")
    p = prices(spark, sf).select(F.lit(None).cast("string").alias("district"), "modal_price", F.col("district").alias("folder"))
    p.write.partitionBy("folder").option("header", True).csv(out)
    rows = tables.read_entity_dirs(spark, out, "district", "district string, modal_price double")
    return rows.groupBy(F.regexp_replace(F.replace("district", F.lit(" "), F.lit("_")), "^folder=", "").alias("district")).agg(
        F.count("*").alias("rows"), F.max("modal_price").alias("high"))


@query("s07_latest_snapshot", """
SELECT CAST(max(CAST(ts AS DATE)) AS VARCHAR) AS day, count(*) AS rows, sum(event_id) AS ids FROM events
WHERE CAST(ts AS DATE) = (SELECT max(CAST(ts AS DATE)) FROM events)""")
def _(spark, sf):
    out = work_dir(spark, "snapshots")
    e = table(spark, sf, "events").select("event_id", F.to_date("ts").alias("partition_date"))
    sinks.write_parquet(e, out, ["partition_date"])
    newest = tables.read_snapshots(spark, out, "event_id long", latest=True)
    return newest.agg(F.max("partition_date").cast("string").alias("day"), F.count("*").alias("rows"), F.sum("event_id").alias("ids"))


@query("s07_all_snapshots", """
SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS day, count(*) AS rows FROM events GROUP BY 1""")
def _(spark, sf):
    out = work_dir(spark, "snapshots")
    e = table(spark, sf, "events").select("event_id", F.to_date("ts").alias("partition_date"))
    sinks.write_parquet(e, out, ["partition_date"])
    every = tables.read_snapshots(spark, out, "event_id long")
    return every.groupBy(F.col("partition_date").cast("string").alias("day")).agg(F.count("*").alias("rows"))


@query("s08_newest_per_entity", """
SELECT c_mktsegment AS entity, count(*) AS rows, sum(c_custkey) AS keys FROM customer GROUP BY 1""")
def _(spark, sf):
    out = work_dir(spark, "newest")
    c = table(spark, sf, "customer").select("c_custkey", F.col("c_mktsegment").alias("entity"))
    # Two generations of files; the second holds every customer, the first only some of them.
    for rows in (c.filter("c_custkey % 2 = 0"), c):
        rows.repartition("entity").write.mode("append").partitionBy("entity").option("header", True).csv(out)
    newest = tables.read_newest_per(spark, out, "c_custkey long", suffix="*.csv")
    return newest.groupBy(F.regexp_replace("entity", "^entity=", "").alias("entity")).agg(
        F.count("*").alias("rows"), F.sum("c_custkey").alias("keys"))


@query("s09a_parse_observations", "WITH " + WEATHER_SQL + """
SELECT district, CAST(date AS VARCHAR) AS date, round(t2m_max, 4) AS "T2M_MAX", round(t2m_min, 4) AS "T2M_MIN",
  CASE WHEN rh2m IS NULL THEN NULL ELSE rh2m END AS "RH2M" FROM weather""")
def _(spark, sf):
    w = weather(spark, sf).withColumn("day", F.date_format("date", "yyyyMMdd"))
    series = lambda c: F.map_from_entries(F.collect_list(F.struct("day", F.coalesce(F.col(c), F.lit(-999.0)))))
    docs = w.groupBy("district", F.year("date").alias("year")).agg(F.to_json(F.struct(F.struct(F.create_map(
        F.lit("T2M_MAX"), series("t2m_max"), F.lit("T2M_MIN"), series("t2m_min"), F.lit("RH2M"), series("rh2m"))
        .alias("parameter")).alias("properties"))).alias("body"))
    out = feeds.parse_observations(docs, "body", ["district"], ["T2M_MAX", "T2M_MIN", "RH2M"])
    return rounded(out)


@query("s09b_parse_forecast", "WITH " + WEATHER_SQL + """
SELECT district, CAST(date AS VARCHAR) AS date, precipitation AS precipitation_sum, round(t2m_max, 4) AS temperature_2m_max FROM weather""")
def _(spark, sf):
    w = weather(spark, sf)
    days = F.array_sort(F.collect_list(F.struct(F.col("date").cast("string").alias("time"), "precipitation", "t2m_max")))
    docs = w.groupBy("district", F.year("date").alias("year")).agg(days.alias("d")).select("district", F.to_json(F.struct(F.struct(
        F.col("d.time").alias("time"), F.col("d.precipitation").alias("precipitation_sum"), F.col("d.t2m_max").alias("temperature_2m_max"))
        .alias("daily"))).alias("body"))
    return rounded(feeds.parse_forecast(docs, "body", ["district"], {"precipitation_sum": "double", "temperature_2m_max": "double"}))


@query("s10_record_pages", "WITH " + PRICES_SQL + """
SELECT state, market, CAST(arrival_date AS VARCHAR) AS arrival_date, CASE WHEN l_linenumber = 2 THEN NULL ELSE modal_price END AS modal_price
FROM (SELECT *, market || ' (Yard)' AS m FROM prices) WHERE l_linenumber <> 1""")
def _(spark, sf):
    p = prices(spark, sf)
    # a page holds the records of up to 40 orders, so pages stay small however many there are
    rec = p.select("market", F.floor(F.col("l_orderkey") / 40).alias("page"), F.struct(
        F.when(F.col("l_linenumber") == 1, "Away").otherwise(F.col("state")).alias("state"), "district",
        F.concat("market", F.lit(" APMC")).alias("market"), "commodity", "variety", "grade",
        F.date_format("arrival_date", "dd/MM/yyyy").alias("arrival_date"),
        F.lit("1").alias("min_price"), F.lit("2").alias("max_price"),
        F.when(F.col("l_linenumber") == 2, "NR").otherwise(F.col("modal_price").cast("string")).alias("modal_price")).alias("rec"))
    pages = rec.groupBy("market", "page").agg(F.to_json(F.struct(F.count("*").alias("total"), F.collect_list("rec").alias("records"))).alias("body"))
    out = feeds.feed_records(feeds.explode_pages(pages, "body"), "Home")
    return rounded(out.select("state", "market", "arrival_date", "modal_price"))


@query("s10_scope_sample", """
SELECT c_mktsegment AS state, count(*) AS rows FROM customer WHERE c_mktsegment <> 'FURNITURE' GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 5""")
def _(spark, sf):
    c = table(spark, sf, "customer").select(F.col("c_mktsegment").alias("state"))
    return feeds.scope_sample(c, F.col("state") == "FURNITURE")


@query("s12_preview", """
SELECT c_mktsegment, count(*) AS rows FROM (SELECT * FROM customer ORDER BY c_custkey LIMIT 1000) GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10""")
def _(spark, sf):
    c = table(spark, sf, "customer").withColumnRenamed("c_mktsegment", "State Name")
    seen = tables.preview(c, vocab.PRICE_ALIASES, "state", F.col("state") == "BUILDING", order=["c_custkey"])
    return seen["states"].withColumnRenamed("state", "c_mktsegment")


@query("k01_parquet_by_year", "WITH " + PRICES_SQL + """
SELECT extract(year FROM arrival_date) AS arrival_year, count(*) AS rows FROM prices GROUP BY 1""")
def _(spark, sf):
    out = work_dir(spark, "by_year")
    sinks.write_parquet(sinks.with_year(prices(spark, sf)), out, ["arrival_year"])
    return spark.read.parquet(out).groupBy("arrival_year").agg(F.count("*").alias("rows"))


@query("k02_csv_lists", "SELECT n_regionkey, string_agg(n_name, '; ' ORDER BY n_name) AS names FROM nation GROUP BY 1")
def _(spark, sf):
    out = work_dir(spark, "lists")
    n = table(spark, sf, "nation").groupBy("n_regionkey").agg(F.array_sort(F.collect_set("n_name")).alias("names"))
    sinks.write_csv(n, out)
    return tables.read_csv(spark, out, "n_regionkey int, names string")


@query("k03_snapshot_once", "SELECT count(*) AS rows, 0 AS written_again, '2024-01-31' AS day FROM events")
def _(spark, sf):
    out = work_dir(spark, "once")
    e = table(spark, sf, "events").select("event_id", "value")
    sinks.write_snapshot(e, out, "2024-01-31")
    again = sinks.write_snapshot(e.limit(1), out, "2024-01-31")
    got = tables.read_snapshots(spark, out, "event_id long, value double", date="2024-01-31")
    return got.agg(F.count("*").alias("rows"), F.lit(int(again)).alias("written_again"), F.max("partition_date").cast("string").alias("day"))


@query("k04_versions", """
SELECT count(*) AS rows, '2,3,4' AS kept FROM customer WHERE c_custkey % 4 < 4""")
def _(spark, sf):
    out = work_dir(spark, "versions")
    c = table(spark, sf, "customer")
    for i in range(1, 5):
        sinks.write_versioned(c.filter(F.col("c_custkey") % 4 < i), out, keep=3)
    kept = ",".join(str(v) for v in sinks.versions(spark, out))
    return sinks.read_version(spark, out).agg(F.count("*").alias("rows"), F.lit(kept).alias("kept"))


@query("k04_merge_partitions", """
WITH li AS (SELECT * EXCLUDE (l_returnflag), CASE WHEN l_orderkey % 7 > 0 THEN l_returnflag END AS flag, CASE WHEN l_linenumber % 2 = 0 THEN 1 ELSE 0 END AS later FROM lineitem)
SELECT flag, count(*) AS rows, round(sum(l_extendedprice), 2) AS total FROM (
  SELECT *, row_number() OVER (PARTITION BY flag, l_orderkey, l_linenumber // 2 ORDER BY later DESC, l_extendedprice DESC) AS rn FROM li)
WHERE rn = 1 GROUP BY 1""")
def _(spark, sf):
    """All lines, merged in two goes; every seventh order has no flag, so a partition is null."""
    out, key = work_dir(spark, "merged"), ["flag", "l_orderkey", "pair"]
    li = table(spark, sf, "lineitem").select(
        "l_orderkey", F.floor(F.col("l_linenumber") / 2).alias("pair"), "l_linenumber", "l_extendedprice",
        F.when(F.col("l_orderkey") % 7 > 0, F.col("l_returnflag")).alias("flag"))
    best = [F.col("l_extendedprice").desc()]
    sinks.merge_partitions(li.filter("l_linenumber % 2 = 1"), out, key, "flag", best)
    sinks.merge_partitions(li.filter("l_linenumber % 2 = 0"), out, key, "flag", best)
    return sinks.read_merged(spark, out, li.schema).groupBy("flag").agg(F.count("*").alias("rows"), r(F.sum("l_extendedprice"), 2).alias("total"))


@query("k05_run_metrics", "WITH " + PRICES_SQL + """
SELECT count(*) AS rows_out, CAST(min(arrival_date) AS VARCHAR) AS date_min, CAST(max(arrival_date) AS VARCHAR) AS date_max,
  count(DISTINCT market) AS unique_market, (SELECT count(*) FROM prices) AS rows_in, (SELECT count(*) FROM prices) - count(*) AS rows_dropped
FROM prices WHERE source = 'current'""")
def _(spark, sf):
    p = prices(spark, sf)
    return rounded(runlog.run_metrics(p, p.filter("source = 'current'"), "arrival_date", ["market"]))


@query("k05_observed", """
SELECT 'rows' AS metric, CAST(count(*) AS VARCHAR) AS value FROM events
UNION ALL SELECT 'day_max', CAST(CAST(max(ts) AS DATE) AS VARCHAR) FROM events""")
def _(spark, sf):
    seen_table, seen = runlog.observed(table(spark, sf, "events"), "events", "ts")
    seen_table.write.parquet(work_dir(spark, "observed"))
    got = runlog.receipt(spark, "events", {"rows": seen.get["rows"], "day_max": seen.get["date_max"][:10]}, "2026-01-01 00:00:00", "2026-01-01 00:01:00")
    return got.select(F.explode("metrics").alias("metric", "value"))


MANIFEST_SQL = """
manifest AS (SELECT event_type AS session, CAST(user_id AS VARCHAR) AS chunk,
  CASE event_id % 5 WHEN 0 THEN 'pending' WHEN 1 THEN 'in_progress' WHEN 2 THEN 'completed' WHEN 3 THEN 'failed' ELSE 'skipped' END AS status,
  event_id % 1000 AS rows, ts AS event_time FROM events)"""


def manifest(spark, sf):
    status = F.element_at(F.array(*map(F.lit, ["pending", "in_progress", "completed", "failed", "skipped"])), (F.col("event_id") % 5 + 1).cast("int"))
    return table(spark, sf, "events").select(F.col("event_type").alias("session"), F.col("user_id").cast("string").alias("chunk"),
                                             status.alias("status"), (F.col("event_id") % 1000).alias("rows"), F.col("ts").alias("event_time"))


@query("k06_manifest_summary", "WITH " + MANIFEST_SQL + """,
s AS (SELECT *, row_number() OVER (PARTITION BY session, chunk ORDER BY event_time DESC, status DESC, rows DESC) AS rn FROM manifest)
SELECT session, count(*) AS total_chunks, count(*) FILTER (status = 'pending') AS pending, count(*) FILTER (status = 'in_progress') AS in_progress,
  count(*) FILTER (status = 'completed') AS completed, count(*) FILTER (status = 'failed') AS failed, count(*) FILTER (status = 'skipped') AS skipped,
  CAST(sum(CASE WHEN status = 'completed' THEN rows ELSE 0 END) AS BIGINT) AS total_rows FROM s WHERE rn = 1 GROUP BY 1""")
def _(spark, sf):
    return runlog.summary(manifest(spark, sf))


@query("k06_pending", "WITH " + MANIFEST_SQL + """
SELECT DISTINCT session, chunk FROM manifest m WHERE NOT EXISTS (SELECT 1 FROM manifest d WHERE d.session = m.session AND d.chunk = m.chunk
  AND d.status IN ('completed', 'skipped'))""")
def _(spark, sf):
    return runlog.pending(manifest(spark, sf))
