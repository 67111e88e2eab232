import datetime as dt
import gzip
import json
import os
import zipfile

import pytest
from pyspark.sql import functions as F

from harvestline import vocab
from harvestline.sources import feeds, paths, runlog, sinks, tables


def test_csv_skips_comments_and_blank_lines(spark, tmp_path):
    (tmp_path / "l.csv").write_text("# note\n\nid,name\n1,a\n# more\n\n2,b\n")
    assert [tuple(r) for r in tables.read_csv(spark, str(tmp_path / "l.csv"), "id int, name string").collect()] == [(1, "a"), (2, "b")]


def test_messy_csv_keeps_bad_lines_apart(spark, tmp_path):
    with gzip.open(tmp_path / "a.csv.gz", "wt") as f:
        f.write("a,b\n1,x\n2\n3,y,z\n4,w\n")
    good, bad = tables.read_messy_csv(spark, str(tmp_path / "a.csv.gz"), ["a", "b"])
    assert good.count() == 2 and sorted(r["line"] for r in bad.collect()) == ["2", "3,y,z"]
    assert bad.count() == 2 and good.select("a").distinct().count() == 2


def test_latin1(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes("a,b\n1,Jalgão\n".encode("latin-1"))
    good, _ = tables.read_messy_csv(spark, str(tmp_path / "a.csv"), ["a", "b"], encoding="ISO-8859-1")
    assert good.first()["b"] == "Jalgão"


@pytest.fixture
def mixed_folder(tmp_path):
    """Plain and compressed files, in UTF-8 and Latin-1; one is odd only in its last line."""
    (tmp_path / "m").mkdir()
    put = lambda name, data: (tmp_path / "m" / name).write_bytes(data)
    put("plain utf.csv", "a,b\n1,Jalgão\n2,x,y\n".encode())
    put("latin.csv", "a,b\n3,Jalgão\n4\n".encode("latin-1"))
    put("late.csv", b"a,b\n" + b"5,plain\n" * 3000 + "6,é".encode("latin-1"))
    put("u.csv.gz", gzip.compress("a,b\n7,Ωmega\n".encode()))
    put("l.csv.gz", gzip.compress("a,b\n8,é\n".encode("latin-1")))
    put("empty.csv", b"")
    return str(tmp_path / "m")


def test_every_file_is_read_once_in_its_own_encoding(spark, mixed_folder, rows):
    good, bad, files = tables.read_mixed_csv(spark, mixed_folder, ["a", "b"])
    got = rows(good.filter("a <> '5'"), "a", "b", "encoding")
    assert got == [("1", "Jalgão", "UTF-8"), ("3", "Jalgão", "ISO-8859-1"), ("6", "é", "ISO-8859-1"), ("7", "Ωmega", "UTF-8"), ("8", "é", "ISO-8859-1")]
    assert good.filter("a = '5'").count() == 3000
    assert sorted(r["line"] for r in bad.collect()) == ["2,x,y", "4"]
    told = {os.path.basename(r["file"]).replace("%20", " "): (r["encoding"], r["odd_lines"]) for r in files.collect()}
    assert told == {"plain utf.csv": ("UTF-8", 0), "latin.csv": ("ISO-8859-1", 1), "late.csv": ("ISO-8859-1", 1), "u.csv.gz": ("UTF-8", 0),
                    "l.csv.gz": ("ISO-8859-1", 1)}


def test_no_files_give_no_rows(spark, tmp_path):
    (tmp_path / "e.csv").write_bytes(b"")
    good, bad, files = tables.read_mixed_csv(spark, str(tmp_path / "e.csv"), ["a", "b"])
    assert good.columns == ["a", "b", "file", "encoding"] and (good.count(), bad.count(), files.count()) == (0, 0, 0)


def write_archives(folder):
    folder.mkdir()
    with zipfile.ZipFile(folder / "x.zip", "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("one.csv", 'State,Price\nA,"1,\n200"\nB\n\n')
        z.writestr("deep/two.CSV", "\ufeffPrice,Other,State\n3,x,C\n4,x,D,more\n".encode())
        z.writestr("latin.csv", "State,Price\né,5\n".encode("latin-1"))
        z.writestr("empty.csv", "")
        z.writestr("readme.txt", "no")
    with zipfile.ZipFile(folder / "y.zip", "w") as z:
        z.writestr("big.csv", "State,Price\n" + "Z,9\n" * 20_000)
    with zipfile.ZipFile(folder / "none.zip", "w") as z:
        z.writestr("readme.txt", "no")


ARCHIVE_ROWS = [("A", "1,\n200", "one.csv", "UTF-8"), ("B", None, "one.csv", "UTF-8"), ("C", "3", "deep/two.CSV", "UTF-8"), ("é", "5", "latin.csv", "ISO-8859-1")]


@pytest.mark.parametrize("by_spark", [False, True])
def test_zip_members_are_tasks(spark, tmp_path, rows, monkeypatch, by_spark):
    from harvestline.sources import archives

    write_archives(tmp_path / "z")
    monkeypatch.setattr(archives, "openable", lambda uri: not by_spark)
    good, bad = archives.read_zip_members(spark, f"{tmp_path}/z/*.zip", ["State", "Price"])
    assert rows(good.filter("State <> 'Z'"), "State", "Price", "file", "encoding") == sorted(ARCHIVE_ROWS, key=lambda t: tuple((v is None, str(v)) for v in t))
    assert good.filter("State = 'Z' and Price = '9'").count() == 20_000
    assert [(r["file"], json.loads(r["record"])) for r in bad.collect()] == [("deep/two.CSV", ["4", "x", "D", "more"])]
    if not by_spark:
        assert good.rdd.getNumPartitions() == 5
    assert archives.read_zip_members(spark, f"{tmp_path}/z/none.zip", ["State"])[0].count() == 0


def test_many_small_members_share_tasks(spark, tmp_path):
    """1300 members are far fewer tasks, each opens an archive once, and no row is lost."""
    from harvestline.sources import archives

    for k in range(2):
        with zipfile.ZipFile(tmp_path / f"{k}.zip", "w") as z:
            for m in range(650):
                z.writestr(f"{m}.csv", f"a\n{k * 650 + m}\n")
    good, _ = archives.read_zip_members(spark, f"{tmp_path}/*.zip", ["a"])
    assert 256 <= good.rdd.getNumPartitions() <= 2 * archives.SINGLE_TASKS
    assert sorted(int(r["a"]) for r in good.collect()) == list(range(1300))


def test_members_are_put_together_by_bytes():
    from harvestline.sources.archives import SINGLE_TASKS, TASK_BYTES, tasks

    assert tasks([("x", "a", 5), ("x", "b", 5)]) == [[("x", ["a"])], [("x", ["b"])]]
    large = [("x" if k < 900 else "y", f"m{k}", TASK_BYTES // 4) for k in range(4 * SINGLE_TASKS)]
    got = tasks(large)
    assert [(u, m) for t in got for u, names in t for m in names] == [row[:2] for row in large]
    assert len(got) == SINGLE_TASKS and max(sum(len(names) for _, names in t) for t in got) == 4


def test_a_member_is_inflated_as_a_stream(tmp_path):
    """A member of 60 MB is read with a few MB of memory."""
    import tracemalloc

    from harvestline.sources import archives

    with zipfile.ZipFile(tmp_path / "b.zip", "w", zipfile.ZIP_DEFLATED) as z, z.open("b.csv", "w") as f:
        f.write(b"a,b\n")
        for _ in range(600):
            f.write(b"1234567890,abcdefgh\n" * 5000)
    tracemalloc.start()
    with open(tmp_path / "b.zip", "rb") as f:
        seen = sum(b.num_rows for b in archives.member_batches(f, "b.csv", ["a", "b"]))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert seen == 3_000_000 and peak < 25 << 20


def test_zip_of_csvs(spark, tmp_path, rows):
    with zipfile.ZipFile(tmp_path / "x.zip", "w") as z:
        z.writestr("one.csv", 'State,Price\nA,"1,200"\nB,2\n')
        z.writestr("two.csv", "Price,Other,State\n3,x,C\n")
        z.writestr("readme.txt", "no")
    out = tables.read_any(spark, str(tmp_path / "x.zip"), ["State", "Price"])
    assert rows(out) == [("A", "1,200", "one.csv"), ("B", "2", "one.csv"), ("C", "3", "two.csv")]


def test_format_dispatch(spark, tmp_path):
    df = spark.createDataFrame([(1, "a")], "id int, t string")
    df.write.parquet(str(tmp_path / "p"))
    df.write.json(str(tmp_path / "j.json"))
    (tmp_path / "c.csv").write_text("id,t\n1,a\n")
    for name in ("p", "j.json", "c.csv"):
        assert tables.read_any(spark, str(tmp_path / name)).select("t").first()["t"] == "a"


def test_entity_folders(spark, tmp_path, rows):
    for d, text in (("Mumbai_City", "district,x\n,1\nGiven,2\n"), ("Pune", "district,x\n,3\n")):
        os.makedirs(tmp_path / d)
        (tmp_path / d / "data.csv").write_text(text)
        (tmp_path / d / "receipt_1.csv").write_text("district,x\n,99\n")
    out = tables.read_entity_dirs(spark, str(tmp_path), "district", "district string, x int")
    assert rows(out, "district", "x") == [("Given", 2), ("Mumbai City", 1), ("Pune", 3)]


def test_newest_files(spark, tmp_path, rows):
    for i, (d, n) in enumerate([("A", "1.csv"), ("B", "1.csv"), ("A", "2.csv")]):
        os.makedirs(tmp_path / d, exist_ok=True)
        (tmp_path / d / n).write_text(f"x\n{i}\n")
        os.utime(tmp_path / d / n, (1_700_000_000 + i, 1_700_000_000 + i))
    assert rows(tables.read_newest_per(spark, str(tmp_path), "x int")) == [(1, "B"), (2, "A")]
    assert rows(tables.read_newest_per(spark, str(tmp_path), "x int", n=1, by_entity=False)) == [(2, "A")]
    assert tables.read_newest_per(spark, str(tmp_path), "x int", suffix="*.none").count() == 0


def test_snapshots(spark, tmp_path):
    root = str(tmp_path / "s")
    df = spark.range(3)
    assert sinks.write_snapshot(df, root, "2024-01-01") and sinks.write_snapshot(df.limit(2), root, "2024-01-05")
    assert not sinks.write_snapshot(df.limit(1), root, "2024-01-05")
    read = lambda **k: tables.read_snapshots(spark, root, "id long", **k).count()
    assert (read(), read(latest=True), read(date="2024-01-01"), read(max_age_days=3, today="2024-01-07"), read(max_age_days=1, today="2024-02-01")) == (5, 2, 3, 2, 0)
    assert sinks.write_snapshot(df.limit(1), root, "2024-01-05", force=True) and read(latest=True) == 1 and read() == 4


def test_versions_are_kept_and_complete_ones_read(spark, tmp_path):
    root = str(tmp_path / "v")
    for i in range(1, 6):
        assert sinks.write_versioned(spark.range(i), root, keep=3) == i
    assert sinks.versions(spark, root) == [3, 4, 5]
    os.makedirs(tmp_path / "v" / "version=6")
    assert sinks.read_version(spark, root).count() == 5 and sinks.read_version(spark, root, 3).count() == 3
    with pytest.raises(FileNotFoundError):
        sinks.read_version(spark, str(tmp_path / "none"))


def test_merge_touches_only_its_partitions(spark, tmp_path, rows):
    path = str(tmp_path / "t")
    base = spark.createDataFrame([(1, "a", 2020), (2, "a", 2021)], "k int, v string, y int")
    sinks.merge_partitions(base, path, ["k", "y"], "y")
    before = os.listdir(tmp_path / "t" / "_merge=1" / "y=2020")
    new = spark.createDataFrame([(2, "b", 2021), (3, "b", 2021)], "k int, v string, y int")
    assert sinks.merge_partitions(new, path, ["k", "y"], "y") == 1
    assert sinks.merge_partitions(new, path, ["k", "y"], "y") == 1
    assert sinks.merge_partitions(new.limit(0), path, ["k", "y"], "y") == 0
    assert rows(sinks.read_merged(spark, path)) == [(1, "a", 2020), (2, "b", 2021), (3, "b", 2021)]
    assert os.listdir(tmp_path / "t" / "_merge=1" / "y=2020") == before
    assert not sinks.exists(spark, f"{path}/_merge=1/y=2021") and sinks.exists(spark, f"{path}/_merge=2/y=2021")


def test_merge_keeps_the_null_partition(spark, tmp_path, rows):
    path, schema = str(tmp_path / "t"), "k int, v string, y int"
    sinks.merge_partitions(spark.createDataFrame([(1, "a", None), (2, "a", None), (3, "a", 2020), (4, "a", 2021)], schema), path, ["k"], "y")
    new = spark.createDataFrame([(2, "b", None), (5, "b", 2020)], schema)
    assert sinks.merge_partitions(new, path, ["k"], "y") == 2
    want = [(1, "a", None), (2, "b", None), (3, "a", 2020), (4, "a", 2021), (5, "b", 2020)]
    assert rows(sinks.read_merged(spark, path, schema)) == sorted(want, key=lambda t: tuple((v is None, str(v)) for v in t))


def test_merge_goes_on_from_a_table_without_a_pointer(spark, tmp_path, rows):
    path, schema = str(tmp_path / "t"), "k int, v string, y int"
    spark.createDataFrame([(1, "a", 2020), (2, "a", 2021)], schema).write.partitionBy("y").parquet(path)
    sinks.merge_partitions(spark.createDataFrame([(2, "b", 2021)], schema), path, ["k", "y"], "y")
    assert rows(sinks.read_merged(spark, path, schema)) == [(1, "a", 2020), (2, "b", 2021)]


class Killed(Exception):
    pass


def killed(*_):
    raise Killed


def no_negative(df):
    return df.agg(F.every(F.col("k") >= 0).alias("no_negative_key"), (F.count("*") > 0).alias("has_rows"))


def test_a_crash_before_the_pointer_moves_leaves_the_last_good_table(spark, tmp_path, rows, monkeypatch):
    path, schema = str(tmp_path / "t"), "k int, v string, y int"
    good = spark.createDataFrame([(1, "a", 2020), (2, "a", 2021)], schema)
    new = spark.createDataFrame([(1, "b", 2020), (3, "b", 2022)], schema)
    sinks.merge_partitions(good, path, ["k", "y"], "y")
    assert sinks.publish(good, f"{path}-v", no_negative) == []
    with monkeypatch.context() as m:
        m.setattr(sinks, "replace_text", killed)
        with pytest.raises(Killed):
            sinks.merge_partitions(new, path, ["k", "y"], "y")
        with pytest.raises(Killed):
            sinks.publish(new, f"{path}-v", no_negative)
    assert rows(sinks.read_merged(spark, path)) == rows(good) == rows(sinks.read_version(spark, f"{path}-v"))
    sinks.merge_partitions(new, path, ["k", "y"], "y")
    assert rows(sinks.read_merged(spark, path)) == [(1, "b", 2020), (2, "a", 2021), (3, "b", 2022)]
    assert sinks.publish(new, f"{path}-v", no_negative) == [] and rows(sinks.read_version(spark, f"{path}-v")) == rows(new)


def test_a_failed_gate_publishes_nothing(spark, tmp_path, rows):
    path, schema = str(tmp_path / "t"), "k int, v string, y int"
    good, bad = spark.createDataFrame([(1, "a", 2020)], schema), spark.createDataFrame([(-1, "x", 2020)], schema)
    sinks.write_versioned(good, f"{path}-v")
    assert sinks.publish(bad, f"{path}-v", no_negative) == ["no_negative_key"]
    assert sinks.publish(bad.limit(0), f"{path}-v", no_negative) == ["no_negative_key", "has_rows"]
    assert rows(sinks.read_version(spark, f"{path}-v")) == rows(good) and sinks.versions(spark, f"{path}-v") == [1]
    for k in range(2, 6):
        assert sinks.publish(good, f"{path}-v", no_negative) == []
    assert sinks.versions(spark, f"{path}-v") == [3, 4, 5] and sinks.current_version(spark, f"{path}-v") == 5
    sinks.merge_partitions(good, path, ["k"], "y", gate=no_negative)
    with pytest.raises(sinks.AuditError) as error:
        sinks.merge_partitions(bad, path, ["k"], "y", gate=no_negative)
    assert error.value.failed == ["no_negative_key"] and rows(sinks.read_merged(spark, path)) == rows(good)


def test_work_folders_are_shared_and_removed(spark, tmp_path, monkeypatch):
    from harvestline import session

    out = session.work_dir(spark, "trial")
    spark.range(3).write.parquet(out)
    assert session.remove_work(spark) >= 1
    assert not sinks.exists(spark, out)

    class Cluster:
        class conf:
            get = staticmethod(lambda key, default=None: None)

        class sparkContext:
            master = "spark://host:7077"

    with pytest.raises(ValueError):
        session.work_dir(Cluster(), "trial")


def test_csv_sink_joins_lists(spark, tmp_path):
    sinks.write_csv(spark.createDataFrame([(1, ["a", "b"])], "id int, l array<string>"), str(tmp_path / "c"), sep="|")
    assert spark.read.csv(str(tmp_path / "c"), header=True).first()["l"] == "a|b"


def test_resolve(spark, tmp_path):
    (tmp_path / "b").write_text("x")
    assert paths.resolve(spark, [str(tmp_path / "a"), str(tmp_path / "b")]) == str(tmp_path / "b")
    with pytest.raises(FileNotFoundError):
        paths.resolve(spark, [str(tmp_path / "a")])


def test_observation_documents(spark, rows):
    body = json.dumps({"properties": {"parameter": {"T2M": {"20240101": 24.1, "20240102": -999}, "RH2M": {"20240101": 60}, "OTHER": {"20240101": 1}}}})
    out = feeds.parse_observations(spark.createDataFrame([("Pune", body)], "district string, body string"), "body", ["district"])
    assert out.columns == ["district", "date", *feeds.PARAMETERS]
    assert rows(out, "date", "T2M", "RH2M", "PRECTOTCORR") == [(dt.date(2024, 1, 1), 24.1, 60.0, None), (dt.date(2024, 1, 2), None, None, None)]


def test_forecast_documents(spark, rows):
    body = json.dumps({"daily": {"time": ["2024-01-01", "2024-01-02"], "precipitation_sum": [0.0, None], "weathercode": [3, 61]}})
    out = feeds.parse_forecast(spark.createDataFrame([("Pune", body)], "district string, body string"), "body", ["district"])
    assert rows(out, "date", "precipitation_sum", "weathercode", "temperature_2m_max") == [
        (dt.date(2024, 1, 1), 0.0, 3.0, None), (dt.date(2024, 1, 2), None, 61.0, None)]


def test_record_pages(spark, tmp_path, rows):
    rec = lambda state, market, price: {"state": state, "district": "D", "market": market, "commodity": "C", "variety": "V", "grade": "G",
                                        "arrival_date": "05/01/2024", "min_price": "1", "max_price": "x", "modal_price": price}
    (tmp_path / "p1.json").write_text(json.dumps({"total": 3, "records": [rec("Maharashtra", "Pune(Moshi) APMC", "10"), rec("Goa", "X", "1")]}, indent=1))
    (tmp_path / "p2.json").write_text(json.dumps({"total": 3, "records": [rec(" maharashtra", "Nashik", "NR")]}))
    records = feeds.explode_pages(feeds.read_pages(spark, str(tmp_path)), "value")
    out = feeds.feed_records(records, "Maharashtra")
    assert rows(out, "state", "market", "arrival_date", "max_price", "modal_price") == [
        ("Maharashtra", "Nashik", dt.date(2024, 1, 5), None, None), ("Maharashtra", "Pune (Moshi)", dt.date(2024, 1, 5), None, 10.0)]
    assert rows(feeds.scope_sample(records, F.lower(F.trim("state")) == "maharashtra")) == [("Goa", 1)]


def test_preview(spark):
    df = spark.createDataFrame([("MH", 1), ("MH", 2), ("GA", 3)], "`State Name` string, `Min Price` int")
    seen = tables.preview(df, vocab.PRICE_ALIASES, "state", F.col("state") == "MH")
    assert seen["renamed"] == ["state", "min_price"] and seen["states"].first()["state"] == "MH"
    assert round(seen["scope"].first()["in_scope_pct"], 1) == 66.7


def test_observed_metrics_and_receipt(spark):
    df, seen = runlog.observed(spark.range(5).withColumn("d", F.lit("2024-01-01")), "m", "d", ["id"])
    df.write.format("noop").mode("overwrite").save()
    assert seen.get["rows"] == 5 and seen.get["unique_id"] == 5
    r = runlog.receipt(spark, "prices", seen.get, "2024-01-01 00:00:00", "2024-01-01 00:01:00").first()
    assert (r["duration_seconds"], r["metrics"]["rows"], r["success"]) == (60, "5", True)


def test_manifest(spark, rows):
    m = spark.createDataFrame([("s", "a", "in_progress", 0, 1), ("s", "a", "completed", 7, 2), ("s", "b", "in_progress", 0, 1),
                               ("s", "c", "failed", 0, 1), ("s", "d", "pending", 0, 1), ("s", "e", "skipped", 0, 1)],
                              "session string, chunk string, status string, rows long, event_time int")
    assert rows(runlog.pending(m), "chunk") == [("b",), ("c",), ("d",)]
    r = runlog.summary(m).first()
    assert (r["total_chunks"], r["completed"], r["in_progress"], r["total_rows"]) == (5, 1, 1, 7)
    assert "| rows | 5 |" in runlog.receipt_markdown(spark.createDataFrame([("rows", "5")], "metric string, value string"))


def test_streamed_pages_equal_read_pages(spark, tmp_path, rows):
    os.makedirs(tmp_path / "in")
    for i in range(3):
        (tmp_path / "in" / f"p{i}.json").write_text(json.dumps({"total": 1, "records": [{"state": "S", "market": f"m{i}", "modal_price": str(i)}]}))
    parse = lambda df: feeds.feed_records(feeds.explode_pages(df, "value"), "S").select("market", "modal_price")
    stream = parse(feeds.stream_pages(spark, str(tmp_path / "in")))
    (stream.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "mark"))
     .trigger(availableNow=True).start().awaitTermination())
    assert rows(spark.read.parquet(str(tmp_path / "out"))) == rows(parse(feeds.read_pages(spark, str(tmp_path / "in")))) == [
        ("m0", 0.0), ("m1", 1.0), ("m2", 2.0)]


def test_unusable_pages_are_reported(spark):
    pages = spark.createDataFrame([(1, '{"total":1,"records":[{"state":"Home","market":"m"}]}'), (2, "{broken"), (3, None), (4, '{"total":0}')], "page int, body string")
    assert feeds.explode_pages(pages, "body").count() == 1
    assert {r["page"]: r["reason"] for r in feeds.unusable_pages(pages, "body").collect()} == {2: "malformed", 3: "empty", 4: "without records"}
