"""Line deduplication by winnowing over line hashes, with DataFrame operations alone.

Every ``window`` consecutive lines select the one with the least hash (the first of equals) as a fingerprint, so any two
equal runs of at least ``window`` lines select a common one. Fingerprints that occur once are dropped. At the others, the
match is extended both ways over the windows that chose them: the first place of every such window, by (doc_id, text hash,
line), is its source, and the same window at any later place is a repeat. The union of repeated windows are the maximal
runs of lines that stand earlier; they are deleted, in the same document or another, and the first run stays. Windows are told
by 128 bits for each line.

The result: a line goes if and only if it lies in ``window`` consecutive lines that also begin at an earlier place. With
``long_words``, a line of so many words is a fingerprint and a window of its own, so it also goes if it stands alone
between lines that differ.

Scale: aggregations combine before the shuffle, repeated windows meet their source in a join whose sides are stored
tables, so a line that a third of all documents share is split by the skew join, and no group is collected but the line
numbers of one document.

Cases: a null text is empty; a null doc_id sorts first; rows that agree in doc_id and text are the same document and get
the same result; a text of fewer lines than ``window`` stays as it is,
unless it has a long line; ``n_lines`` and ``n_removed`` replace columns of
these names. A text whose lines all go becomes empty.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from harvestline.llm.common import stored, text_of

WINDOW = 2
LONG_WORDS = 50
SPACE = r"[ \t\n\x0B\f\r]+"
OUTPUTS = ("n_lines", "n_removed")


def chosen(hashes: Column, window: int) -> Column:
    """For every window, the index of the line that it selects."""
    last = F.size(hashes) - window
    starts = F.when(last >= 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda s: s + F.array_position(w := F.slice(hashes, s + 1, window), F.array_min(w)).cast("int") - 1)


def long_lines(lines: Column, words: int) -> Column:
    """The numbers of the lines of ``words`` words or more, told by ASCII white space; shorter than those can be is not split."""
    def long(k: Column) -> Column:
        line = F.get(lines, k)
        return F.when(F.length(line) >= 2 * words - 1, F.size(F.filter(F.split(line, SPACE), lambda w: w != "")) >= words).otherwise(False)

    return F.filter(F.sequence(F.lit(0), F.size(lines) - 1), long)


def fingerprints(docs: DataFrame, window: int, long_words: int | None = None) -> DataFrame:
    """One row per selected line: its hash, and the windows that selected it with their hashes."""
    rows = docs.select("id", "text_hash", F.split("body", "\n", -1).alias("l"))
    rows = rows.select("id", "text_hash", F.transform("l", lambda x: F.xxhash64(x)).alias("h"), F.transform("l", lambda x: F.xxhash64(F.lit(7), x)).alias("g"),
                       *([] if long_words is None else [long_lines(F.col("l"), long_words).alias("long")]))
    rows = rows.where((F.size("h") >= window) if long_words is None else (F.size("h") >= window) | (F.size("long") > 0))
    rows = rows.withColumn("at", chosen(F.col("h"), window))

    def with_windows(p: Column) -> Column:
        near = F.sequence(F.greatest(p - window + 1, F.lit(0)), F.least(p, F.size("h") - window))
        own = F.filter(near, lambda s: F.get("at", s) == p)
        return F.struct(F.get("h", p).alias("mark"), F.transform(own, lambda s: F.struct(s.alias("start"), F.concat(F.slice("h", s + 1, window), F.slice("g", s + 1, window)).alias("lines"))).alias("windows"))

    def alone(p: Column) -> Column:
        # another mark than the line has in its windows, which would make every such line look common
        return F.struct(F.xxhash64(F.get("h", p)).alias("mark"), F.array(F.struct(p.alias("start"), F.array(F.get("h", p), F.get("g", p)).alias("lines"))).alias("windows"))

    marks = F.transform(F.array_distinct("at"), with_windows)
    marks = marks if long_words is None else F.concat(marks, F.transform("long", alone))
    return rows.select("id", "text_hash", F.explode(marks).alias("f")).select("id", "text_hash", "f.*")


def repeats(docs: DataFrame, window: int, long_words: int | None = None) -> DataFrame:
    """The first line and the lines of the windows that also begin at an earlier place."""
    marks = stored(fingerprints(docs, window, long_words), "line-marks")
    common = stored(marks.groupBy("mark").count().where("count > 1").select("mark"), "line-common")
    places = marks.join(common, "mark", "left_semi").select("id", "text_hash", F.explode("windows").alias("w")).select("id", "text_hash", "w.*")
    places = stored(places, "line-places")
    first = places.groupBy("lines").agg(F.min(F.struct("id", "text_hash", "start")).alias("source"), F.count("*").alias("n"))
    first = stored(first.where("n > 1").select("lines", "source"), "line-sources")
    return places.join(first, "lines").where(F.struct("id", "text_hash", "start") > F.col("source")).select(
        "id", "text_hash", "start", F.expr("size(lines) div 2").cast("int").alias("n"))


def covered(windows: Column) -> Column:
    """The numbers of the lines in windows given by their first line ``start`` and their ``n`` lines, each once."""
    return F.array_distinct(F.flatten(F.transform(windows, lambda w: F.sequence(w["start"], w["start"] + w["n"] - 1))))


def without(lines: Column, gone: Column) -> Column:
    """The lines whose numbers are not in ``gone``, in time proportional to both."""
    kept = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), gone)
    return F.transform(kept, lambda k: F.get(lines, k))


def dedup_lines(df: DataFrame, text: str = "text", doc_id: str = "doc_id", window: int = WINDOW, long_words: int | None = None) -> DataFrame:
    """The rows with later repeated runs of lines deleted from the text, and ``n_lines`` (before) and ``n_removed``."""
    body = text_of(df, text)
    docs = df.select(F.col(doc_id).alias("id"), F.xxhash64(body).alias("text_hash"), body.alias("body"))
    gone = repeats(docs, window, long_words).groupBy("id", "text_hash").agg(F.collect_set(F.struct("start", "n")).alias("windows"))
    gone = gone.select(F.col("id").alias("__id"), F.col("text_hash").alias("__hash"), covered(F.col("windows")).alias("__gone"))
    own = df.drop(*OUTPUTS).withColumn("__body", body).withColumn("__own", F.xxhash64("__body"))
    out = own.join(gone, own[doc_id].eqNullSafe(F.col("__id")) & (F.col("__own") == F.col("__hash")), "left")
    # a column of its own: an expression would be split again for every line that is taken from it
    out, lines = out.withColumn("__lines", F.split("__body", "\n", -1)), F.col("__lines")
    # rows without a repeat keep their text as it is
    out = out.withColumn("__kept", F.when(F.col("__gone").isNotNull(), without(lines, F.col("__gone"))))
    return out.select(*[F.when(F.col("__gone").isNull(), F.col("__body")).otherwise(F.array_join("__kept", "\n")).alias(text) if c == text
                        else F.col(f"`{c}`") for c in df.columns if c not in OUTPUTS],
                      F.size(lines).cast("long").alias("n_lines"),
                      F.when(F.col("__gone").isNull(), F.lit(0)).otherwise(F.size(lines) - F.size("__kept")).cast("long").alias("n_removed"))
