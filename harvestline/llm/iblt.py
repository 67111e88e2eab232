"""Document fingerprints: invertible Bloom lookup sketches of paragraph digests, with DataFrame operations alone.

A text is the set of its distinct paragraphs (what line breaks part). Each paragraph's 64-bit digest goes to four cells of
a sketch, one in each quarter; a cell holds how many digests it got, their exclusive or, and the exclusive or of their check
values. Sketches of two versions are subtracted cell by cell, so common paragraphs cancel; a cell that is left with one
digest gives it away, it is taken out of its other cells, and so on (peeling), until the differing digests of either side
are recovered. Likeness is the share of common paragraphs among all of both texts, from the recovered differences.

The fingerprint is the smallest sketch (``CELLS`` cells), as hexadecimal numbers. Where peeling fails, the pair is tried
again with larger sketches: its digests are dealt to as many sketches of ``CELLS`` cells as the pair's size asks for, and
twice as many in each further trial; only failed pairs take part, and a sketch is a row of its own, so texts of any length
are spread over tasks. A pair that fails in all ``TRIALS`` gets its likeness from the two sets of digests themselves.

Cases: a null text is the empty text, whose one paragraph is empty; equal texts have equal fingerprints; rows are numbered
by (doc_id, text hash), a null doc_id first, so repeated ids and rows have neighbours too; in a table of one row the next
document is the row itself; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from harvestline.llm.common import stored, text_of

CELLS, HASHES = 32, 4
PART = CELLS // HASHES
ROUNDS = 12
LOAD = 12  # digests of a pair that a sketch is meant for in larger trials
TRIALS = 4
CHUNK = 1024


def paragraphs(text: Column) -> Column:
    """Digests of the distinct paragraphs."""
    return F.array_distinct(F.transform(F.split(text, "\n", -1), lambda p: F.xxhash64(p)))


def check(digest: Column) -> Column:
    return F.xxhash64(digest, F.lit("check"))


def place(digest: Column, k: int) -> Column:
    """The cell of a digest in the k-th part of a sketch."""
    return F.pmod(F.xxhash64(digest, F.lit(k)), F.lit(PART)).cast("int") + k * PART


def cell(n: Column, x: Column, c: Column) -> Column:
    return F.struct(n.cast("int").alias("n"), x.cast("long").alias("x"), c.cast("long").alias("c"))


def plus(a: Column, d: Column, sign: int | Column) -> Column:
    """A cell with a digest put in (1) or taken out (-1)."""
    return cell(a["n"] + sign, a["x"].bitwiseXOR(d), a["c"].bitwiseXOR(check(d)))


def sketch(digests: Column) -> Column:
    """The cells of a set of digests, in order."""
    nothing = cell(F.lit(0), F.lit(0), F.lit(0))

    def part(k: int) -> Column:
        own = F.transform(digests, lambda d: F.struct(place(d, k).alias("at"), d.alias("d")))
        return F.transform(F.sequence(F.lit(k * PART), F.lit(k * PART + PART - 1)),
                           lambda i: F.aggregate(F.filter(own, lambda e: e["at"] == i), nothing, lambda a, e: plus(a, e["d"], 1)))

    return F.concat(*[part(k) for k in range(HASHES)])


def subtracted(a: Column, b: Column) -> Column:
    return F.zip_with(a, b, lambda p, q: cell(p["n"] - q["n"], p["x"].bitwiseXOR(q["x"]), p["c"].bitwiseXOR(q["c"])))


def peeled(cells: Column) -> Column:
    """Whether a subtracted sketch could be emptied, and how many digests of the first and of the second set came out.

    A round takes all digests that stand alone in a cell out of their cells, each once.
    """
    start = F.struct(cells.alias("cells"), F.lit(False).alias("ended"), F.lit(0).alias("ahead"), F.lit(0).alias("behind"))

    def round_(acc: Column, _: Column) -> Column:
        pure = F.filter(acc["cells"], lambda z: (F.abs(z["n"]) == 1) & (z["c"] == check(z["x"])))
        found = F.array_distinct(F.transform(pure, lambda z: F.struct(
            z["x"].alias("x"), z["n"].alias("n"), F.array(*[place(z["x"], k) for k in range(HASHES)]).alias("at"))))

        def after(new: Column) -> Column:
            def without(z: Column, i: Column) -> Column:
                return F.aggregate(F.filter(new, lambda d: F.array_contains(d["at"], i)), z, lambda a, d: plus(a, d["x"], -d["n"]))

            count = lambda side: F.size(F.filter(new, lambda d: d["n"] == side))
            return F.struct(F.transform(acc["cells"], without).alias("cells"), (F.size(new) == 0).alias("ended"),
                            (acc["ahead"] + count(1)).alias("ahead"), (acc["behind"] + count(-1)).alias("behind"))

        # the found digests are bound once, as the only element of an array
        return F.when(acc["ended"], acc).otherwise(F.element_at(F.transform(F.array(found), after), 1))

    end = F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), start, round_, lambda e: F.struct(
        (~F.exists(e["cells"], lambda z: (z["n"] != 0) | (z["x"] != 0) | (z["c"] != 0))).alias("ok"), e["ahead"], e["behind"]))
    return end


def printed(cells: Column) -> Column:
    part = lambda v, size: F.lpad(F.hex(v.cast("long")), size, "0")
    return F.lower(F.array_join(F.transform(cells, lambda z: F.concat(part(z["n"], 8), part(z["x"], 16), part(z["c"], 16))), ""))


def edited(text: Column, other: Column, n_chars: Column) -> Column:
    """The last quarter of a text's characters replaced by as many first ones of another, or by all that it has."""
    part = F.floor(n_chars / 4).cast("int")
    return F.concat(F.substring(text, F.lit(1), n_chars.cast("int") - part), F.substring(other, F.lit(1), part))


def neighbours(rows: DataFrame) -> DataFrame:
    """``id, text_hash, body`` rows with ``after``: the text of the next row, after the last row that of the first.

    Ids are dealt in chunks of CHUNK numbers (null ids by their text hash), and the next row is the following one in the
    chunk. The first rows of each chunk also stand, as guests, at the end of the chunk before; which chunk that is follows
    from the list of chunks alone, ordered on two levels.
    """
    known = F.col("id").isNotNull()
    rows = rows.withColumn("band", known.cast("int")).withColumn("chunk", F.when(known, F.floor(F.col("id") / CHUNK).cast("long")).otherwise(F.shiftright("text_hash", 54)))
    chunks = rows.groupBy("band", "chunk").agg(F.min(F.coalesce("id", "text_hash")).alias("head"))
    chunks = stored(chunks.withColumn("high", F.floor(F.col("chunk") / CHUNK).cast("long")), "print-chunks")
    inner, outer = Window.partitionBy("band", "high").orderBy("chunk"), Window.orderBy("band", "high")
    lasts = chunks.groupBy("band", "high").agg(F.max("chunk").alias("chunk"))
    ends = F.struct("band", "chunk")
    lasts = lasts.select("band", "high", F.coalesce(F.lag(ends).over(outer), F.last(ends).over(
        outer.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))).alias("over"))
    before = chunks.withColumn("previous", F.lag(ends).over(inner)).join(lasts, ["band", "high"])
    before = stored(before.select("band", "chunk", "head", F.coalesce("previous", "over").alias("host")), "print-heads")
    guests = rows.withColumn("head", F.coalesce("id", "text_hash")).join(before, ["band", "chunk", "head"])
    guests = guests.select("id", "text_hash", "body", "host.band", "host.chunk", F.lit(1).alias("guest"))
    both = rows.select("id", "text_hash", "body", "band", "chunk", F.lit(0).alias("guest")).union(guests)
    inside = Window.partitionBy("band", "chunk").orderBy("guest", "id", "text_hash")
    return both.withColumn("after", F.lead("body").over(inside)).where("guest = 0").select("id", "text_hash", "body", "after")


def retried(pairs: DataFrame) -> DataFrame:
    """``pair, kind, ahead, behind`` for rows ``pair, kind, a, b`` of two sets of digests, by larger sketches."""
    done = None
    for trial in range(TRIALS):
        many = F.greatest(F.lit(1), F.ceil((F.size("a") + F.size("b")) * (1 << trial) / LOAD)).cast("int")
        side = lambda name, s: F.transform(name, lambda d: F.struct(d.alias("d"), F.lit(s).alias("side")))
        rows = pairs.select("pair", "kind", many.alias("m"), F.explode(F.concat(side("a", 0), side("b", 1))).alias("e"))
        rows = rows.select("pair", "kind", "e.d", "e.side", F.pmod(F.xxhash64("e.d", F.lit(trial), F.lit("deal")), "m").alias("sketch"))
        dealt = rows.groupBy("pair", "kind", "sketch").agg(*[F.collect_list(F.when(F.col("side") == s, F.col("d"))).alias(n) for s, n in enumerate("ab")])
        out = dealt.select("pair", "kind", peeled(subtracted(sketch(F.col("a")), sketch(F.col("b")))).alias("p"))
        out = out.groupBy("pair", "kind").agg(F.min("p.ok").alias("ok"), F.sum("p.ahead").alias("ahead"), F.sum("p.behind").alias("behind"))
        out = stored(out, f"print-trial-{trial}")
        ended = out.where("ok").select("pair", "kind", "ahead", "behind")
        done = ended if done is None else done.union(ended)
        pairs = stored(pairs.join(out.where("not ok").select("pair", "kind"), ["pair", "kind"], "left_semi"), f"print-failed-{trial}")
    rest = pairs.select("pair", "kind", F.size(F.array_except("a", "b")).cast("long").alias("ahead"), F.size(F.array_except("b", "a")).cast("long").alias("behind"))
    return done.union(rest)


def fingerprints(df: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row per document: ``id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next``, and
    ``n_paragraphs`` and ``retried`` (whether a pair needed larger sketches)."""
    body = text_of(df, text)
    rows = neighbours(df.select(F.col(doc_id).alias("id"), F.xxhash64(body).alias("text_hash"), body.alias("body")))
    rows = rows.withColumn("n_chars", F.length("body").cast("long")).withColumn("changed", edited(F.col("body"), F.col("after"), F.col("n_chars")))
    sets = stored(rows.select(F.monotonically_increasing_id().alias("pair"), "id", "n_chars", F.sha2("changed", 256).alias("edited_sha256"),
                              paragraphs(F.col("body")).alias("own"), paragraphs(F.col("changed")).alias("edited"),
                              paragraphs(F.col("after")).alias("next")), "print-sets")
    cells = sets.select("pair", *[sketch(F.col(n)).alias(n) for n in ("own", "edited", "next")])
    small = stored(cells.select("pair", *[peeled(subtracted(F.col("own"), F.col(n))).alias(n) for n in ("edited", "next")]), "print-small")
    failed = small.select("pair", F.explode(F.filter(F.array(*[F.struct(F.lit(n).alias("kind"), F.col(f"{n}.ok").alias("ok")) for n in ("edited", "next")]),
                                                     lambda s: ~s["ok"])).alias("s")).select("pair", "s.kind")
    sides = sets.join(failed, "pair").select("pair", "kind", F.col("own").alias("a"), F.when(F.col("kind") == "edited", F.col("edited")).otherwise(F.col("next")).alias("b"))
    again = retried(stored(sides, "print-failed"))
    again = again.groupBy("pair").agg(*[F.max(F.when(F.col("kind") == n, F.struct("ahead", "behind"))).alias(f"{n}_again") for n in ("edited", "next")])
    out = sets.join(small.withColumnsRenamed({"edited": "e", "next": "x"}), "pair").join(stored(again, "print-again"), "pair", "left")

    def near(first: str, later: str, other: str) -> Column:
        # what both have, over what either has
        ahead = F.when(F.col(f"{first}.ok"), F.col(f"{first}.ahead")).otherwise(F.col(f"{later}.ahead"))
        return (F.size("own") - ahead) / (F.size(other) + ahead)

    return out.select("id", "n_chars", "edited_sha256", printed(sketch(F.col("own"))).alias("fingerprint"), printed(sketch(F.col("edited"))).alias("edited_fingerprint"),
                      near("e", "edited_again", "edited").alias("near_edited"), near("x", "next_again", "next").alias("near_next"),
                      F.size("own").cast("long").alias("n_paragraphs"), (~(F.col("e.ok") & F.col("x.ok"))).alias("retried"))
