"""Exact quantiles without collecting values.

Quantiles by group are bounded by a sketch of each group and found by one exact pass. Whole-table quantiles narrow the range of each wanted rank in a fixed number
of passes over the table: a pass counts 4096 parts of the range map-side, and only the distinct values of the last parts are
ordered. The plan is lazy and the same for every size; what passes hand on is a few rows for each column and probability,
so its broadcast has a fixed bound.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add, or_

from pyspark.sql import Column, DataFrame, Window, functions as F

BUCKETS = 4096
PASSES = 2
#: Size of the sketches by group, and half the share of a group's rows by which a bound is moved outward. The standard error of a
#: rank is a seventh of it, and the other half covers the two ranks between which a quantile lies.
SKETCH = 2048
MARGIN = 0.004
#: Rows from which the bounds of a group go to its rows. A join would read the whole group in one task.
LARGE_ROWS = 1_000_000


def _stacked(df: DataFrame, cols: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """(column, value) rows of the known values."""
    typed = df.select(*keep, *[F.col(c).cast("double").alias(c) for c in cols])
    return typed.unpivot(list(keep), list(cols), "column", "value").filter(F.col("value").isNotNull())


def _bucket(value: Column, lo: Column, hi: Column) -> Column:
    width = hi - lo
    place = F.floor((value - lo) / F.when(width > 0, width) * BUCKETS)
    return F.coalesce(F.least(place, F.lit(BUCKETS - 1)), F.lit(0)).cast("int")


def _by_group(df: DataFrame, cols: Sequence[str], probs: Sequence[float], by: Sequence[str]) -> DataFrame:
    """Quantiles of every group, for groups of any size and number; null is a group.

    A KLL sketch of each group bounds the values where a wanted rank can lie. One exact pass then counts, map-side, the rows
    below the bounds and those of each value within; only these values are ordered. A rank outside its bounds, which needs an
    error of the sketch seven times its deviation, ends the query with an error instead of a wrong value.
    """
    group = ["_k", "column"]
    values = _stacked(df.withColumn("_k", F.struct(*[F.col(b) for b in by])), cols, ["_k"])
    sketches = values.groupBy(*group).agg(F.count(F.lit(1)).alias("n"), F.min("value").alias("lo"), F.max("value").alias("hi"),
                                          F.kll_sketch_agg_double("value", F.lit(SKETCH)).alias("sketch"))

    few = F.col("n") * MARGIN <= 2  # where a step of one rank is wide, and all values are counted
    at = lambda share: F.kll_sketch_get_quantile_double("sketch", F.lit(share))
    low = lambda p: F.col("lo") if p <= 2 * MARGIN else F.when(few, F.col("lo")).otherwise(at(p - 2 * MARGIN))
    high = lambda p: F.col("hi") if p >= 1 - 2 * MARGIN else F.when(few, F.col("hi")).otherwise(at(p + 2 * MARGIN))
    bounds = sketches.select(*group, "n", *[c.alias(f"_{name}{i}") for i, p in enumerate(probs) for name, c in (("low", low(p)), ("high", high(p)))])
    # Sketches are drawn anew whenever they are made, also when a lost task is run again. Each row is therefore judged once, in this
    # one aggregation: it lies below the bounds of probability i (bit i of the first mask) or within them (second mask) with
    # its value, so the rows up to any value within all bounds are counted right, whichever bounds a task has seen.
    under = [F.col("value") < F.col(f"_low{i}") for i in range(len(probs))]
    within = [F.col("value").between(F.col(f"_low{i}"), F.col(f"_high{i}")) for i in range(len(probs))]
    mask = lambda tests: reduce(add, [F.when(t, 1 << i).otherwise(0) for i, t in enumerate(tests)])
    # There are fewer large groups than rows / LARGE_ROWS, so their bounds may be broadcast; no row of theirs is shuffled.
    large = F.col("n") > LARGE_ROWS
    names = sketches.filter(large).select(*group)
    bounded = values.join(F.broadcast(bounds.filter(large)), group).unionByName(
        values.join(F.broadcast(names), group, "left_anti").join(bounds.filter(~large), group))
    met = bounded.select(*group, "n", mask(under).alias("under"), mask(within).alias("within"),
                                            F.when(reduce(or_, within), F.col("value")).alias("at"))
    tallied = met.groupBy(*group, "n", "under", "within", "at").agg(F.count(F.lit(1)).alias("rows"))
    has = lambda name, i: F.col(name).bitwiseAND(F.lit(1 << i)) != 0
    each = F.array(*[F.when(has("under", i) | has("within", i), F.struct(F.lit(float(p)).alias("prob"), F.when(has("within", i), F.col("at")).alias("at")))
                     for i, p in enumerate(probs)])
    parts = tallied.select(*group, "n", "rows", F.explode(F.array_compact(each)).alias("e")).select(*group, "n", "rows", "e.*")
    running = Window.partitionBy(*group, "prob").orderBy(F.col("at").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, 0)
    rank = F.col("prob") * (F.col("n") - 1)
    placed = parts.withColumns({"end": F.sum("rows").over(running), "rank": rank}).filter(F.col("at").isNotNull())
    holds = lambda at: F.max(F.when((F.col("end") - F.col("rows") <= at) & (at < F.col("end")), F.col("at")))
    found = placed.groupBy(*group, "n", "prob", "rank").agg(holds(F.floor("rank")).alias("below"), holds(F.ceil("rank")).alias("above"))
    lost = F.raise_error(F.lit("a quantile lies outside the bounds of its sketch"))
    value = F.col("below") + (F.col("rank") - F.floor("rank")) * (F.col("above") - F.col("below"))
    checked = F.when(F.col("below").isNull() | F.col("above").isNull(), lost.cast("double")).otherwise(value)
    return found.select(*[F.col(f"_k.{b}").alias(b) for b in by], "column", "n", "prob", checked.alias("value"))


def quantile_table(df: DataFrame, cols: Sequence[str], probs: Sequence[float], by: Sequence[str] = ()) -> DataFrame:
    """Rows (``*by``, column, n, prob, value): linear-interpolation quantiles of each column. A null group is a group."""
    if by:
        return _by_group(df, cols, probs, by)
    values = _stacked(df, cols)
    # Each span is a value range [lo, hi] whose rows occupy ranks before .. before + n - 1.
    totals = values.groupBy("column").agg(F.count(F.lit(1)).alias("n"), F.min("value").alias("lo"), F.max("value").alias("hi"))
    rank = [F.lit(float(p)) * (F.col("n") - 1) for p in probs]
    wanted = F.array_sort(F.array_distinct(F.array(*[F.floor(r) for r in rank], *[F.ceil(r) for r in rank])))
    totals = totals.withColumn("wanted", wanted)
    spans = totals.select("column", "wanted", "lo", "hi", F.lit(0).cast("long").alias("before"), F.lit(0).alias("span"))
    inside = lambda: values.join(F.broadcast(spans.drop("wanted", "before")), "column").filter(F.col("value").between(F.col("lo"), F.col("hi")))
    holds = F.exists("wanted", lambda w: (w >= F.col("before")) & (w < F.col("before") + F.col("n")))

    def placed(parts: DataFrame, order: str) -> DataFrame:
        """The parts of the spans with the number of rows below them, where a wanted rank falls."""
        earlier = Window.partitionBy("column", "span").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
        return (parts.join(F.broadcast(spans.select("column", "span", "wanted", "before")), ["column", "span"])
                .withColumn("before", F.col("before") + F.coalesce(F.sum("n").over(earlier), F.lit(0))).filter(holds))

    for _ in range(PASSES):
        counted = (inside().groupBy("column", "span", _bucket(F.col("value"), F.col("lo"), F.col("hi")).alias("bucket"))
                   .agg(F.count(F.lit(1)).alias("n"), F.min("value").alias("lo"), F.max("value").alias("hi")))
        spans = (placed(counted, "bucket")
                 .withColumn("span", F.row_number().over(Window.partitionBy("column").orderBy("before")))
                 .select("column", "wanted", "lo", "hi", "before", "span"))
    tallied = inside().groupBy("column", "span", "value").agg(F.count(F.lit(1)).alias("n"))
    located = (placed(tallied, "value").withColumn("rank", F.explode(F.filter(
        "wanted", lambda w: (w >= F.col("before")) & (w < F.col("before") + F.col("n")))))
        .groupBy("column").agg(F.map_from_entries(F.collect_list(F.struct("rank", "value"))).alias("at")))
    exact = totals.join(located, "column").withColumn("prob", F.explode(F.array(*[F.lit(float(x)) for x in probs])))
    r = F.col("prob") * (F.col("n") - 1)
    below, above = F.element_at("at", F.floor(r)), F.element_at("at", F.ceil(r))
    return exact.select("column", "n", "prob", (below + (r - F.floor(r)) * (above - below)).alias("value"))


def quantiles(df: DataFrame, cols: Sequence[str], probs: Sequence[float]) -> dict[str, list[float | None]]:
    """Whole-table quantiles per column as plain numbers, for use in filters that reach the scan."""
    found = {(r["column"], r["prob"]): r["value"] for r in quantile_table(df, cols, probs).collect()}
    return {c: [found.get((c, float(p))) for p in probs] for c in cols}


def medians(df: DataFrame, cols: Sequence[str], default: float | None = None) -> dict[str, float | None]:
    found = quantiles(df, cols, [0.5])
    return {c: default if found[c][0] is None else found[c][0] for c in cols}


def trim_quantiles(df: DataFrame, col: str, lo: float = 0.005, hi: float = 0.995) -> DataFrame:
    """Keep rows between two quantiles of the column, both inclusive."""
    low, high = quantiles(df, [col], [lo, hi])[col]
    if low is None:
        return df.filter(F.lit(False))
    return df.filter(F.col(col).between(F.lit(low), F.lit(high)))
