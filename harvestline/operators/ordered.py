"""Ordered windows and positions that never need a whole large group in one task.

There is one plan for every size: rows are numbered inside chunks of the order and shifted by the sizes of earlier chunks,
and windows run over blocks of whole chunks that overlap by the reach of their frames.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

# Rows from which a group is cut into blocks, and the positions in which the chunks of a block begin.
BLOCK_ROWS = 1_000_000


def total_order(df: DataFrame, first: Sequence[Column | str], skip: Sequence[str] = ()) -> list[Column]:
    """``first`` followed by every other orderable column, so that equal rows are the only ties left."""
    named = {c for c in first if isinstance(c, str)} | set(skip)
    rest = [f.name for f in df.schema.fields
            if f.name not in named and f.dataType.typeName() not in ("map", "variant")]
    return [F.col(c) if isinstance(c, str) else c for c in first] + [F.col(c).asc_nulls_last() for c in rest]


def with_position(df: DataFrame, chunk: Column, order: Sequence[Column | str], by: Sequence[str] = (),
                  name: str = "position") -> DataFrame:
    """0-based position of every row in the order ``chunk, *order`` (per group of ``by``).

    ``chunk`` is a coarse leading part of the order such as the date. Rows are numbered inside a chunk and shifted by
    the number of rows in earlier chunks, an aggregate that is joined back. Nulls are keys like any other: chunks are
    told apart by a struct, in which null equals null.
    """
    by, cols = list(by), df.columns
    keyed = df.withColumn("_g", F.struct(*[F.col(b) for b in by], chunk.alias("_c")))
    sizes = keyed.groupBy("_g").agg(F.count(F.lit(1)).alias("_n"))
    earlier = (Window.partitionBy(*[F.col(f"_g.{b}") for b in by]).orderBy(F.col("_g._c").asc_nulls_first())
               .rowsBetween(Window.unboundedPreceding, -1))
    offsets = sizes.select(F.col("_g").alias("_h"), F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    within = Window.partitionBy("_g").orderBy(*order)
    return (keyed.join(offsets, F.col("_g") == F.col("_h"))
            .withColumn(name, F.col("_before") + F.row_number().over(within) - 1).select(*cols, name))


def block_ranges(df: DataFrame, by: Sequence[str], chunk: Column, back: int, ahead: int, size: int, large: DataFrame | None = None) -> DataFrame:
    """``_h`` and ``_blocks`` of the groups with over ``size`` rows: which chunks each block owns, and which its frames reach.

    A block owns the chunks that begin in its ``size`` positions. There are fewer groups and blocks here than rows / size, so
    the table may be broadcast. Only these groups are counted by chunk; chunks are structs, whose order has nulls first.
    ``large`` holds these groups as structs ``_h``, where they are known already.
    """
    keyed = df.select(F.struct(*[F.col(b) for b in by]).alias("_g"), F.struct(chunk.alias("_c")).alias("_c"))
    if large is None:
        large = keyed.groupBy(F.col("_g").alias("_h")).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > size).select("_h")
    sizes = keyed.join(F.broadcast(large), F.col("_g") == F.col("_h")).groupBy("_h", "_c").agg(F.count(F.lit(1)).alias("_n"))
    running = Window.partitionBy("_h").orderBy("_c")
    chunks = sizes.withColumn("_end", F.sum("_n").over(running)).withColumn("_at", F.col("_end") - F.col("_n"))
    chunks = chunks.withColumn("_own", F.floor(F.col("_at") / size))
    edges = chunks.groupBy("_h", "_own").agg(F.min("_at").alias("first"), F.max("_end").alias("end"))
    edges = edges.groupBy("_h").agg(F.collect_list(F.struct(F.col("_own").alias("block"), "first", "end")).alias("_edges"))
    reached = F.filter("_edges", lambda b: (b["first"] < F.col("_end") + back) & (b["end"] + ahead > F.col("_at")))
    near = chunks.join(F.broadcast(edges), "_h").withColumn("_b", F.explode(reached))
    own = F.when(F.col("_b.block") == F.col("_own"), F.col("_c"))
    ranges = near.groupBy("_h", "_b.block").agg(F.min("_c").alias("low"), F.max("_c").alias("high"),
                                                F.min(own).alias("first"), F.max(own).alias("last"))
    return ranges.groupBy("_h").agg(F.collect_list(F.struct("block", "low", "high", "first", "last")).alias("_blocks"))


def with_stages(df: DataFrame, stages: Sequence[dict[str, Column]]) -> DataFrame:
    """The columns of all stages, each of which may use those before; helper columns, whose names begin with ``_``, go."""
    for columns in stages:
        df = df.withColumns(columns)
    return df.drop(*[c for columns in stages for c in columns if c.startswith("_")])


def series_hash(by: Sequence[str]) -> Column:
    """A number that stands before the keys of a window: a sort tells most series apart by it and need not compare their texts."""
    return F.hash(*[F.col(b) for b in by])


def over_rows(df: DataFrame, by: Sequence[str], day: str, order: Sequence[Column | str],
              build: Callable[[Window], dict[str, Column] | Sequence[dict[str, Column]]], back: int, ahead: int = 0,
              block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Add window columns whose frames reach ``back`` rows back and ``ahead`` rows ahead in each group.

    ``build`` gives the columns, or stages of columns as ``with_stages`` takes them.

    Whole rows are shuffled once, by group and block. Groups with more than ``block_rows`` rows are cut into blocks of whole
    days, and each block also gets the days that its frames reach, so no task holds more of a group than a block and its
    borders. The cuts come from counts of the groups, and of the days of such groups only; a group of fewer rows is one block.
    """
    by = list(by)
    size = max(block_rows, 1)
    ranges = block_ranges(df, by, F.col(day), back, ahead, size)
    own_day = F.struct(F.col(day))
    reached = F.filter("_blocks", lambda b: (b["low"] <= own_day) & (own_day <= b["high"]))
    placed = (df.withColumn("_g", F.struct(*[F.col(b) for b in by]))
              .join(F.broadcast(ranges), F.col("_g") == F.col("_h"), "left").withColumn("_b", F.explode_outer(reached))
              .withColumn("_blk", F.coalesce("_b.block", F.lit(0)))
              .withColumn("_own", F.col("_b").isNull() | ((F.col("_b.first") <= own_day) & (own_day <= F.col("_b.last")))))
    within = Window.partitionBy(*by, "_blk").orderBy(F.col(day).asc_nulls_first(), *order)
    built = build(within)
    out = with_stages(placed.drop("_g", "_h", "_blocks", "_b"), [built] if isinstance(built, dict) else built)
    return out.filter("_own").drop("_own", "_blk")


def with_blocks(df: DataFrame, by: Sequence[str], chunk: Column, ranges: DataFrame, how: str = "left") -> DataFrame:
    """``_blk``, the block of ``ranges`` that owns the chunk of a row. Rows of groups that are not cut have none; an inner join
    leaves them out. Whole rows stay where they are."""
    own = F.struct(chunk)
    of = F.filter("_blocks", lambda b: (b["first"] <= own) & (own <= b["last"]))
    return (df.withColumn("_g", F.struct(*[F.col(b) for b in by])).join(F.broadcast(ranges), F.col("_g") == F.col("_h"), how)
            .withColumn("_blk", F.get(of, F.lit(0))["block"]).drop("_g", "_h", "_blocks"))
