"""Projection, renaming, scope and set operators."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from harvestline.functions import text as T
from harvestline.operators.ordered import with_position


def rename_by_alias(df: DataFrame, aliases: dict[str, list[str]]) -> DataFrame:
    """Standard column names. Where several source columns mean the same, the first non-null value in alias order."""
    by_name: dict[str, list[str]] = {}
    for col in df.columns:
        by_name.setdefault(T.snake_name(col), []).append(col)
    out, used = [], set()
    for canonical, names in aliases.items():
        found = [c for name in names for c in by_name.get(name, [])]
        if found:
            used.update(found)
            out.append(F.coalesce(*[F.col(f"`{c}`") for c in found]).alias(canonical))
    rest = [F.col(f"`{c}`").alias(T.snake_name(c)) for c in df.columns if c not in used]
    return df.select(*out, *rest)


def conform(df: DataFrame, schema: dict[str, str], extra: bool = False) -> DataFrame:
    """The canonical columns in order, absent ones as typed nulls, text that does not fit its type as null."""
    types = dict(df.dtypes)

    def fitted(name: str, want: str) -> Column:
        if name not in types:
            return F.lit(None).cast(want).alias(name)
        have = types[name]
        return (F.col(name) if have == want else F.col(name).try_cast(want)).alias(name)

    rest = [c for c in df.columns if c not in schema] if extra else []
    return df.select(*[fitted(n, t) for n, t in schema.items()], *rest)


def keep_scope(df: DataFrame, col: str, value: str) -> DataFrame:
    return df.filter(T.same_text(F.col(col), value)).withColumn(col, F.lit(value))


def scope_violations(df: DataFrame, col: str, value: str, top: int = 5) -> DataFrame:
    """The most frequent values outside the scope, with the number of all rows outside it."""
    outside = df.filter(~F.coalesce(T.same_text(F.col(col), value), F.lit(False)))
    counts = outside.groupBy(col).agg(F.count(F.lit(1)).alias("rows"))
    return counts.orderBy(F.desc("rows"), F.col(col).asc_nulls_last()).limit(top)


def enforce_scope(df: DataFrame, col: str, value: str, strict: bool = True) -> DataFrame:
    """Strict: refuse a table with rows outside the scope. Lenient: drop them."""
    if strict:
        bad = scope_violations(df, col, value).collect()
        if bad:
            raise ValueError(f"{col} must be {value}; found " + ", ".join(f"{r[col]} ({r['rows']})" for r in bad))
    return keep_scope(df, col, value)


def drop_unmapped(df: DataFrame, col: str) -> DataFrame:
    return df.filter(F.col(col).isNotNull())


def max_null_fraction(df: DataFrame, cols: Sequence[str], fraction: float = 0.3) -> DataFrame:
    """Rows in which at most this share of the columns is null."""
    return df.dropna(thresh=len(cols) - math.floor(fraction * len(cols) + 1e-9), subset=list(cols))


def drop_incomplete(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.dropna(how="any", subset=list(cols))


def only(df: DataFrame, **equals: object) -> DataFrame:
    for col, value in equals.items():
        df = df.filter(F.col(col) == F.lit(value))
    return df


def last_n_days(df: DataFrame, col: str, days: int) -> DataFrame:
    newest = df.agg(F.max(col).alias("newest")).scalar()
    return df.filter(F.col(col) >= F.date_sub(newest, days))


def from_year(df: DataFrame, col: str, year: int) -> DataFrame:
    """A bound on the date itself, which file and partition pruning can use; a test on its year cannot be pushed."""
    return df.filter(F.col(col) >= F.lit(f"{year:04d}-01-01").cast(dict(df.dtypes)[col]))


def time_split(df: DataFrame, col: str, train_end: str, valid_end: str) -> DataFrame:
    """Half-open parts; rows on or after the second bound form the third part."""
    part = (F.when(F.col(col) < F.lit(train_end), "train").when(F.col(col) < F.lit(valid_end), "validation")
            .when(F.col(col).isNotNull(), "test"))
    return df.withColumn("part", part)


def ordered_split(df: DataFrame, day: str, order: Sequence[Column | str], share: float = 0.8) -> DataFrame:
    """The earliest ``share`` of the rows for training, the rest for test, by one exact global order."""
    placed = with_position(df, F.col(day), order)
    cut = df.agg(F.floor(F.count(F.lit(1)) * share).alias("cut")).scalar()
    return placed.withColumn("part", F.when(F.col("position") < cut, "train").otherwise("test")).drop("position")


def require(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise ValueError(f"missing required columns: {', '.join(missing)}")
    return df


def missing_columns(df: DataFrame, cols: Sequence[str]) -> list[str]:
    return [c for c in cols if c not in df.columns]


def add_ingestion_metadata(df: DataFrame, source: str, ingested_at: str) -> DataFrame:
    """Source tag and ingestion time; the time is given so that a repeated run writes the same rows."""
    return df.withColumns({"source": F.lit(source), "ingested_at_utc": F.lit(ingested_at).cast("timestamp_ntz")})


def union_all(*tables: DataFrame) -> DataFrame:
    first, *rest = tables
    for table in rest:
        first = first.unionByName(table, allowMissingColumns=True)
    return first


def key_difference(left: DataFrame, right: DataFrame, col: str) -> DataFrame:
    return left.select(col).filter(F.col(col).isNotNull()).distinct().join(right.select(col), col, "left_anti")


def key_intersection(left: DataFrame, right: DataFrame, col: str) -> DataFrame:
    return left.select(col).distinct().join(right.select(col), col, "left_semi")


def top_k(df: DataFrame, value: str, key: str, k: int) -> DataFrame:
    return df.orderBy(F.desc(value), F.col(key).asc_nulls_last()).limit(k)


def sorted_distinct(df: DataFrame, *cols: str) -> DataFrame:
    return df.select(*cols).distinct().orderBy(*cols)
