"""Data contracts: rules are predicates, evaluated together in one pass."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, functions as F

from harvestline import vocab
from harvestline.functions import dates as D, measures as M, text as T
from harvestline.operators.dedup import duplicate_stats, keep_last
from harvestline.operators.shape import keep_scope, key_difference, missing_columns, rename_by_alias


@dataclass(frozen=True)
class Rule:
    """A named condition every row must meet; a condition that is null counts as met."""

    name: str
    ok: Column
    severity: str = "error"


def not_null(col: str) -> Rule:
    return Rule(f"{col}_present", F.col(col).isNotNull())


def filled(col: str) -> Rule:
    return Rule(f"{col}_filled", F.col(col).isNotNull() & (F.length(F.col(col)) >= 1))


def between(col: str, lo: float | None, hi: float | None, severity: str = "error") -> Rule:
    ok = F.lit(True)
    if lo is not None:
        ok = ok & (F.col(col) >= lo)
    if hi is not None:
        ok = ok & (F.col(col) <= hi)
    return Rule(f"{col}_range", ok, severity)


def one_of(col: str, values: list[str]) -> Rule:
    return Rule(f"{col}_allowed", F.col(col).isin(values))


def _all_present(*cols: Column) -> Column:
    return reduce(and_, [c.isNotNull() for c in cols])


def price_contract(scope: str | None = None, districts: list[str] | None = None,
                   sources: tuple[str, ...] = ("history", "current"), strict_prices: bool = True) -> list[Rule]:
    """Canonical price table: required text, scope, known districts and sources, consistent prices."""
    lo, hi, mid = F.col("min_price"), F.col("max_price"), F.col("modal_price")
    rules = [filled(c) for c in ("state", "district", "market", "commodity")] + [not_null("arrival_date")]
    if scope:
        rules.append(Rule("state_scope", T.same_text(F.col("state"), scope)))
    if districts:
        rules.append(one_of("district", districts))
    rules.append(one_of("source", list(sources)))
    if strict_prices:
        rules += [between(c, 0, None) for c in vocab.PRICE_MEASURES]
        rules += [Rule("min_not_above_max", lo <= hi), Rule("modal_inside", F.when(_all_present(lo, hi, mid), mid.between(lo, hi)))]
    return rules


def raw_price_contract(scope: str) -> list[Rule]:
    required = [filled(c) for c in ("state", "district", "market", "commodity")] + [not_null("arrival_date")]
    return [*required, Rule("state_scope", T.same_text(F.col("state"), scope)),
            *[between(c, 0, None) for c in vocab.PRICE_MEASURES]]


# --- fixed values: accepted ranges of weather columns -----------------------------------------------------
REGION_RANGES = {"latitude": (15.5, 22.5), "longitude": (72.5, 81.0)}
GLOBAL_RANGES = {"latitude": (-90, 90), "longitude": (-180, 180)}
OBSERVED_RANGES = {"t2m_max": (-10, 55), "t2m_min": (-10, 55), "t2m_mean": (-10, 55), "rh2m": (0, 100),
                   "precipitation": (0, None), "ws2m": (0, 200), "srad": (0, 50)}
LENIENT_RANGES = {"t2m_max": (-50, 60), "t2m_min": (-50, 60), "t2m_mean": (-50, 60), "rh2m": (0, 100),
                  "precipitation": (0, None)}
FORECAST_RANGES = {"temperature_max": (-10, 55), "temperature_min": (-10, 55), "precipitation_sum": (0, None),
                   "windspeed_max": (0, 200), "precipitation_probability_max": (0, 100), "weathercode": (0, 99)}
FILE_RANGES = {"modal_price": (0, 1_000_000), "min_price": (0, None), "max_price": (0, None)}
DAILY_RAIN_MAX = 500.0
MODAL_TOLERANCE = (0.9, 1.1)


def weather_contract(columns: list[str], forecast: bool = False, lenient: bool = False,
                     districts: list[str] | None = None) -> list[Rule]:
    ranges = {**(GLOBAL_RANGES if lenient else REGION_RANGES),
              **(FORECAST_RANGES if forecast else LENIENT_RANGES if lenient else OBSERVED_RANGES)}
    rules = [not_null("date"), filled("district")]
    if districts:
        rules.append(one_of("district", districts))
    return rules + [between(c, lo, hi) for c, (lo, hi) in ranges.items() if c in columns]


def file_contract(kind: str) -> list[Rule]:
    """Checks of a landed file before it is used: ``prices``, ``observations`` or ``forecast``."""
    if kind == "prices":
        lo, hi, mid = F.col("min_price"), F.col("max_price"), F.col("modal_price")
        low, high = MODAL_TOLERANCE
        return [*[not_null(c) for c in ("state", "district", "market", "commodity", "arrival_date", "modal_price")],
                *[between(c, a, b) for c, (a, b) in FILE_RANGES.items()],
                Rule("modal_near_range", F.when(_all_present(lo, hi, mid), mid.between(lo * low, hi * high)), "warning")]
    rain = "precipitation_sum" if kind == "forecast" else "precipitation"
    return [not_null("date"), between(rain, 0, DAILY_RAIN_MAX)]


def with_violations(df: DataFrame, rules: list[Rule], out: str = "violations") -> DataFrame:
    """The names of the rules each row breaks."""
    broken = [F.when(~r.ok, F.lit(r.name)) for r in rules]
    return df.withColumn(out, F.array_compact(F.array(*broken)))


def split_valid(df: DataFrame, rules: list[Rule]) -> tuple[DataFrame, DataFrame]:
    """Rows that keep every error rule, and the rest with the names of the rules they break."""
    checked = with_violations(df, [r for r in rules if r.severity == "error"])
    good = F.size("violations") == 0
    return checked.filter(good).drop("violations"), checked.filter(~good)


def violation_report(df: DataFrame, rules: list[Rule], by: list[str] | None = None) -> DataFrame:
    """How many rows break each rule, all rules counted in one aggregation."""
    by = by or []
    counts = df.groupBy(*by).agg(F.count(F.lit(1)).alias("_rows"),
                                 *[F.count_if(~r.ok).alias(r.name) for r in rules])
    rows = F.array(*[F.struct(F.lit(r.name).alias("rule"), F.lit(r.severity).alias("severity"),
                              F.col(r.name).alias("broken")) for r in rules])
    return counts.select(*by, F.col("_rows").alias("rows"), F.explode(rows).alias("r")).select(*by, "rows", "r.*")


def file_report(df: DataFrame, kind: str, file: str = "file", files: DataFrame | None = None) -> DataFrame:
    """Per file: rows, broken rules, status, and code 0 (valid), 1 (warnings) or 2 (errors).

    ``files`` lists the files that should be there: one without a row is invalid. Without it only files with rows are known.
    """
    rules = file_contract(kind)
    per_rule = violation_report(df, rules, [file])
    wrong = per_rule.groupBy(file).agg(
        F.max("rows").alias("rows"), F.sum(F.when(F.col("severity") == "error", F.col("broken")).otherwise(0)).alias("errors"),
        F.sum(F.when(F.col("severity") != "error", F.col("broken")).otherwise(0)).alias("warnings"))
    if files is not None:
        wrong = files.select(file).distinct().join(wrong, file, "left").fillna(0, ["rows", "errors", "warnings"])
    code = F.when((F.col("errors") > 0) | (F.col("rows") == 0), 2).when(F.col("warnings") > 0, 1).otherwise(0)
    return wrong.withColumn("code", code).withColumn("status", F.when(code == 2, "invalid").otherwise("valid"))


def normalize_raw_prices(df: DataFrame, scope: str, strict: bool = False) -> tuple[DataFrame, DataFrame]:
    """Raw price file to valid rows and rejects: names, dates, text, numbers, required columns, scope, contract.

    Text is trimmed and title-cased, a null stays null, and negative prices become null.
    """
    named = rename_by_alias(df, vocab.RAW_PRICE_ALIASES)
    missing = missing_columns(named, vocab.PRICE_REQUIRED)
    if missing:
        raise ValueError(f"missing required columns: {', '.join(missing)}")
    dated = D.parse_date_by_consensus(named, "arrival_date")
    texts = {c: T.null_if_blank(F.col(c)) for c in ("state", "district", "market", "commodity", "variety", "grade")
             if c in dated.columns}
    cased = dated.withColumns({c: (e if c == "state" else T.title_words(e)) for c, e in texts.items()})
    prices = {}
    for c in vocab.PRICE_MEASURES:
        value = M.number(F.col(c)) if c in cased.columns else F.lit(None).cast("double")
        prices[c] = F.when(value >= 0, value)
    clean = cased.withColumns(prices)
    # as one row of a generator: the rules' filters would else clean each column again for every mention of it
    clean = clean.select(F.inline(F.array(F.struct(*[F.col(f"`{c}`") for c in clean.columns]))))
    rules = raw_price_contract(scope)
    valid, rejects = split_valid(clean, rules)
    if strict:
        first = rejects.limit(1).collect()
        if first:
            raise ValueError(f"rows break the contract: {first[0]['violations']}")
    return keep_scope(valid, "state", scope), rejects


def dedup_raw_prices(df: DataFrame, order: list[str]) -> DataFrame:
    keys = [c for c in vocab.PRICE_KEY if c in df.columns]
    return keep_last(df, keys, order)


def repair_prices(df: DataFrame, flags: bool = True) -> DataFrame:
    """Negative prices become null, swapped bounds are swapped back, a modal price outside both bounds is clamped."""
    lo, hi, mid = (F.when(F.col(c) >= 0, F.col(c)) for c in vocab.PRICE_MEASURES)
    swapped = lo > hi
    low, high = F.when(swapped, hi).otherwise(lo), F.when(swapped, lo).otherwise(hi)
    complete = _all_present(low, high, mid)
    outside = complete & ((mid < low) | (mid > high))
    clamped = F.when(complete & (mid < low), low).when(complete & (mid > high), high).otherwise(mid)
    count = sum((F.coalesce((F.col(c) < 0).cast("int"), F.lit(0)) for c in vocab.PRICE_MEASURES), F.lit(0))
    fixed = {"min_price": low, "max_price": high, "modal_price": clamped}
    if flags:
        fixed |= {"negative_prices": count, "min_gt_max": F.coalesce(swapped, F.lit(False)).cast("int"),
                  "modal_out_of_range": F.coalesce(outside, F.lit(False)).cast("int")}
    return df.withColumns(fixed)


def price_violation_counts(repaired: DataFrame) -> DataFrame:
    sums = {c: F.coalesce(F.sum(c), F.lit(0)) for c in ("negative_prices", "min_gt_max", "modal_out_of_range")}
    return repaired.agg(*[s.alias(c) for c, s in sums.items()],
                        sum(list(sums.values())[1:], list(sums.values())[0]).alias("rows_fixed"))


def output_gate(df: DataFrame, keys: list[str], dim: DataFrame, key: str, scope_col: str | None = None,
                scope: str | None = None) -> DataFrame:
    """One row: whether keys are unique, all members known and the scope kept. A write goes ahead only if all hold."""
    unique = duplicate_stats(df, keys).select((F.col("rows_to_remove") == 0).alias("unique_keys"))
    unknown = key_difference(df, dim, key).agg((F.count(F.lit(1)) == 0).alias("ok")).scalar()
    inside = F.lit(True)
    if scope_col:
        outside = F.count_if(~F.coalesce(T.same_text(F.col(scope_col), scope), F.lit(False)))
        inside = df.agg((outside == 0).alias("ok")).scalar()
    checked = unique.withColumns({"known_members": unknown, "scope_kept": inside})
    return checked.withColumn("passed", F.col("unique_keys") & F.col("known_members") & F.col("scope_kept"))
