"""Join operators. None carries a broadcast hint: literal dimensions have exact sizes, so Catalyst checks them."""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from harvestline import vocab
from harvestline.functions import measures as M, text as T
from harvestline.operators.dedup import keep_first, latest
from harvestline.session import local_table


def join_daily(prices: DataFrame, weather: DataFrame, date: str = "arrival_date", weather_date: str = "date",
               keys: Sequence[str] = ("district",), rename: dict[str, str] = vocab.JOINED_WEATHER) -> DataFrame:
    """Prices with the observation of their day and district; ``has_weather`` tells whether there is one."""
    day = F.col(weather_date).cast("date").alias("_day")
    measures = [F.col(c).alias(n) for c, n in rename.items() if c in weather.columns]
    side = weather.select(day, *[F.col(k).alias(f"_w_{k}") for k in keys], *measures)
    cond = F.to_date(F.col(date)) == F.col("_day")
    for k in keys:
        cond = cond & (F.col(k) == F.col(f"_w_{k}"))
    return (prices.join(side, cond, "left").withColumn("has_weather", F.col("_day").isNotNull().cast("int"))
            .drop("_day", *[f"_w_{k}" for k in keys]))


def district_alias_table(spark: SparkSession) -> DataFrame:
    return local_table(spark, vocab.district_aliases(),
                       pa.schema([("alias", pa.string()), ("canonical", pa.string())]))


def normalize_key(df: DataFrame, col: str, aliases: DataFrame, out: str | None = None,
                  unmapped: str = "null") -> DataFrame:
    """Canonical name by alias: the whole cleaned text first, else its part before a parenthesis.

    ``unmapped``: ``null`` leaves no value, ``keep`` the raw text, ``fail`` refuses the table.
    """
    out = out or col
    whole = aliases.select(F.col("alias").alias("_a1"), F.col("canonical").alias("_c1"))
    base = aliases.select(F.col("alias").alias("_a2"), F.col("canonical").alias("_c2"))
    key = T.clean_key(F.col(col))
    mapped = (df.withColumn("_key", key)
              .withColumn("_base", F.when(F.contains(F.col("_key"), F.lit("(")), T.before_paren(F.col("_key"))))
              .join(whole, F.col("_key") == F.col("_a1"), "left")
              .join(base, F.col("_base") == F.col("_a2"), "left")
              .withColumn("_name", F.coalesce("_c1", "_c2")))
    if unmapped == "fail":
        missing = mapped.filter(F.col("_name").isNull()).select(F.col(col).cast("string").alias("raw")).distinct()
        names = [r["raw"] for r in missing.orderBy("raw").limit(5).collect()]
        if names:
            raise ValueError(f"unmapped values of {col}: {names}")
    name = F.coalesce(F.col("_name"), F.col(col)) if unmapped == "keep" else F.col("_name")
    return mapped.withColumn(out, name).drop("_key", "_base", "_a1", "_c1", "_a2", "_c2", "_name")


def lookup_first(samples: DataFrame, facts: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """The fact row of each sample; of several rows on one key the first in ``order``; samples without one go."""
    return samples.join(keep_first(facts, keys, order), list(keys))


def stage_of(df: DataFrame, stages: DataFrame, days: str = "days_since_sowing", key: str = "crop",
             default: str = "post_harvest") -> DataFrame:
    """The stage whose day range holds ``days``; ranges of one crop are disjoint."""
    side = stages.select(F.col(key).alias("_s_key"), F.col("stage").alias("_stage"), "start_day", "end_day",
                         F.col("critical").alias("_critical"))
    cond = (F.col(key) == F.col("_s_key")) & F.col(days).between(F.col("start_day"), F.col("end_day"))
    return (df.join(side, cond, "left")
            .withColumns({"stage": F.coalesce("_stage", F.lit(default)),
                          "critical": F.coalesce("_critical", F.lit(False))})
            .drop("_s_key", "_stage", "_critical", "start_day", "end_day"))


def coverage(dim: DataFrame, prices: DataFrame, weather: DataFrame, key: str = "district",
             date: str = "arrival_date") -> DataFrame:
    """Each dimension member with what the fact tables hold for it, found by one aggregation per table."""
    low = F.lower(F.col(key)).alias("_key")
    p = prices.groupBy(low).agg(
        F.count(F.lit(1)).alias("price_rows"), F.countDistinct("market").alias("markets"),
        F.countDistinct("commodity").alias("commodities"), F.min(date).alias("date_min"), F.max(date).alias("date_max"))
    w = weather.select(low).distinct().withColumn("_w", F.lit(True))
    out = (dim.select(key).withColumn("_key", F.lower(key)).join(p, "_key", "left").join(w, "_key", "left")
           .fillna(0, ["price_rows", "markets", "commodities"])
           .withColumn("has_prices", F.col("price_rows") > 0).withColumn("has_weather", F.coalesce("_w", F.lit(False))))
    return out.withColumn("data_status", M.data_status(F.col("has_prices"), F.col("has_weather"))).drop("_key", "_w")


def missing_members(dim: DataFrame, facts: DataFrame, key: str) -> DataFrame:
    seen = facts.select(F.lower(F.col(key)).alias("_seen")).distinct()
    return dim.select(key).join(seen, F.lower(F.col(key)) == F.col("_seen"), "left_anti")


def current_value(keys_table: DataFrame, live: DataFrame, history: DataFrame, keys: Sequence[str], date: str,
                  value: str) -> DataFrame:
    """Newest live value, else newest historical value, else 0, with the source it came from."""
    keys = list(keys)
    l = latest(live.select(*keys, date, value), keys, [date, value]).withColumnsRenamed({date: "_ld", value: "_lv"})
    h = latest(history.select(*keys, date, value), keys, [date, value]).withColumnsRenamed({date: "_hd", value: "_hv"})
    has_live = F.col("_lv").isNotNull()
    return (keys_table.select(*keys).distinct().join(l, keys, "left").join(h, keys, "left")
            .select(*keys,
                    F.coalesce("_lv", "_hv", F.lit(0.0)).alias("current_price"),
                    F.when(has_live, F.col("_ld")).otherwise(F.col("_hd")).alias("price_date"),
                    F.when(has_live, "live").when(F.col("_hv").isNotNull(), "historical").otherwise("none")
                    .alias("price_source")))


def compare_markets(prices: DataFrame, distances: DataFrame, current_price: Column,
                    cost_per_km: float = vocab.COST_PER_KM, default_km: float = vocab.DEFAULT_DISTANCE_KM) -> DataFrame:
    """Net price of each market after transport, and whether selling there gains over ``current_price``."""
    dist = F.coalesce("distance_km", F.lit(default_km))
    return (prices.join(distances.select("market", "distance_km"), "market", "left")
            .withColumn("distance_km", dist)
            .withColumn("transport_cost", F.col("distance_km") * cost_per_km)
            .withColumn("net_price", F.col("market_price") - F.col("transport_cost"))
            .withColumn("profit_margin", F.col("net_price") - current_price)
            .withColumn("profit_pct", F.try_divide(F.col("profit_margin"), current_price) * 100)
            .withColumn("profitable", F.col("profit_margin") > 0))


def _grams(text: Column) -> Column:
    """The distinct substrings of one to three characters, and the empty one."""
    parts = F.transform(F.sequence(F.lit(1), F.length(text)), lambda k: F.array(*[F.substr(text, k, F.lit(n)) for n in (1, 2, 3)]))
    return F.when(F.length(text) == 0, F.array(F.lit(""))).otherwise(F.array_distinct(F.concat(F.array(F.lit("")), F.flatten(parts))))


def _contained(inner: DataFrame, outer: DataFrame, frequency: DataFrame) -> DataFrame:
    """``inner, outer`` of all texts that lie in another one, by an equi-join on the rarest substring of each inner text.

    A text lies only in texts that have all its substrings of three characters (the whole text, if it is shorter), so it is
    looked up under one of these alone; ``contains`` has the last word.
    """
    keys = inner.select("inner", F.explode(F.filter(_grams(F.col("inner")), lambda g: F.length(g) == F.least(F.lit(3), F.length("inner")))).alias("gram"))
    keys = keys.join(frequency, "gram", "left").groupBy("inner").agg(F.min(F.struct(F.coalesce("n", F.lit(0)), "gram")).alias("k"))
    index = outer.select("outer", F.explode(_grams(F.col("outer"))).alias("gram"))
    met = keys.select("inner", F.col("k.gram").alias("gram")).join(index, "gram")
    return met.filter(F.contains("outer", "inner")).select("inner", "outer")


def resolve_synonym(df: DataFrame, col: str, aliases: DataFrame, out: str = "crop", alias: str = "alias", canonical: str = "crop",
                    rank: str = "rank") -> DataFrame:
    """Canonical name of a text: equal to an alias, else the first alias (by rank) contained in it or containing it.

    Only distinct texts are looked up, in an index of the aliases' substrings, so no text is compared with all aliases, however
    many they are. Every candidate is verified. A null text has no name.
    """
    entries = aliases.select(F.lower(F.col(alias)).alias("_alias"), F.col(rank).cast("int").alias("_rank"), F.col(canonical).alias("_canonical"))
    entries = entries.filter(F.col("_alias").isNotNull()).groupBy("_alias").agg(F.min(F.struct("_rank", "_canonical")).alias("_first"))
    names = df.select(F.lower(F.col(col)).alias("_low")).filter(F.col("_low").isNotNull()).distinct()
    frequency = entries.select(F.explode(_grams(F.col("_alias"))).alias("gram")).groupBy("gram").agg(F.count("*").alias("n"))
    side = lambda rows, c, name: rows.select(F.col(c).alias(name))
    within = _contained(side(entries, "_alias", "inner"), side(names, "_low", "outer"), frequency).select(
        F.col("outer").alias("_low"), F.col("inner").alias("_alias"))
    around = _contained(side(names, "_low", "inner"), side(entries, "_alias", "outer"), frequency).select(
        F.col("inner").alias("_low"), F.col("outer").alias("_alias"))
    order = F.struct((F.col("_low") != F.col("_alias")).alias("other"), "_first._rank", "_alias", "_first._canonical")
    found = within.unionByName(around).join(entries, "_alias").groupBy("_low").agg(F.min(order)["_canonical"].alias("_found"))
    return df.join(found, F.lower(F.col(col)) == F.col("_low"), "left").withColumn(out, F.col("_found")).drop("_low", "_found")


def suggest(unmapped: DataFrame, dim: DataFrame, raw: str, canonical: str) -> DataFrame:
    """A canonical name sharing the first three letters, the alphabetically first one."""
    start = lambda c: F.left(F.lower(c), F.lit(3))
    names = dim.groupBy(start(F.col(canonical)).alias("_start")).agg(F.min(canonical).alias("suggestion"))
    return (unmapped.select(raw).distinct().join(names, start(F.col(raw)) == F.col("_start"), "left").drop("_start"))


def build_dim(districts: DataFrame, aliases: DataFrame, coords: DataFrame, key: str = "canonical_district") -> DataFrame:
    """District dimension: all spellings joined by ``|`` and coordinates, 0.0 where unknown."""
    spelled = aliases.groupBy(F.col("canonical").alias(key)).agg(
        F.concat_ws("|", F.array_sort(F.collect_set("alias"))).alias("aliases"))
    return (districts.select(key).join(spelled, key, "left").join(coords, key, "left")
            .fillna({"aliases": "", "latitude": 0.0, "longitude": 0.0}))


def apply_codes(df: DataFrame, codes: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Integer codes of category values from a fitted code table (column, value, code); unseen values get -1."""
    for c in cols:
        side = codes.filter(F.col("column") == c).select(F.col("value").alias("_v"), F.col("code").alias("_code"))
        df = (df.join(side, F.col(c).cast("string") == F.col("_v"), "left")
              .withColumn(f"{c}_encoded", F.coalesce(F.col("_code"), F.lit(-1)).cast("int")).drop("_v", "_code"))
    return df
