"""Crop risk by configured rules, and the decisions taken from it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from harvestline import vocab
from harvestline.operators import joins as J
from harvestline.operators.windows import forecast_stats

THRESHOLDS = ["threshold_rainfall_7d", "threshold_rainfall_7d_min", "threshold_temp_max", "threshold_temp_min",
              "threshold_humidity"]


def _checks(w: Column) -> list[tuple[Column, float, Column]]:
    """(condition, points, text) of every threshold a window may set."""
    rain, hi, lo, rh = (F.col(c) for c in ("rainfall_7d", "temp_max", "temp_min", "humidity"))
    name = w["risk_factor"]
    say = lambda pattern, value: F.concat(name, F.format_string(pattern, value))
    return [
        (rain > w["threshold_rainfall_7d"], 30.0, say(": excess rainfall (%.0fmm)", rain)),
        (rain < w["threshold_rainfall_7d_min"], 30.0, say(": low rainfall (%.0fmm)", rain)),
        (hi > w["threshold_temp_max"], 25.0, say(": high temp (%.1f°C)", hi)),
        (lo < w["threshold_temp_min"], 25.0, say(": low temp (%.1f°C)", lo)),
        (rh > w["threshold_humidity"], 20.0, say(": high humidity (%.0f%%)", rh)),
    ]


def _weight(severity: Column) -> Column:
    out = F.lit(vocab.SEVERITY_WEIGHT["medium"])
    for name, weight in vocab.SEVERITY_WEIGHT.items():
        out = F.when(severity == name, weight).otherwise(out)
    return out


def rule_score(df: DataFrame, windows: DataFrame, crops: DataFrame) -> DataFrame:
    """Add ``rule_score`` (0..100) and ``risk_factors`` to rows of (crop, stage, weather statistics).

    The windows of a crop stage travel as one short array from the rule table, so the samples are neither multiplied
    nor grouped again.
    """
    fields = ["risk_factor", "severity", *THRESHOLDS]
    packed = windows.groupBy(F.col("crop").alias("_wc"), F.col("stage").alias("_ws")).agg(
        F.array_sort(F.collect_list(F.struct("rank", *fields))).alias("_windows"))
    optimum = crops.select(F.col("crop").alias("_oc"), F.col("temp_optimal").alias("_opt"))
    joined = (df.join(packed, (F.col("crop") == F.col("_wc")) & (F.col("stage") == F.col("_ws")), "left")
              .join(optimum, F.col("crop") == F.col("_oc"), "left"))

    def hits(w: Column) -> Column:
        return F.array_compact(F.array(*[
            F.when(cond, F.struct((points * _weight(w["severity"])).alias("points"), text.alias("text")))
            for cond, points, text in _checks(w)]))

    found = F.coalesce(F.flatten(F.transform("_windows", hits)),
                       F.array().cast("array<struct<points:double,text:string>>"))
    away = F.abs(F.col("temp_mean") - F.col("_opt"))
    extra = F.when(away > 8, 15.0).when(away > 5, 8.0).otherwise(0.0)
    warning = F.array_compact(F.array(F.when(away > 8, F.format_string(
        "Temperature deviation: %.1f°C from optimal", away))))
    scored = joined.withColumn("_hits", found)
    total = F.aggregate("_hits", F.lit(0.0), lambda acc, h: acc + h["points"]) + extra
    return scored.withColumns({
        "rule_score": F.least(total, F.lit(100.0)),
        "risk_factors": F.concat(F.transform("_hits", lambda h: h["text"]), warning),
    }).drop("_wc", "_ws", "_oc", "_opt", "_windows", "_hits")


def hash_uniform(seed: int, *cols: Column) -> Column:
    """A number in [0, 1) fixed by its keys, so a recomputed task draws the same one: the first 52 bits of the MD5 of the seed and
    the keys as text, which any engine can draw again."""
    text = F.concat_ws("|", F.lit(str(seed)), *[c.cast("string") for c in cols])
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


def hash_normal(seed: int, sd: float, *cols: Column) -> Column:
    u, v = hash_uniform(seed, *cols), hash_uniform(seed + 1, *cols)
    return F.sqrt(-2 * F.log(1 - u)) * F.cos(2 * F.pi() * v) * sd


def risk_label(score: Column, critical: Column, low_max: float = 25.0, medium_max: float = 50.0,
               noise: Column | None = None) -> Column:
    """0 low, 1 medium, 2 high; a critical stage raises the score by a quarter."""
    adjusted = score * F.when(critical, 1.25).otherwise(1.0)
    adjusted = adjusted + noise if noise is not None else adjusted
    return F.when(adjusted < low_max, 0).when(adjusted < medium_max, 1).otherwise(2)


def training_samples(weather: DataFrame, rules: dict[str, DataFrame], samples_per_crop: int = 6000, seed: int = 42,
                     noise_sd: float = 12.0) -> DataFrame:
    """Labelled samples: crop, year, sowing day and district drawn per sample, one row per growth stage.

    ``weather`` is the weather feature table. Draws come from hashed sample keys, so they do not depend on partitions.
    """
    span = weather.agg(F.min(F.year("date")).alias("a"), F.max(F.year("date")).alias("b"),
                       F.countDistinct(F.year("date")).alias("n"),
                       F.array_sort(F.collect_set("district")).alias("districts"))
    known = span.select(F.struct("a", "b", "n", "districts")).scalar()
    crops = rules["crops"].withColumn("_known", known)
    per_year = F.greatest(F.lit(1), F.floor(F.lit(samples_per_crop) / F.greatest(F.lit(1), F.col("_known.n") - 2)))
    draws = (crops.filter(F.col("_known.b") - F.col("_known.a") >= 2)
             .withColumn("year", F.explode(F.sequence(F.col("_known.a") + 1, F.col("_known.b") - 1)))
             .repartition("crop", "year")  # the rules are one partition; the samples of a crop and year are drawn in one task
             .withColumn("sample", F.explode(F.sequence(F.lit(1).cast("long"), per_year))))
    ids = [F.col("crop"), F.col("year"), F.col("sample")]
    pick = lambda k, n, *more: F.floor(hash_uniform(seed + k, *ids, *more) * n).cast("int")
    sown = draws.withColumns({
        "sowing_month": F.col("start_month") + pick(10, F.col("end_month") - F.col("start_month") + 1),
        "_day": 1 + pick(20, F.lit(27)),
        "district": F.get("_known.districts", pick(30, F.size("_known.districts"))),
    }).withColumn("sowing_date", F.make_date("year", "sowing_month", "_day")).drop("_known", "_day", "aliases")
    staged = sown.join(rules["stages"].drop("rank"), "crop")
    length = F.col("end_day") - F.col("start_day") + 1
    dated = (staged.withColumn("days_since_sowing", F.col("start_day") + pick(40, length, F.col("stage")))
             .withColumn("date", F.date_add("sowing_date", F.col("days_since_sowing"))))
    looked = J.lookup_first(dated, weather.select("district", "date", *_stat_columns().values()),
                            ["district", "date"], ["rainfall_7d"])
    stats = looked.withColumnsRenamed({old: new for new, old in _stat_columns().items()})
    scored = rule_score(stats, rules["windows"], rules["crops"])
    noise = hash_normal(seed + 50, noise_sd, *ids, F.col("stage")) if noise_sd else None
    return scored.select(
        "crop", "district", "stage", F.col("critical").cast("int").alias("is_critical_stage"), "days_since_sowing",
        (F.col("days_since_sowing") / F.col("total_duration_days")).alias("stage_progress"), "sowing_month",
        F.month("date").alias("current_month"), F.col("date").alias("current_date"),
        *vocab.WEATHER_STATS, "rule_score",
        risk_label(F.col("rule_score"), F.col("critical"), noise=noise).alias("risk_level")).dropna()


def _stat_columns() -> dict[str, str]:
    """Statistic name -> column of the weather feature table."""
    renamed = {"rainfall_max_day": "rainfall_max_day_7d", "temp_max": "temp_max_7d", "temp_min": "temp_min_7d",
               "temp_mean": "temp_mean_7d", "temp_range": "temp_range_7d", "temp_std": "temp_std_7d",
               "humidity": "humidity_7d", "humidity_max": "humidity_max_7d"}
    return {s: renamed.get(s, s) for s in vocab.WEATHER_STATS}


def soil_score(df: DataFrame, ph_min: float = 5.5, ph_max: float = 8.0, nitrogen_min: float = 200.0,
               phosphorus_min: float = 15.0) -> DataFrame:
    """Points and texts for acidity and scarce nutrients; an unmeasured value counts as good."""
    ph = F.coalesce("ph", F.lit(7.0))
    n, p = F.coalesce("nitrogen_kg_ha", F.lit(300.0)), F.coalesce("phosphorus_kg_ha", F.lit(300.0))
    acid, alkaline, low_n, low_p = ph < ph_min, ph > ph_max, n < nitrogen_min, p < phosphorus_min
    return df.withColumns({
        "soil_score": (F.when(acid | alkaline, 20).otherwise(0) + F.when(low_n, 10).otherwise(0)
                       + F.when(low_p, 10).otherwise(0)),
        "soil_factors": F.array_compact(F.array(
            F.when(acid, F.concat(F.lit("Soil too acidic (pH="), ph.cast("string"), F.lit(")"))),
            F.when(alkaline, F.concat(F.lit("Soil too alkaline (pH="), ph.cast("string"), F.lit(")"))),
            F.when(low_n, F.concat(F.lit("Low nitrogen ("), n.cast("string"), F.lit(" kg/ha)"))),
            F.when(low_p, F.concat(F.lit("Low phosphorus ("), p.cast("string"), F.lit(" kg/ha)"))))),
    })


def hybrid_decision(df: DataFrame, rule: str = "rule_score", model: str = "ml_risk",
                    soil: str | None = None) -> DataFrame:
    """Rules overrule the model at the extremes; poor soil raises the level by one."""
    score, guess = F.col(rule), F.col(model)
    level = F.when(score > 80, 2).when((score < 15) & (guess == 2), 1).otherwise(guess)
    if soil:
        level = F.when((F.col(soil) > 30) & (level < 2), level + 1).otherwise(level)
    why = (F.when(score > 80, "Rule override: Critical risk factors detected")
           .when((score < 15) & (guess == 2), "Hybrid adjustment: ML moderated by favorable conditions"))
    label = F.element_at(F.create_map(*[F.lit(x) for kv in vocab.RISK_LABEL.items() for x in kv]), level)
    return df.withColumns({"risk_level_code": level, "risk_level": label, "override_reason": why})


# --- fixed values: advice texts ----------------------------------------------------------------------------
ADVICE = {
    "high": "⚠️ HIGH ALERT: Take protective measures immediately",
    "drain_field": "🌧️ Ensure field drainage; delay fertilizer application",
    "mulch": "☀️ Apply mulching; increase irrigation frequency",
    "channels": "🌊 Create drainage channels immediately",
    "irrigate": "💧 Arrange emergency irrigation if possible",
    "moderate": "⚡ MODERATE ALERT: Monitor conditions closely",
    "updates": "📱 Check weather updates daily",
    "peak_heat": "🌡️ Consider protective irrigation during peak heat",
    "favorable": "✅ Conditions favorable - maintain regular practices",
    "calendar": "📋 Follow standard crop calendar recommendations",
}


def recommendations(level: Column, factors: Column, rain_7d: Column, temp_max: Column, hot_days: Column) -> Column:
    """Advice for a risk level, its factors and the weather behind it."""
    mentions = lambda word: F.exists(factors, lambda f: F.contains(F.lower(f), F.lit(word)))
    high, medium, low = level == 2, level == 1, level == 0
    cases = [
        (high, "high"), (high & (rain_7d > 100), "drain_field"), (high & (temp_max > 38), "mulch"),
        (high & mentions("waterlogging"), "channels"), (high & mentions("drought"), "irrigate"),
        (medium, "moderate"), (medium, "updates"), (medium & (hot_days > 3), "peak_heat"),
        (low, "favorable"), (low, "calendar"),
    ]
    return F.array_compact(F.array(*[F.when(cond, F.lit(ADVICE[name])) for cond, name in cases]))


def assess(requests: DataFrame, forecast: DataFrame, rules: dict[str, DataFrame], model=None,
           soil_cols: Sequence[str] = ("ph", "nitrogen_kg_ha", "phosphorus_kg_ha"), start: str | None = None) -> DataFrame:
    """Risk of every request (crop text, district, sowing_date, as_of) in one job; unusable requests carry ``error``.
    The forecast counts from ``start`` on.

    ``model`` is a fitted model with a ``transform`` adding ``ml_risk`` and ``ml_probabilities``; without one the
    middle class and equal probabilities stand in.
    """
    asked = requests.withColumnRenamed("crop", "requested_crop")
    named = J.resolve_synonym(asked, "requested_crop", rules["aliases"], out="crop")
    timed = named.withColumn("days_since_sowing", F.datediff("as_of", "sowing_date"))
    error = (F.when(F.col("days_since_sowing") < 0, "Sowing date is in the future")
             .when(F.col("crop").isNull(), F.concat(F.lit("Unknown crop: "), F.col("requested_crop"))))
    about = rules["crops"].select(F.col("crop").alias("_c"), "crop_type", "total_duration_days")
    staged = (J.stage_of(timed.withColumn("error", error), rules["stages"])
              .join(about, F.col("crop") == F.col("_c"), "left").drop("_c"))
    stats = forecast_stats(forecast, start=start)
    first = stats.agg(F.min("district").alias("d")).scalar()
    known = staged.join(stats.select(F.col("district").alias("_known")), F.col("district") == F.col("_known"), "left")
    placed = (known.withColumn("_place", F.coalesce(F.col("_known"), first)).drop("_known")
              .join(stats.withColumnRenamed("district", "_place"), "_place", "left").drop("_place"))
    scored = rule_score(placed, rules["windows"], rules["crops"]).withColumns({
        "is_critical_stage": F.col("critical").cast("int"),
        "stage_progress": F.least(F.try_divide("days_since_sowing", "total_duration_days"), F.lit(1.0)),
        "sowing_month": F.month("sowing_date"), "current_month": F.month("as_of"),
    })
    if model is None:
        scored = scored.withColumns({"ml_risk": F.lit(1), "ml_probabilities": F.array(*map(F.lit, (0.33, 0.33, 0.34)))})
    else:
        scored = model.transform(scored)
    soil = all(c in scored.columns for c in soil_cols)
    scored = soil_score(scored) if soil else scored.withColumns(
        {"soil_score": F.lit(0), "soil_factors": F.array().cast("array<string>")})
    decided = hybrid_decision(scored, soil="soil_score" if soil else None)
    advice = recommendations(F.col("risk_level_code"), F.col("risk_factors"), F.col("rainfall_7d"),
                             F.col("temp_max"), F.col("hot_days_7d"))
    ok = F.col("error").isNull()
    keep = lambda c, name: F.when(ok, c).alias(name)
    proba = F.col("ml_probabilities")
    return decided.withColumn("recommendations", advice).select(
        *requests.drop("crop").columns, "requested_crop", "error", keep(F.col("crop"), "crop"),
        keep(F.col("crop_type"), "crop_type"), "days_since_sowing", keep(F.col("stage"), "current_stage"),
        keep(F.col("is_critical_stage"), "is_critical_stage"), keep(F.col("stage_progress"), "stage_progress"),
        keep(F.col("risk_level"), "risk_level"), keep(F.col("risk_level_code"), "risk_level_code"),
        keep(F.round("rule_score", 1), "rule_based_score"),
        keep(F.struct(*[F.round(proba[i], 3).alias(n) for i, n in enumerate(("low", "medium", "high"))]),
             "ml_probabilities"),
        keep(F.col("override_reason"), "override_reason"), keep(F.col("risk_factors"), "risk_factors"),
        keep(F.col("soil_factors"), "soil_risk_factors"),
        keep(F.struct(*vocab.WEATHER_STATS), "weather_summary"), keep(F.col("recommendations"), "recommendations"))
