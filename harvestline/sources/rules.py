"""Crop rules: one nested JSON document to flat rule tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

_WINDOW = ("struct<stage:string,risk_factor:string,severity:string,threshold_rainfall_7d:double,"
           "threshold_rainfall_7d_min:double,threshold_temp_max:double,threshold_temp_min:double,"
           "threshold_humidity:double>")
_CROP = ("struct<aliases:array<string>,crop_type:string,total_duration_days:int,"
         "sowing_window:struct<start_month:int,end_month:int>,optimal_conditions:struct<temp_optimal:double>,"
         "stages:array<struct<name:string,start_day:int,end_day:int,critical:boolean>>,"
         f"sensitive_windows:array<{_WINDOW}>>")
SCHEMA = ("risk_classification struct<low_max:double,medium_max:double>, "
          "soil_thresholds struct<ph_min:double,ph_max:double,nitrogen_min_kg_ha:double,"
          "phosphorus_min_kg_ha:double,potassium_min_kg_ha:double>, "
          f"crops map<string,{_CROP}>")


def load_rules(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """Tables ``crops``, ``stages``, ``windows``, ``aliases`` and the one-row ``thresholds``."""
    return flatten_rules(spark.read.schema(SCHEMA).json(path, multiLine=True))


def flatten_rules(doc: DataFrame) -> dict[str, DataFrame]:
    crops = doc.select(F.posexplode(F.map_entries("crops")).alias("rank", "e")).select(
        "rank", F.col("e.key").alias("crop"), F.col("e.value").alias("spec"))
    # Exact spellings rank in document order: per crop its own name, then its aliases.
    spelled = crops.select("rank", "crop", F.posexplode(
        F.concat(F.array("crop"), F.coalesce("spec.aliases", F.array().cast("array<string>")))).alias("_p", "alias"))
    return {
        "crops": crops.select("rank", "crop", "spec.crop_type", "spec.total_duration_days",
                              "spec.sowing_window.start_month", "spec.sowing_window.end_month",
                              "spec.optimal_conditions.temp_optimal", "spec.aliases"),
        "stages": crops.select("crop", F.posexplode("spec.stages").alias("rank", "s")).select(
            "crop", "rank", F.col("s.name").alias("stage"), "s.start_day", "s.end_day", "s.critical"),
        "windows": crops.select("crop", F.posexplode("spec.sensitive_windows").alias("rank", "w")).select(
            "crop", "rank", "w.*"),
        "aliases": spelled.select(F.lower("alias").alias("alias"), "crop",
                                  (F.col("rank") * 1000 + F.col("_p")).alias("rank")),
        "thresholds": doc.select("risk_classification.*", "soil_thresholds.*"),
    }
