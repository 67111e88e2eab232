"""Landed weather and record feeds as JSON text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import DataStreamReader

from harvestline.functions import dates as D, measures as M, text as T

# --- fixed values: weather parameters of the daily observation feed ---------------------------------------
PARAMETERS = ["PRECTOTCORR", "T2M", "T2M_MAX", "T2M_MIN", "RH2M"]
FORECAST_FIELDS = {"precipitation_sum": "double", "temperature_2m_max": "double", "temperature_2m_min": "double",
                   "windspeed_10m_max": "double", "precipitation_probability_max": "double", "weathercode": "double"}
RECORD = ("state string, district string, market string, commodity string, variety string, grade string, "
          "arrival_date string, min_price string, max_price string, modal_price string")


def parse_observations(df: DataFrame, body: str, keys: list[str], params: list[str] = PARAMETERS) -> DataFrame:
    """``{properties:{parameter:{NAME:{yyyymmdd:value}}}}`` documents to one row per day; -999 means missing."""
    schema = "struct<properties:struct<parameter:map<string,map<string,double>>>>"
    cells = (df.select(*keys, F.from_json(body, schema).alias("doc"))
             .select(*keys, F.explode("doc.properties.parameter").alias("param", "series"))
             .filter(F.col("param").isin(params))
             .select(*keys, "param", F.explode("series").alias("day", "value")))
    day = F.try_to_timestamp("day", F.lit("yyyyMMdd")).cast("date").alias("date")
    return (cells.select(*keys, day, "param", M.without_sentinel(F.col("value")).alias("value"))
            .groupBy(*keys, "date").pivot("param", params).agg(F.max("value")))


def parse_forecast(df: DataFrame, body: str, keys: list[str], fields: dict[str, str] = FORECAST_FIELDS) -> DataFrame:
    """``{daily:{time:[...], field:[...]}}`` documents to one row per day."""
    inner = ",".join(["time:array<string>", *[f"{f}:array<{t}>" for f, t in fields.items()]])
    doc = df.select(*keys, F.from_json(body, f"struct<daily:struct<{inner}>>").alias("doc"))
    # A field that a document lacks is an empty list: zipping pads it, while a null list would drop every day.
    lists = [F.coalesce(F.col(f"doc.daily.{f}"), F.array().cast(f"array<{t}>")).alias(f) for f, t in fields.items()]
    zipped = F.arrays_zip(F.col("doc.daily.time").alias("time"), *lists)
    rows = doc.select(*keys, F.explode(zipped).alias("d"))
    return rows.select(*keys, F.col("d.time").try_cast("date").alias("date"), *[F.col(f"d.{f}") for f in fields])


def _pages(df: DataFrame, body: str, record: str) -> DataFrame:
    kind = f"total long, records array<struct<{_as_struct(record)}>>"
    return df.withColumn("doc", F.from_json(body, f"{kind}, _bad string", {"columnNameOfCorruptRecord": "_bad"}))


def explode_pages(df: DataFrame, body: str, record: str = RECORD) -> DataFrame:
    """Pages ``{total, records:[...]}`` to records; what ``unusable_pages`` returns has none."""
    return _pages(df, body, record).select(F.explode("doc.records").alias("r")).select("r.*")


def unusable_pages(df: DataFrame, body: str, record: str = RECORD) -> DataFrame:
    """The pages that give no records, with a reason: no body, no valid document, or a document without a list."""
    reason = (F.when(F.col(body).isNull(), "empty").when(F.col("doc._bad").isNotNull(), "malformed")
              .when(F.col("doc.records").isNull(), "without records"))
    return _pages(df, body, record).withColumn("reason", reason).filter(F.col("reason").isNotNull()).drop("doc")


def _as_struct(ddl: str) -> str:
    return ",".join(":".join(part.split()) for part in ddl.split(","))


def feed_records(records: DataFrame, scope: str) -> DataFrame:
    """Records of the live feed typed and cut to the scope; the market keeps its original spelling beside it."""
    inside = T.same_text(F.col("state"), scope)
    return (records.filter(inside).withColumns({
        "state": F.lit(scope),
        "market_original": F.col("market"),
        "market": T.market_name(F.col("market")),
        "arrival_date": D.try_format(F.trim("arrival_date"), "d/M/yyyy").cast("date"),
        **{c: M.number(F.col(c)) for c in ("min_price", "max_price", "modal_price")},
    }))


def scope_sample(records: DataFrame, scope: Column, top: int = 5) -> DataFrame:
    """How many records lie outside the scope, by state, the most frequent first."""
    outside = records.filter(~F.coalesce(scope, F.lit(False)))
    return outside.groupBy("state").agg(F.count(F.lit(1)).alias("rows")).orderBy(
        F.desc("rows"), F.col("state").asc_nulls_last()).limit(top)


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path, wholetext=True)


def stream_pages(spark: SparkSession, path: str) -> DataFrame:
    reader: DataStreamReader = spark.readStream
    return reader.text(path, wholetext=True)
