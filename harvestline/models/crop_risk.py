"""Three-class crop risk classifier with Spark ML."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, functions as F

from harvestline import vocab
from harvestline.operators import profile as P
from harvestline.operators.encode import time_folds
from harvestline.operators.shape import ordered_split

CATEGORIES = ["crop", "district", "stage"]
NUMBERS = ["is_critical_stage", "days_since_sowing", "stage_progress", "sowing_month", "current_month",
           *vocab.WEATHER_STATS]


def with_weights(df: DataFrame, label: str = "risk_level", weights: dict[int, float] = vocab.CLASS_WEIGHT) -> DataFrame:
    weight = F.lit(1.0)
    for k, v in weights.items():
        weight = F.when(F.col(label) == k, v).otherwise(weight)
    return df.withColumn("class_weight", weight)


def default_classifier() -> RandomForestClassifier:
    return RandomForestClassifier(featuresCol="features", labelCol="risk_level", weightCol="class_weight",
                                  predictionCol="ml_risk_raw", probabilityCol="ml_proba", maxDepth=8, numTrees=100,
                                  maxBins=64, seed=42)


def stages(classifier) -> Pipeline:
    index = StringIndexer(inputCols=CATEGORIES, outputCols=[f"{c}_code" for c in CATEGORIES],
                          stringOrderType="alphabetAsc", handleInvalid="keep")
    vector = VectorAssembler(inputCols=[*[f"{c}_code" for c in CATEGORIES], *NUMBERS], outputCol="features",
                             handleInvalid="skip")
    return Pipeline(stages=[index, vector, classifier])


def train(samples: DataFrame, classifier=None) -> tuple["RiskModel", DataFrame]:
    """Fit on the earliest 80 % of the samples; the rest comes back scored as (y, yhat)."""
    parts = with_weights(ordered_split(samples, "current_date", ["crop", "district", "stage", "days_since_sowing"]))
    fitted = stages(classifier or default_classifier()).fit(parts.filter(F.col("part") == "train"))
    model = RiskModel(fitted)
    scored = model.transform(parts.filter(F.col("part") == "test"))
    return model, scored.select(F.col("risk_level").alias("y"), F.col("ml_risk").alias("yhat"))


def cross_validate(samples: DataFrame, classifier=None, k: int = 5) -> DataFrame:
    """Accuracy and macro F1 of every expanding fold."""
    folds = with_weights(time_folds(samples, "current_date", ["crop", "district", "stage", "days_since_sowing"], k))
    out = None
    for i in range(1, k + 1):
        fitted = stages(classifier or default_classifier()).fit(folds.filter(F.col("fold") < i))
        scored = RiskModel(fitted).transform(folds.filter(F.col("fold") == i))
        part = P.classification_metrics(scored, "risk_level", "ml_risk").select(
            F.lit(i).alias("fold"), "accuracy", "f1_macro")
        out = part if out is None else out.unionByName(part)
    return out


class RiskModel:
    """A fitted model that adds ``ml_risk`` and ``ml_probabilities``."""

    def __init__(self, fitted: PipelineModel):
        self.fitted = fitted

    def transform(self, df: DataFrame) -> DataFrame:
        """Rows with a missing statistic get the stand-in prediction and stay in the table."""
        ready = F.lit(True)
        for c in NUMBERS:
            ready = ready & F.col(c).isNotNull()
        usable = df.filter(ready & F.col("crop").isNotNull())
        other = df.filter(~(ready & F.col("crop").isNotNull()))
        scored = self.fitted.transform(usable).select(
            *df.columns, F.col("ml_risk_raw").cast("int").alias("ml_risk"),
            vector_to_array("ml_proba").alias("ml_probabilities"))
        return scored.unionByName(other.withColumns({
            "ml_risk": F.lit(1), "ml_probabilities": F.array(*map(F.lit, (0.33, 0.33, 0.34)))}))

    def save(self, path: str) -> None:
        self.fitted.write().overwrite().save(path)

    @staticmethod
    def load(path: str) -> "RiskModel":
        return RiskModel(PipelineModel.load(path))


def importance(spark, fitted: PipelineModel, names: list[str]) -> DataFrame:
    """Feature importance with its share of the total, one row per feature."""
    values = fitted.stages[-1].featureImportances.toArray()
    table = spark.createDataFrame([(n, float(v)) for n, v in zip(names, values)], "feature string, importance double")
    return P.share(table, "importance")
