"""The readmission model as a stored mart: fitted, calibrated and measured apart from
scoring.

Patients are split by a hash, so that one patient's stays are in one part: the
pipeline is fitted on the first, its margins are calibrated on the second and its
quality is measured on the third.  The fitted pipeline, the calibration and the
metrics are stored; the metrics come last and mark the model as whole.
"""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardline.operators.readmit import KEY, risk_band
from wardline.streaming.keyed import exists

NUMBERS = ["age_at_admit", "length_of_stay_days", "prior_admission_count", "condition_count", "medication_count", "total_claim_cost"]
#: Shares of the patients (in percent) that fit the pipeline and calibrate it.
FIT, CALIBRATE = 70, 15


def _prepared(features: DataFrame) -> DataFrame:
    part = F.pmod(F.xxhash64(F.lit(5), KEY), F.lit(100))
    return features.fillna({"gender": "?", "marital": "?"}).withColumns({"label": F.col("readmitted_30d").cast("double"), "part": part})


def _margin(model: PipelineModel, rows: DataFrame) -> DataFrame:
    raw = vector_to_array(F.col("rawPrediction"))[1]
    return VectorAssembler(inputCols=["margin"], outputCol="m").transform(model.transform(rows).withColumn("margin", raw))


def fitted(spark: SparkSession, path: str) -> bool:
    return exists(spark, f"{path}/metrics/_SUCCESS")


def fit(features: DataFrame, path: str, max_iter: int = 20) -> None:
    """Fit, calibrate and measure on ``training_features``; store all under ``path``."""
    rows = _prepared(features).where("label is not null")
    first, second, third = (rows.where(F.col("part").between(a, b - 1)) for a, b in ((0, FIT), (FIT, FIT + CALIBRATE), (FIT + CALIBRATE, 100)))
    stages = [StringIndexer(inputCols=["gender", "marital"], outputCols=["_gi", "_mi"], handleInvalid="keep"),
              OneHotEncoder(inputCols=["_gi", "_mi"], outputCols=["_go", "_mo"]),
              VectorAssembler(inputCols=[*NUMBERS, "_go", "_mo"], outputCol="features", handleInvalid="keep"),
              LogisticRegression(maxIter=max_iter, regParam=0.01)]
    model = Pipeline(stages=stages).fit(first)
    model.write().overwrite().save(f"{path}/pipeline")
    curve = LogisticRegression(featuresCol="m", predictionCol="p", probabilityCol="q", rawPredictionCol="r").fit(_margin(model, second).select("m", "label"))
    curve.write().overwrite().save(f"{path}/calibration")
    tested = _margin(model, third)
    auc = BinaryClassificationEvaluator(rawPredictionCol="margin").evaluate(tested)
    counts = rows.agg(F.count_if(F.col("part") < FIT).alias("fitted"), F.count_if(F.col("part").between(FIT, FIT + CALIBRATE - 1)).alias("calibrated"),
                      F.count_if(F.col("part") >= FIT + CALIBRATE).alias("tested"), F.avg("label").alias("rate"))
    counts.withColumn("auc", F.lit(float(auc))).coalesce(1).write.mode("overwrite").parquet(f"{path}/metrics")


def metrics(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(f"{path}/metrics")


def score(features: DataFrame, path: str) -> DataFrame:
    """Every stay with its calibrated probability, percentage and band, by the stored
    model; nothing is fitted here."""
    rows = _margin(PipelineModel.load(f"{path}/pipeline"), _prepared(features))
    scored = LogisticRegressionModel.load(f"{path}/calibration").transform(rows)
    out = scored.select("encounter_id", KEY, vector_to_array(F.col("q"))[1].alias("readmit_probability"))
    pct = F.round(F.col("readmit_probability") * 100, 1)
    return out.withColumn("risk_pct", pct).withColumn("risk_level", risk_band(F.col("risk_pct")))
