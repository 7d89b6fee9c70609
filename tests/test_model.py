"""The stored readmission model: scoring reads it, its figures are in bounds."""

import os

from pyspark.sql import functions as F

from wardline.operators import model
from wardline.plans import q_readmit

SF = "/root/testdata/sf0.01"


def test_model_mart(spark, tmp_dir):
    feats = q_readmit.features(spark, SF).checkpoint()
    path = os.path.join(tmp_dir, "model")
    assert not model.fitted(spark, path)
    model.fit(feats, path)
    assert model.fitted(spark, path)
    m = model.metrics(spark, path).first()
    assert m["fitted"] + m["calibrated"] + m["tested"] == feats.count() and min(m["fitted"], m["calibrated"], m["tested"]) > 0
    assert 0.4 <= m["auc"] <= 1
    # scoring takes unlabelled and unknown rows, and fits nothing
    out = model.score(feats.withColumn("readmitted_30d", F.lit(None).cast("int")), path)
    assert out.count() == feats.count()
    p = out.agg(F.min("readmit_probability").alias("a"), F.max("readmit_probability").alias("b"), F.avg("readmit_probability").alias("mean")).first()
    assert 0 <= p["a"] <= p["b"] <= 1 and abs(p["mean"] - m["rate"]) < 0.1
    again = model.score(feats, path).join(out.select("encounter_id", F.col("readmit_probability").alias("q")), "encounter_id")
    assert again.where("abs(readmit_probability - q) > 1e-12").count() == 0
