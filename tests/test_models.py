"""Fitted models against plain DataFrame and numpy recomputation."""

import numpy as np
import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from cartwheel.operators import features as FE
from cartwheel.operators import metrics as M
from cartwheel.operators import models as MD
from cartwheel.session import cut_lineage, scratch_path
from cartwheel.sources import fixtures as FXS

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def matrix(spark):
    return cut_lineage(FE.train_matrix(*[FXS.load(spark, SF, t) for t in ("fx_orders", "fx_prior", "fx_trains")]))


@pytest.fixture(scope="module")
def fitted(matrix):
    return MD.logistic_regression(matrix, MD.FORMULA_7, train_pct=70)


def test_lr_probability_is_the_logistic_of_its_terms(fitted, matrix):
    model, pred = fitted
    terms = [t.strip() for t in MD.FORMULA_7.split("~")[1].split("+")]
    z = sum((F.col(t).cast("double") * float(w) for t, w in zip(terms, model.coefficients)), F.lit(float(model.intercept)))
    both = pred.join(matrix.select("user_id", "product_id", (1 / (1 + F.exp(-z))).alias("p")), ["user_id", "product_id"])
    assert both.count() == pred.count() > 100
    assert both.filter((F.abs(F.col("p") - F.col("p1")) > 1e-9) | (F.col("prediction") != (F.col("p") > 0.5).cast("int"))).count() == 0


def test_lr_loss_falls_and_auc_is_ours(fitted):
    model, _ = fitted
    loss = model.summary.objectiveHistory
    assert loss[-1] < loss[0] and all(b <= a + 1e-12 for a, b in zip(loss, loss[1:]))
    scored = model.summary.predictions.select(F.col("label_d").alias("label"), vector_to_array("probability")[1].alias("score"))
    assert abs(M.auc(scored).first()["auc"] - model.summary.areaUnderROC) < 2e-3      # Spark's curve is binned


def test_kmeans_assigns_the_nearest_centre_and_sums_the_cost(spark):
    feats = MD.text_features(FXS.load(spark, SF, "fx_docs"), "sentence", min_doc_freq=2, min_len=2).select("doc_id", "features")
    model = MD.fit(MD.kmeans_estimator(k=4), feats)
    centres = np.array(model.clusterCenters())
    cost = 0.0
    for r in model.transform(feats).collect():
        v = r["features"]
        d = (centres ** 2).sum(axis=1) - 2 * centres[:, v.indices] @ v.values + (v.values ** 2).sum()
        assert d[r["pred"]] <= d.min() + 1e-6 * abs(d.min())
        cost += d[r["pred"]]
    assert abs(cost - model.summary.trainingCost) < 1e-6 * cost


def test_svm_margin_is_the_weights_times_the_features(matrix):
    from pyspark.ml.feature import VectorAssembler
    data = VectorAssembler(inputCols=MD.MODEL_FEATURES, outputCol="features").transform(
        matrix.withColumn("label", F.col("label").cast("double"))).select("label", "features")
    est = MD.svm_estimator(5)
    assert (est.getRegParam(), est.getFitIntercept(), est.getStandardization()) == (0.01, False, False)
    model = MD.fit(est, data)
    assert model.intercept == 0
    for r in model.transform(data).limit(200).collect():
        assert abs(r["rawPrediction"][1] - float(np.dot(model.coefficients.toArray(), r["features"].toArray()))) < 1e-9


def test_loaded_model_equals_the_fitted_one(spark):
    docs = MD.tokens
    d = FXS.load(spark, SF, "fx_docs").select("doc_id", "label", docs("sentence").alias("seg"))
    train, test = MD.split(d, "doc_id", 80)
    model = Pipeline(stages=MD.nb_stages()).fit(train)
    path = scratch_path(spark, "nb")
    model.write().save(path)
    keep = ["doc_id", "label_index", "prediction", vector_to_array("probability").alias("p")]
    a, b = (m.transform(test).select(*keep) for m in (model, PipelineModel.load(path)))
    assert a.count() > 0 and a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
