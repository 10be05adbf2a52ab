"""Catalog: pyspark.ml model jobs (rows-only checks: fitted models are not
expressible in SQL; their relational counterparts are checked exactly)."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array

from ..operators import features as FE
from ..operators import models as MD
from ..session import scratch_path
from ..sources import fixtures as FXS
from .common import round_doubles
from .registry import query


def _matrix(spark, sf):
    return FE.train_matrix(FXS.load(spark, sf, "fx_orders"), FXS.load(spark, sf, "fx_prior"), FXS.load(spark, sf, "fx_trains"))


@query("lr_reorder_predict", ops=("C4", "C6"))
def q_lr_reorder_predict(spark, sf):
    _, pred = MD.logistic_regression(_matrix(spark, sf), MD.FORMULA_7, train_pct=70)
    return round_doubles(pred)


@query("lr_full_predict", ops=("C4", "C6"))
def q_lr_full_predict(spark, sf):
    """The 13-term formula on the full matrix (order context + cross features)."""
    m = FE.train_matrix_full(FXS.load(spark, sf, "fx_orders"), FXS.load(spark, sf, "fx_prior"), FXS.load(spark, sf, "fx_trains"))
    _, pred = MD.logistic_regression(m, MD.FORMULA_13, train_pct=70)
    return round_doubles(pred)


@query("kmeans_assign", ops=("E5",))
def q_kmeans_assign(spark, sf):
    assign, _ = MD.kmeans_assign(FXS.load(spark, sf, "fx_docs"))
    return assign


@query("model_roundtrip", ops=("K12",))
def q_model_roundtrip(spark, sf):
    return MD.model_roundtrip(spark, FXS.load(spark, sf, "fx_docs"), scratch_path(spark, "nb_model"))


def _libsvm_sql() -> str:
    from .registry import REGISTRY
    from . import features  # noqa: F401  (registers train_matrix)
    cols = ", ".join(f"round(CAST({c} AS DOUBLE), 6) AS {c}" for c in MD.MODEL_FEATURES)
    return f"SELECT CAST(label AS DOUBLE) AS label, {cols} FROM ({REGISTRY['train_matrix'].sql}) m"


@query("libsvm_roundtrip", ops=("S7",), sql=_libsvm_sql())
def q_libsvm_roundtrip(spark, sf):
    """The training matrix written as libsvm text and loaded back: label and
    the seven feature values (zeros are implicit in the sparse format)."""
    path = scratch_path(spark, "svm_txt")
    MD.libsvm_write(_matrix(spark, sf), path, MD.MODEL_FEATURES)
    d = MD.libsvm_read(spark, path, len(MD.MODEL_FEATURES))
    arr = vector_to_array("features")
    return round_doubles(d.select("label", *[arr[i].alias(c) for i, c in enumerate(MD.MODEL_FEATURES)]))


def _scored_sql() -> str:
    from .registry import REGISTRY
    bucket = "CAST('0x' || substr(md5(user_id || '_' || product_id), 1, 8) AS BIGINT) % 100"
    return f"SELECT user_id, product_id, label FROM ({REGISTRY['train_matrix'].sql}) m WHERE {bucket} >= 70"


@query("lr_scored_rows", ops=("C5",), sql=_scored_sql())
def q_lr_scored_rows(spark, sf):
    """The keys and labels of the rows the regression scores: all held-out ones, each once."""
    _, pred = MD.logistic_regression(_matrix(spark, sf), MD.FORMULA_7, train_pct=70)
    return pred.select("user_id", "product_id", "label")


@query("svm_margin", ops=("G1",))
def q_svm_margin(spark, sf):
    path = scratch_path(spark, "svm_txt")
    MD.libsvm_write(_matrix(spark, sf), path, MD.MODEL_FEATURES)
    return round_doubles(MD.svm_margin(MD.libsvm_read(spark, path, len(MD.MODEL_FEATURES))))


@query("lr_elastic_predict", ops=("C4", "C6"))
def q_lr_elastic_predict(spark, sf):
    """The other LR job: elasticNet 0.7 (with regParam 0 it stays plain
    maximum likelihood), threshold 0.5, 7-term formula."""
    _, pred = MD.logistic_regression(_matrix(spark, sf), MD.FORMULA_7, train_pct=70, elastic_net=0.7)
    return round_doubles(pred)


@query("lr_training_summary", ops=("C6", "C7"))
def q_lr_training_summary(spark, sf):
    """Loss per iteration of the training run (objectiveHistory), with the
    training ROC's area, as a small table."""
    model, _ = MD.logistic_regression(_matrix(spark, sf), MD.FORMULA_7, train_pct=70)
    s = model.summary
    rows = [(i, float(v), float(s.areaUnderROC)) for i, v in enumerate(s.objectiveHistory)]
    return round_doubles(spark.createDataFrame(rows, "iteration int, loss double, train_auc double"))


@query("lr_coefficients", ops=("C6", "G2"))
def q_lr_coefficients(spark, sf):
    """Fitted weights per formula term, and the intercept (the parameter dump)."""
    model, _ = MD.logistic_regression(_matrix(spark, sf), MD.FORMULA_7, train_pct=70)
    terms = [t.strip() for t in MD.FORMULA_7.split("~")[1].split("+")]
    rows = [(t, float(w)) for t, w in zip(terms, model.coefficients.toArray())] + [("(intercept)", float(model.intercept))]
    return round_doubles(spark.createDataFrame(rows, "term string, coefficient double"))


@query("lr_roc", ops=("C7",))
def q_lr_roc(spark, sf):
    """The trained model's own ROC curve (FPR, TPR) from its summary; Spark
    computes it distributed over the training predictions."""
    model, _ = MD.logistic_regression(_matrix(spark, sf), MD.FORMULA_7, train_pct=70)
    return round_doubles(model.summary.roc)


@query("kmeans_summary", ops=("E5",))
def q_kmeans_summary(spark, sf):
    """Cluster sizes, centre norms and the training cost (within-cluster sum of
    squares, which replaced computeCost). Centres are reported by size and
    norm, not as 2^18-wide vectors."""
    feats = MD.text_features(FXS.load(spark, sf, "fx_docs"), "sentence", min_doc_freq=2, min_len=2)
    model = MD.fit(MD.kmeans_estimator(), feats.select("doc_id", "label", "features"))
    s = model.summary
    rows = [(i, int(n), float(sum(x * x for x in c) ** 0.5), float(s.trainingCost))
            for i, (n, c) in enumerate(zip(s.clusterSizes, model.clusterCenters()))]
    return round_doubles(spark.createDataFrame(rows, "cluster int, size long, center_norm double, cost double"))
