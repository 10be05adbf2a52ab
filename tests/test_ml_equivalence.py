"""Relational text / model operators against pyspark.ml on the same inputs."""

import math

from pyspark.ml.classification import NaiveBayes
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import IDF, HashingTF
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartwheel.functions.text import tokens
from cartwheel.operators import features as FE
from cartwheel.operators import metrics as M
from cartwheel.operators import text as TX
from cartwheel.sources import fixtures as FXS

SF = "/root/testdata/sf0.001"


def _setup(spark):
    docs = FXS.fx_docs(spark, SF)
    feats = TX.tf_idf(docs, "sentence").select("doc_id", "term", F.col("tfidf").alias("x"))
    idx = TX.label_index(docs.select("label"))
    dl = (docs.select("doc_id", "label").join(idx.select("label", "label_index"), "label")
          .withColumn("bucket", FE.hash_bucket("doc_id")))
    return docs, feats, dl


def test_tf_idf_matches_hashed_pipeline_on_collision_free_terms(spark):
    docs, feats, _ = _setup(spark)
    htf = HashingTF(inputCol="seg", outputCol="tf", numFeatures=TX.NUM_FEATURES)
    vocab = [r.term for r in feats.select("term").distinct().collect()]
    buckets = {}
    for t in vocab:
        buckets.setdefault(htf.indexOf(t), []).append(t)
    clean = {t: b for b, ts in buckets.items() if len(ts) == 1 for t in ts}
    d = docs.withColumn("seg", tokens("sentence"))
    model = IDF(inputCol="tf", outputCol="v").fit(htf.transform(d))
    ml = {r.doc_id: r.v for r in model.transform(htf.transform(d)).select("doc_id", "v").collect()}
    checked = 0
    for r in feats.collect():
        if r.term in clean:
            assert math.isclose(ml[r.doc_id][clean[r.term]], r.x, rel_tol=1e-9, abs_tol=1e-12)
            checked += 1
    assert checked > 1000


def test_naive_bayes_matches_ml(spark):
    docs, feats, dl = _setup(spark)
    terms = sorted(r.term for r in feats.select("term").distinct().collect())
    index = {t: i for i, t in enumerate(terms)}
    train = dl.filter(F.col("bucket") < 80).select("doc_id", "label_index")
    test = dl.filter(F.col("bucket") >= 80).select("doc_id", "label_index")

    # Spark ML on exact term indices (no hashing), vector size = vocabulary
    per_doc = {}
    for r in feats.collect():
        per_doc.setdefault(r.doc_id, {})[index[r.term]] = r.x
    lab = {r.doc_id: r.label_index for r in dl.collect()}
    rows = [(d, lab[d], Vectors.sparse(len(terms), v)) for d, v in per_doc.items()]
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("label_index", T.DoubleType()),
                           T.StructField("features", VectorUDT())])
    vec = spark.createDataFrame(rows, schema)
    tr_ids = {r.doc_id for r in train.collect()}
    ml_train = vec.filter(F.col("doc_id").isin(list(tr_ids)))
    ml = NaiveBayes(smoothing=1.0, modelType="multinomial", labelCol="label_index").fit(ml_train)

    # relational model with the same feature count
    classes, theta = TX.nb_train(feats, train, num_features=len(terms))
    pi = {int(r.label_index): r.log_pi for r in classes.collect()}
    for c, v in pi.items():
        assert math.isclose(ml.pi[c], v, rel_tol=1e-9)
    th = ml.theta.toArray()
    for r in theta.collect():
        assert math.isclose(th[int(r.label_index)][index[r.term]], r.log_theta, rel_tol=1e-9)
    for r in classes.collect():        # a term never seen by a class
        seen = {x.term for x in theta.filter(F.col("label_index") == r.label_index).collect()}
        unseen = next(t for t in terms if t not in seen)
        assert math.isclose(th[int(r.label_index)][index[unseen]], r.log_default, rel_tol=1e-9)

    ours = {r.doc_id: r.prediction for r in
            TX.nb_predict(TX.nb_scores(feats.join(test.select("doc_id"), "doc_id"), classes, theta)).collect()}
    theirs = {r.doc_id: r.prediction for r in
              ml.transform(vec.filter(~F.col("doc_id").isin(list(tr_ids)))).collect()}
    assert ours == theirs and len(ours) > 10


def test_weighted_metrics_match_evaluator(spark):
    docs, feats, dl = _setup(spark)
    train = dl.filter(F.col("bucket") < 80).select("doc_id", "label_index")
    test = dl.filter(F.col("bucket") >= 80).select("doc_id", "label_index")
    classes, theta = TX.nb_train(feats, train)
    pred = test.join(TX.nb_predict(TX.nb_scores(feats.join(test.select("doc_id"), "doc_id"), classes, theta)),
                     "doc_id")
    ours = {r.metric: r.value for r in M.multiclass_metrics(pred).collect()}
    ev = MulticlassClassificationEvaluator(labelCol="label_index", predictionCol="prediction")
    for name in ["accuracy", "weightedPrecision", "weightedRecall", "f1"]:
        assert math.isclose(ours[name], ev.setMetricName(name).evaluate(pred), rel_tol=1e-9), name
