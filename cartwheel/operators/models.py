"""``pyspark.ml`` pipelines of the reference's model jobs.

The estimators are Spark's own distributed implementations; what this module
adds is the reference's configuration and the deterministic splits (md5
buckets instead of ``randomSplit``, so a retried or re-partitioned run trains
on the same rows). Training sets are cached only around the iterative
``fit``.
"""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LinearSVC, LogisticRegression, NaiveBayes
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import IDF, HashingTF, RFormula, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import tokens
from ..session import cut_lineage
from .features import MODEL_PRODUCT, MODEL_USER, hash_bucket
from .text import NUM_FEATURES

# The reference's model formulas.
FORMULA_7 = ("label ~ u_avg_day_gap + user_ord_cnt + u_prod_dist_cnt + u_avg_ord_prods"
             " + prod_sum_rod + prod_rod_rate + prod_cnt")
FORMULA_13 = (FORMULA_7 + " + days_since_ratio + up_hour_vs_last + order_hour_of_day"
              " + days_since_prior_order + avg_pos_in_cart + orders_cnt")



MODEL_FEATURES = MODEL_USER + MODEL_PRODUCT


def fit(estimator, train: DataFrame):
    """Fit with the training rows cached for the estimator's passes, and
    released afterwards (a lost cached block is recomputed from lineage)."""
    train = train.cache()
    try:
        return estimator.fit(train)
    finally:
        train.unpersist()


def split(df: DataFrame, key, train_pct: int) -> tuple[DataFrame, DataFrame]:
    """Reproducible train/test split by md5 bucket of ``key``."""
    b = hash_bucket(key)
    return df.filter(b < train_pct), df.filter(b >= train_pct)


def logistic_regression(matrix: DataFrame, formula: str = FORMULA_7, train_pct: int = 70,
                        elastic_net: float = 0.0, threshold: float = 0.5):
    """C4 + C6: RFormula featurizer, LR (maxIter 10, regParam 0), predictions
    on the held-out rows. Returns (model, predictions)."""
    matrix = cut_lineage(matrix, "matrix")      # read by the formula, the fit and the scoring
    feats = RFormula(formula=formula, featuresCol="features", labelCol="label_d").fit(matrix).transform(matrix)
    train, test = split(feats, F.concat_ws("_", "user_id", "product_id"), train_pct)
    lr = LogisticRegression(maxIter=10, regParam=0.0, elasticNetParam=elastic_net, threshold=threshold,
                            labelCol="label_d")
    model = fit(lr, train)
    pred = model.transform(test).select(
        "user_id", "product_id", "label", vector_to_array("probability")[1].alias("p1"),
        F.col("prediction").cast("int").alias("prediction"))
    return model, pred


def tfidf_stages(min_doc_freq: int) -> list:
    """E1 + E2: hashed term counts (2^18 buckets), then IDF."""
    return [HashingTF(inputCol="seg", outputCol="term_counts", numFeatures=NUM_FEATURES),
            IDF(inputCol="term_counts", outputCol="features", minDocFreq=min_doc_freq)]


def text_features(docs: DataFrame, text: str = "sentence", min_doc_freq: int = 1,
                  min_len: int = 1) -> DataFrame:
    """TF-IDF vectors of a text column's tokens of at least ``min_len`` letters."""
    d = docs.withColumn("seg", tokens(text, min_len))
    return Pipeline(stages=tfidf_stages(min_doc_freq)).fit(d).transform(d)


def kmeans_estimator(k: int = 10, seed: int = 2019) -> KMeans:
    """k-means|| initialisation with 5 steps, 20 iterations, fixed seed."""
    return KMeans(featuresCol="features", k=k, initMode="k-means||", initSteps=5, maxIter=20,
                  seed=seed, predictionCol="pred")


def kmeans_assign(docs: DataFrame, k: int = 10, seed: int = 2019) -> tuple[DataFrame, float]:
    """E5: k-means|| (5 init steps), 20 iterations over TF-IDF vectors of
    tokens longer than one letter (minDocFreq 2). Returns (assignments, cost)."""
    feats = text_features(docs, "sentence", min_doc_freq=2, min_len=2).select("doc_id", "label", "features")
    model = fit(kmeans_estimator(k, seed), feats)
    return model.transform(feats).select("doc_id", "label", "pred"), model.summary.trainingCost


def nb_stages(min_doc_freq: int = 1) -> list:
    """The label index (unseen label = error), the TF-IDF stages of
    ``text_features`` and a multinomial NB with smoothing 1."""
    index = StringIndexer(inputCol="label", outputCol="label_index", handleInvalid="error")
    bayes = NaiveBayes(labelCol=index.getOutputCol(), featuresCol="features", smoothing=1.0)
    return [index, *tfidf_stages(min_doc_freq), bayes]


def model_roundtrip(spark: SparkSession, docs: DataFrame, path: str, train_pct: int = 80) -> DataFrame:
    """Fit the index, TF-IDF and NB stages on the train split, save them as
    one model, load it back and score the test rows with the loaded copy."""
    train, test = split(docs.select("doc_id", "label", tokens("sentence").alias("seg")), "doc_id", train_pct)
    fit(Pipeline(stages=nb_stages()), train).write().overwrite().save(path)
    return PipelineModel.load(path).transform(test).select("doc_id", "label", "label_index", "prediction")


def libsvm_write(matrix: DataFrame, path: str, features: list[str]) -> None:
    """S7 (write side): (label, feature vector) in libsvm text format."""
    v = VectorAssembler(inputCols=features, outputCol="features", handleInvalid="keep").transform(matrix)
    v.select(F.col("label").cast("double").alias("label"), "features").write.mode("overwrite") \
        .format("libsvm").save(path)


def libsvm_read(spark: SparkSession, path: str, num_features: int) -> DataFrame:
    """LibSVM load (label double, features vector)."""
    return spark.read.format("libsvm").option("numFeatures", num_features).load(path)


def svm_estimator(iterations: int = 100) -> LinearSVC:
    """Regularisation 0.01, no intercept, no feature scaling."""
    return LinearSVC(maxIter=iterations, regParam=0.01, fitIntercept=False, standardization=False)


def svm_margin(data: DataFrame, train_pct: int = 60, iterations: int = 100) -> DataFrame:
    """G1: linear SVM, 100 iterations; the raw margin (threshold cleared) on
    the held-out rows. Split on a content hash of the row for repeatability."""
    keyed = data.withColumn("_k", F.sha2(F.to_json(F.struct(
        "label", vector_to_array("features").alias("f"))), 256))
    train, test = split(keyed, "_k", train_pct)
    # The estimator keeps the rows itself, as blocks; a second copy would crowd them out of memory.
    model = svm_estimator(iterations).fit(train.select("label", "features"))
    return model.transform(test).select("label", vector_to_array("rawPrediction")[1].alias("margin"))

