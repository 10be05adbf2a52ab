"""Operator 3, quality classifier by co-training.

Two views of a document: its text content (hashed words and runs of marks) and its page
metadata (source, language, lengths, line shape). A logistic regression is fitted on each.
Each is calibrated (Platt scaling) on labelled rows kept out of training. In every round
each view scores all documents outside the labelled sample, and those that its calibrated chance is
sure of join the other view's training rows with its label; a view that isn't good enough
to be sure of any gives none. At the end the calibrated log-odds of both views are added,
less the prior's, to score all documents.

Scale: Spark ML throughout. The labelled sample is bounded, by a hash of doc_id: about
``MAX_LABELLED`` rows. The other documents' word counts and page metadata are written once and
scored in every round, and the fits run over all that are sure. Scoring is one pass over whole
texts, without a shuffle or Python.

Defined cases: null and empty texts have no words and are scored by the metadata and the
prior; null metadata counts as its own value; several labels of one doc_id count as good
if one is; repeated rows each keep their row; extra columns are ignored; with labels of
one kind or none, the score of every row is the share of good labels (0.5 without any).
"""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import FeatureHasher, HashingTF, Normalizer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut_lineage, text_or_empty

MAX_LABELLED = 20_000
ROUNDS = 3
SURE = 0.95
WORD_BITS, META_BITS = 15, 10
_EVERY = 1_000_000


def views(docs: DataFrame) -> DataFrame:
    """doc_id and the raw inputs of both views."""
    text = text_or_empty()
    lines = F.size(F.split(text, "\n"))
    return docs.select(
        "doc_id", F.regexp_extract_all(F.lower(text), F.lit(r"[\p{L}\p{N}]+|[^\p{L}\p{N}\s]+"), F.lit(0)).alias("tokens"),
        F.coalesce("source", F.lit("null")).alias("source"), F.coalesce("lang", F.lit("null")).alias("lang"),
        F.log1p(F.coalesce("n_chars", F.lit(0)).cast("double")).alias("chars"), F.log1p(lines.cast("double")).alias("lines"),
        F.log1p(F.length(text) / lines).alias("line_chars"),
        (F.octet_length(text) / F.greatest(F.length(text), F.lit(1))).alias("width"))


def counted(rows: DataFrame) -> DataFrame:
    """Word counts in place of the words; smaller to write than the features."""
    return HashingTF(inputCol="tokens", outputCol="counts", numFeatures=1 << WORD_BITS).transform(rows).drop("tokens")


def normed(rows: DataFrame) -> DataFrame:
    """Both views' features from counts and metadata."""
    rows = Normalizer(inputCol="counts", outputCol="text_features").transform(rows).drop("counts")
    return FeatureHasher(inputCols=["source", "lang", "chars", "lines", "line_chars", "width"], outputCol="meta_features",
                         numFeatures=1 << META_BITS, categoricalCols=["source", "lang"]).transform(rows)


def with_features(rows: DataFrame) -> DataFrame:
    return normed(counted(rows))


def _share(col: Column, share: float) -> Column:
    return F.pmod(F.xxhash64(col, F.lit("sample")), F.lit(_EVERY)) < int(min(1.0, share) * _EVERY)


def _logit(view: str) -> Column:
    return vector_to_array(f"{view}_raw")[1]


def _model(view: str) -> LogisticRegression:
    return LogisticRegression(featuresCol=f"{view}_features", labelCol="y", rawPredictionCol=f"{view}_raw", probabilityCol=f"{view}_p",
                              predictionCol=f"{view}_y", maxIter=25,
                              # rare words are not scaled up to the weight of frequent marks
                              standardization=view != "text", regParam=1e-4 if view == "text" else 1e-2)


def fit(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED, rounds: int = ROUNDS) -> dict:
    """Both views' models, their calibrations (slope, shift) and the prior's log-odds."""
    known = labels.filter("quality is not null").groupBy("doc_id").agg(F.max("quality").cast("double").alias("y"))
    n, good = known.agg(F.count(F.lit(1)), F.coalesce(F.sum("y"), F.lit(0.0))).first()
    if good in (0, n):
        return {"share": good / n if n else 0.5}
    part = known.filter(_share(F.col("doc_id"), max_labelled / n))
    rows = views(docs.join(F.broadcast(part.select("doc_id")), "doc_id"))       # bounded by ``max_labelled``
    rows = cut_lineage(with_features(rows).join(part, "doc_id"), "quality_labelled")
    train, keep = rows.filter(F.pmod(F.xxhash64("doc_id"), F.lit(4)) != 0), rows.filter(F.pmod(F.xxhash64("doc_id"), F.lit(4)) == 0)
    if train.select("y").distinct().count() < 2:
        return {"share": good / n}
    pool = normed(cut_lineage(counted(views(docs.join(F.broadcast(part.select("doc_id")), "doc_id", "left_anti"))), "quality_pool"))
    extra = {"text": None, "meta": None}
    for r in range(rounds + 1):
        models = {v: _model(v).fit(train if extra[v] is None else train.unionByName(extra[v], allowMissingColumns=True)) for v in extra}
        platt = {v: _calibration(models[v], keep, v) for v in extra}
        if r == rounds:
            break
        scored = models["meta"].transform(models["text"].transform(pool))
        for view, other in (("text", "meta"), ("meta", "text")):
            a, b = platt[other]
            p = 1 / (1 + F.exp(-(_logit(other) * a + b)))
            # not written: read again from the pool, with this round's models
            extra[view] = scored.filter((p >= SURE) | (p <= 1 - SURE)).select(*pool.columns, (p >= 0.5).cast("double").alias("y"))
    return {"models": models, "platt": platt, "share": good / n}


def _calibration(model, keep: DataFrame, view: str) -> tuple[float, float]:
    """Slope and shift of the view's log-odds on rows it wasn't fitted on."""
    rows = model.transform(keep).select("y", _logit(view).alias("z"))
    if rows.select("y").distinct().count() < 2:
        return 1.0, 0.0
    platt = Pipeline(stages=[VectorAssembler(inputCols=["z"], outputCol="x"),
                             LogisticRegression(featuresCol="x", labelCol="y", regParam=1e-3)]).fit(rows).stages[1]
    return max(0.0, float(platt.coefficients[0])), float(platt.intercept)


def score(docs: DataFrame, fitted: dict) -> DataFrame:
    """Per row: doc_id, p_text, p_meta, score, good."""
    share = fitted["share"]
    if "models" not in fitted:
        p = F.lit(share)
        return docs.select("doc_id", p.alias("p_text"), p.alias("p_meta"), p.alias("score"), F.lit(share >= 0.5).alias("good"))
    rows = with_features(views(docs))
    for view, model in fitted["models"].items():
        rows = model.transform(rows)
    z = {v: _logit(v) * a + b for v, (a, b) in fitted["platt"].items()}
    prior = F.log(F.lit(share / (1 - share)))
    sigmoid = lambda x: 1 / (1 + F.exp(-x))
    return rows.select("doc_id", sigmoid(z["text"]).alias("p_text"), sigmoid(z["meta"]).alias("p_meta"),
                       sigmoid(z["text"] + z["meta"] - prior).alias("score")).withColumn("good", F.col("score") >= 0.5)


def classify(docs: DataFrame, labels: DataFrame, **bounds) -> DataFrame:
    return score(docs, fit(docs, labels, **bounds))
