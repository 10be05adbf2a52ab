"""Text features and a relational multinomial Naive Bayes (family E).

The term table (doc_id, term, tf) is the exact, collision-free form of the
reference's hashed term-frequency vectors; IDF, Naive Bayes training and
scoring are aggregates and joins over it, so every step is a distributed
shuffle keyed by term or by document and nothing is assembled per document
on the driver. ``models.py`` runs the equivalent ``pyspark.ml`` pipeline.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import segment, tokens
from ..session import cut_lineage

# Fixed values of the reference pipeline.
NUM_FEATURES = 1 << 18        # hashing dimension (HashingTF default, 262144)
SMOOTHING = 1.0               # Naive Bayes additive smoothing
SENT_TERMS = 500_000          # rows of a table (a term or two numbers each) that may be sent to
SENT_DOCS = 4_000_000         # every task; larger ones are joined by a shuffle


def sent_if_small(df: DataFrame, most: int) -> DataFrame:
    """``df``, marked for a broadcast join if it is counted to have at most ``most`` rows: the term
    rows it is joined with are many times the text, and need not be moved then."""
    return F.broadcast(df) if df.limit(most + 1).count() <= most else df


def segment_documents(docs: DataFrame, text: str = "text", sep: str = "/", min_len: int = 2) -> DataFrame:
    """Segmented text, tokens shorter than ``min_len`` dropped."""
    return docs.select("doc_id", segment(text, sep, min_len).alias("seg"))


def term_counts(words: Column) -> Column:
    """An array of (term, tf) from an array of words: the words are sorted, a term is a run of equal ones."""
    def runs(s):
        starts = F.when(F.size(s) > 0, F.filter(F.sequence(F.lit(0), F.size(s) - 1), lambda i: ~F.get(s, i).eqNullSafe(F.get(s, i - 1))))
        return _bound(starts, lambda at: F.transform(at, lambda i, k: F.struct(
            F.get(s, i).alias("term"), (F.coalesce(F.get(at, k + 1), F.size(s)) - i).cast("bigint").alias("tf"))))
    return _bound(F.sort_array(words), runs)


def _bound(value: Column, body) -> Column:
    """``body(value)`` with the value computed once, however often the body names it."""
    return F.transform(F.array(value), body)[0]


def term_frequency(docs: DataFrame, text: str = "text") -> DataFrame:
    """(doc_id, term, tf) - raw counts, not binary. Terms are counted within their row, so no
    text is moved; only the terms of a doc_id with several rows (found first, by ids alone; null is
    one id) are brought together."""
    t = docs.select("doc_id", F.col(text).alias("text"))
    again = t.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select(F.col("doc_id").alias("again"))

    def counted(rows):
        return rows.select("doc_id", F.explode(term_counts(tokens("text"))).alias("t")).select("doc_id", "t.term", "t.tf")

    if again.isEmpty():
        return counted(t)
    again = sent_if_small(cut_lineage(again, "doc_ids_again"), SENT_DOCS)
    same = F.col("doc_id").eqNullSafe(F.col("again"))
    together = counted(t.join(again, same, "left_semi")).groupBy("doc_id", "term").agg(F.sum("tf").alias("tf"))
    return counted(t.join(again, same, "left_anti")).unionByName(together)


def document_frequency(tf: DataFrame) -> DataFrame:
    """(term, df) - documents containing the term."""
    return tf.groupBy("term").agg(F.count(F.lit(1)).alias("df"))


def idf_table(tf: DataFrame, n_docs: Column, min_doc_freq: int = 1) -> DataFrame:
    """idf = ln((N + 1) / (df + 1)); terms below ``min_doc_freq`` get 0."""
    df = document_frequency(tf)
    idf = F.log((n_docs + F.lit(1)).cast("double") / (F.col("df") + F.lit(1)).cast("double"))
    return df.select("term", "df", F.when(F.col("df") >= min_doc_freq, idf).otherwise(F.lit(0.0)).alias("idf"))


def tf_idf(docs: DataFrame, text: str = "text", min_doc_freq: int = 1, tf: DataFrame | None = None) -> DataFrame:
    """(doc_id, term, tf, idf, tfidf). N counts every document, including
    ones with no tokens, as the vectorised IDF does. The idf table has one
    row per term; it is written and joins the term table on term, by broadcast
    up to ``SENT_TERMS`` terms and by a shuffle beyond (the vocabulary
    grows with the corpus, so it is not broadcast blindly). ``tf``: the documents' term frequencies,
    where they are written already; else their words are counted for the idf table and again for the join."""
    tf = term_frequency(docs, text) if tf is None else tf
    n = docs.agg(F.count(F.lit(1))).scalar()
    idf = cut_lineage(idf_table(tf, n, min_doc_freq).select("term", "idf"), "idf")
    return (tf.join(sent_if_small(idf, SENT_TERMS), "term")
            .select("doc_id", "term", "tf", "idf", (F.col("tf") * F.col("idf")).alias("tfidf")))


def label_index(labels: DataFrame, label: str = "label") -> DataFrame:
    """Label -> index by descending frequency, ties alphabetical (the
    StringIndexer default). The window runs over one row per distinct label."""
    c = labels.groupBy(label).agg(F.count(F.lit(1)).alias("cnt"))
    w = Window.orderBy(F.desc("cnt"), F.asc(label))
    return c.select(label, "cnt", (F.row_number().over(w) - 1).cast("double").alias("label_index"))


def nb_train(feats: DataFrame, doc_labels: DataFrame, smoothing: float = SMOOTHING,
             num_features: int = NUM_FEATURES) -> tuple[DataFrame, DataFrame]:
    """E4 training. ``feats``: (doc_id, term, x); ``doc_labels``: (doc_id,
    label_index) of the training documents.

    Returns (classes, theta):
    classes: label_index, log_pi, log_default (theta of a term the class never saw)
    theta:   label_index, term, log_theta (terms seen in the class)
    with log_pi = ln(n_c + a) - ln(N + K a), log_theta = ln(s_ct + a) - ln(s_c + D a).
    """
    lam = F.lit(float(smoothing))
    n_docs = doc_labels.groupBy("label_index").agg(F.count(F.lit(1)).alias("n"))
    total = doc_labels.agg(F.count(F.lit(1))).scalar()
    k = n_docs.agg(F.count(F.lit(1))).scalar()
    # The per-(class, term) sums are the model's sufficient statistics; every
    # parameter below reads them, so they are written once to the shared folder.
    st = cut_lineage(feats.join(sent_if_small(doc_labels, SENT_DOCS), "doc_id").groupBy("label_index", "term")
                     .agg(F.sum("x").alias("s")), "nb_stats")
    sc = st.groupBy("label_index").agg(F.sum("s").alias("s_total"))
    denom = F.log(F.col("s_total") + F.lit(float(num_features)) * lam)
    classes = (n_docs.join(sc, "label_index", "left").na.fill(0.0, ["s_total"])
               .select("label_index",
                       (F.log(F.col("n") + lam) - F.log(total + k * lam)).alias("log_pi"),
                       (F.log(lam) - denom).alias("log_default"),
                       denom.alias("log_denom")))
    theta = (st.join(classes.select("label_index", "log_denom"), "label_index")
             .select("label_index", "term", (F.log(F.col("s") + lam) - F.col("log_denom")).alias("log_theta")))
    return classes.drop("log_denom"), theta


def nb_scores(feats: DataFrame, classes: DataFrame, theta: DataFrame) -> DataFrame:
    """Raw log score of every (document, class):
    log_pi_c + sum over terms the class saw of x_t theta_ct
             + (x_total - x_seen_c) default_c.

    Only (doc, term, class) triples present in the model are materialised
    (join on term, then summed per (doc, class) and packed as a map of at
    most K entries per document). The class parameters enter as one small
    array - a scalar subquery whose size is the number of classes - so no
    document x class cross join is planned."""
    cls = classes.agg(F.array_sort(F.collect_list(
        F.struct("label_index", "log_pi", "log_default"))).alias("c")).scalar()
    tot = feats.groupBy("doc_id").agg(F.sum("x").alias("x_total"))
    seen = (feats.join(theta, "term").groupBy("doc_id", "label_index")
            .agg(F.sum(F.col("x") * F.col("log_theta")).alias("seen"), F.sum("x").alias("x_seen")))
    packed = seen.groupBy("doc_id").agg(F.map_from_entries(F.collect_list(
        F.struct("label_index", F.struct("seen", "x_seen")))).alias("m"))
    # The class array is projected first: a subquery may not sit inside a lambda.
    j = tot.join(packed, "doc_id", "left").withColumn("cls", cls)

    def score(c):
        hit = F.col("m")[c["label_index"]]
        return F.struct(
            c["label_index"].alias("label_index"),
            (c["log_pi"] + F.coalesce(hit["seen"], F.lit(0.0))
             + (F.col("x_total") - F.coalesce(hit["x_seen"], F.lit(0.0))) * c["log_default"]).alias("raw"))

    return (j.select("doc_id", F.explode(F.transform("cls", score)).alias("s"))
            .select("doc_id", "s.label_index", "s.raw"))


def nb_predict(scores: DataFrame) -> DataFrame:
    """Arg-max class per document; ties go to the lower class index."""
    best = F.max_by(F.col("label_index"), F.struct(F.col("raw"), -F.col("label_index")))
    return scores.groupBy("doc_id").agg(best.alias("prediction"))
