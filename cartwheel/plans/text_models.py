"""Catalog: text features, relational Naive Bayes, classifier metrics (E*, C7-C9, G2)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import features as FE
from ..operators import metrics as M
from ..operators import text as TX
from ..session import cut_lineage
from ..sources import fixtures as FXS
from ..sources.tables import load_table
from .common import round_doubles
from .registry import query

DOCS = ("fx_docs",)
TOKENS = r"regexp_extract_all(lower({c}), '\p{{L}}+')"


# ------------------------------------------------------------------ Spark side

def _nb(spark, sf, train_pct: int = 80):
    """Shared NB set-up: features, indexed labels, train/test split by md5 bucket."""
    docs = FXS.load(spark, sf, "fx_docs")
    # Features and labelled documents feed training, scoring and several
    # totals: written once to the shared folder instead of recomputed per pass.
    feats = cut_lineage(TX.tf_idf(docs, "sentence").select("doc_id", "term", F.col("tfidf").alias("x")), "nb_feats")
    idx = TX.label_index(docs.select("label"))
    dl = docs.select("doc_id", "label").join(idx.select("label", "label_index"), "label")
    dl = cut_lineage(dl.withColumn("bucket", FE.hash_bucket("doc_id")), "nb_docs")
    train = dl.filter(F.col("bucket") < train_pct).select("doc_id", "label_index")
    test = dl.filter(F.col("bucket") >= train_pct).select("doc_id", "label_index")
    classes, theta = TX.nb_train(feats, train)
    test_feats = feats.join(TX.sent_if_small(test.select("doc_id"), TX.SENT_DOCS), "doc_id")
    pred = TX.nb_predict(TX.nb_scores(test_feats, classes, theta))
    return test.join(pred, "doc_id"), classes, theta


def _roc_input(spark, sf):
    tm = FE.train_matrix(FXS.load(spark, sf, "fx_orders"), FXS.load(spark, sf, "fx_prior"), FXS.load(spark, sf, "fx_trains"))
    return tm.select("label", F.col("prod_rod_rate").alias("score"))


# ------------------------------------------------------------------ SQL side

TF_SQL = f"""tf AS (SELECT doc_id, term, count(*) AS tf FROM
  (SELECT doc_id, unnest({TOKENS.format(c='sentence')}) AS term FROM fx_docs) t GROUP BY doc_id, term)"""
NB_SQL = f"""WITH {TF_SQL},
idf AS (SELECT term, ln(((SELECT count(*) FROM fx_docs) + 1.0) / (count(*) + 1.0)) AS idf FROM tf GROUP BY term),
feats AS (SELECT tf.doc_id, tf.term, tf.tf * idf.idf AS x FROM tf JOIN idf ON tf.term = idf.term),
li AS (SELECT label, CAST(row_number() OVER (ORDER BY count(*) DESC, label) - 1 AS DOUBLE) AS label_index
       FROM fx_docs GROUP BY label),
dl AS (SELECT d.doc_id, li.label_index,
              CAST('0x' || substr(md5(CAST(d.doc_id AS VARCHAR)), 1, 8) AS BIGINT) % 100 < 80 AS is_train
       FROM fx_docs d JOIN li ON d.label = li.label),
tr AS (SELECT doc_id, label_index FROM dl WHERE is_train),
te AS (SELECT doc_id, label_index FROM dl WHERE NOT is_train),
nc AS (SELECT label_index, count(*) AS n FROM tr GROUP BY label_index),
st AS (SELECT tr.label_index, f.term, sum(f.x) AS s FROM feats f JOIN tr ON f.doc_id = tr.doc_id
       GROUP BY tr.label_index, f.term),
sc AS (SELECT label_index, sum(s) AS s_total FROM st GROUP BY label_index),
cls AS (SELECT nc.label_index,
               ln(nc.n + 1.0) - ln((SELECT count(*) FROM tr) + (SELECT count(*) FROM nc) * 1.0) AS log_pi,
               ln(1.0) - ln(COALESCE(sc.s_total, 0) + 262144.0 * 1.0) AS log_default,
               ln(COALESCE(sc.s_total, 0) + 262144.0 * 1.0) AS log_denom
        FROM nc LEFT JOIN sc ON nc.label_index = sc.label_index),
theta AS (SELECT st.label_index, st.term, ln(st.s + 1.0) - cls.log_denom AS log_theta
          FROM st JOIN cls ON st.label_index = cls.label_index),
fte AS (SELECT f.doc_id, f.term, f.x FROM feats f JOIN te ON f.doc_id = te.doc_id),
tot AS (SELECT doc_id, sum(x) AS x_total FROM fte GROUP BY doc_id),
seen AS (SELECT f.doc_id, t.label_index, sum(f.x * t.log_theta) AS seen, sum(f.x) AS x_seen
         FROM fte f JOIN theta t ON f.term = t.term GROUP BY f.doc_id, t.label_index),
scores AS (SELECT tot.doc_id, cls.label_index,
                  cls.log_pi + COALESCE(seen.seen, 0) + (tot.x_total - COALESCE(seen.x_seen, 0)) * cls.log_default AS raw
           FROM tot CROSS JOIN cls
           LEFT JOIN seen ON seen.doc_id = tot.doc_id AND seen.label_index = cls.label_index),
pred AS (SELECT doc_id, label_index AS prediction FROM (
           SELECT doc_id, label_index, row_number() OVER (PARTITION BY doc_id ORDER BY raw DESC, label_index) AS r
           FROM scores) z WHERE r = 1),
res AS (SELECT te.doc_id, te.label_index, pred.prediction FROM te JOIN pred ON te.doc_id = pred.doc_id)
"""
ROC_SQL = """WITH tm AS (
  SELECT l.label, p.prod_rod_rate AS score
  FROM (SELECT COALESCE(r.user_id, t.user_id) AS user_id, COALESCE(r.product_id, t.product_id) AS product_id,
               CASE WHEN t.user_id IS NULL THEN 0 ELSE 1 END AS label
        FROM (SELECT DISTINCT o.user_id, p.product_id FROM fx_orders o JOIN fx_prior p ON o.order_id = p.order_id) r
        FULL OUTER JOIN (SELECT DISTINCT o.user_id, p.product_id FROM fx_orders o JOIN fx_trains p ON o.order_id = p.order_id) t
        ON r.user_id = t.user_id AND r.product_id = t.product_id) l
  JOIN (SELECT DISTINCT o.user_id FROM fx_orders o JOIN fx_prior p ON o.order_id = p.order_id) u ON l.user_id = u.user_id
  JOIN (SELECT product_id, avg(CAST(reordered AS INTEGER)) AS prod_rod_rate FROM fx_prior GROUP BY product_id) p
    ON l.product_id = p.product_id),
per AS (SELECT score AS threshold, sum(label) AS pos, sum(1 - label) AS neg FROM tm GROUP BY score),
tot AS (SELECT sum(label) AS p, sum(1 - label) AS n FROM tm),
roc AS (SELECT threshold,
               sum(neg) OVER (ORDER BY threshold DESC ROWS UNBOUNDED PRECEDING) / (SELECT n FROM tot) AS fpr,
               sum(pos) OVER (ORDER BY threshold DESC ROWS UNBOUNDED PRECEDING) / (SELECT p FROM tot) AS tpr
        FROM per)
"""


@query("segment_documents", ops=("E6", "X20", "V7"), sql=f"""
SELECT doc_id, array_to_string(list_filter({TOKENS.format(c='text')}, lambda t: length(t) > 1), '/') AS seg FROM documents""")
def q_segment_documents(spark, sf):
    return TX.segment_documents(load_table(spark, sf, "documents"), "text", "/", 2)


@query("term_frequency", ops=("E1",), fx=DOCS, sql=f"WITH {TF_SQL} SELECT doc_id, term, tf FROM tf", bench=True)
def q_term_frequency(spark, sf):
    return TX.term_frequency(FXS.load(spark, sf, "fx_docs"), "sentence")


@query("document_frequency", ops=("E7",), fx=DOCS, sql=f"WITH {TF_SQL} SELECT term, count(*) AS df FROM tf GROUP BY term")
def q_document_frequency(spark, sf):
    return TX.document_frequency(TX.term_frequency(FXS.load(spark, sf, "fx_docs"), "sentence"))


@query("tf_idf", ops=("E2",), fx=DOCS, sql=f"""WITH {TF_SQL},
df AS (SELECT term, count(*) AS df FROM tf GROUP BY term)
SELECT tf.doc_id, tf.term, tf.tf,
       round(CASE WHEN df.df >= 2 THEN ln(((SELECT count(*) FROM fx_docs) + 1.0) / (df.df + 1.0)) ELSE 0.0 END, 6) AS idf,
       round(tf.tf * CASE WHEN df.df >= 2 THEN ln(((SELECT count(*) FROM fx_docs) + 1.0) / (df.df + 1.0)) ELSE 0.0 END, 6)
         AS tfidf
FROM tf JOIN df ON tf.term = df.term""")
def q_tf_idf(spark, sf):
    """minDocFreq 2, as in the clustering job."""
    return round_doubles(TX.tf_idf(FXS.load(spark, sf, "fx_docs"), "sentence", min_doc_freq=2))


@query("label_index", ops=("E3",), fx=DOCS, sql="""
SELECT label, count(*) AS cnt, CAST(row_number() OVER (ORDER BY count(*) DESC, label) - 1 AS DOUBLE) AS label_index
FROM fx_docs GROUP BY label""")
def q_label_index(spark, sf):
    return TX.label_index(FXS.load(spark, sf, "fx_docs").select("label"))


@query("nb_priors_theta", ops=("E4", "G2"), fx=DOCS, sql=NB_SQL + """
SELECT 'pi' AS kind, label_index, CAST(NULL AS VARCHAR) AS term, round(log_pi, 6) AS value FROM cls
UNION ALL SELECT 'default', label_index, NULL, round(log_default, 6) FROM cls
UNION ALL SELECT 'theta', label_index, term, round(log_theta, 6) FROM theta""")
def q_nb_priors_theta(spark, sf):
    _, classes, theta = _nb(spark, sf)
    pi = classes.select(F.lit("pi").alias("kind"), "label_index", F.lit(None).cast("string").alias("term"),
                        F.col("log_pi").alias("value"))
    dflt = classes.select(F.lit("default").alias("kind"), "label_index", F.lit(None).cast("string").alias("term"),
                          F.col("log_default").alias("value"))
    th = theta.select(F.lit("theta").alias("kind"), "label_index", "term", F.col("log_theta").alias("value"))
    return round_doubles(pi.unionByName(dflt).unionByName(th))


@query("nb_predict", ops=("E4",), fx=DOCS, sql=NB_SQL + "SELECT doc_id, label_index, prediction FROM res")
def q_nb_predict(spark, sf):
    return _nb(spark, sf)[0].select("doc_id", "label_index", "prediction")


@query("confusion_matrix", ops=("C8",), fx=DOCS, sql=NB_SQL + """
SELECT label_index AS label, prediction, count(*) AS cnt FROM res GROUP BY label_index, prediction""")
def q_confusion_matrix(spark, sf):
    return M.confusion_matrix(_nb(spark, sf)[0])


@query("multiclass_metrics", ops=("C8",), fx=DOCS, sql=NB_SQL + """,
cm AS (SELECT label_index AS label, prediction, count(*) AS cnt FROM res GROUP BY label_index, prediction),
n AS (SELECT count(*) AS n FROM res),
per AS (SELECT a.label, a.actual, COALESCE(t.tp, 0) AS tp,
               COALESCE(CAST(t.tp AS DOUBLE) / NULLIF(p.predicted, 0), 0.0) AS p,
               COALESCE(t.tp, 0) / a.actual AS r
        FROM (SELECT label, sum(cnt) AS actual FROM cm GROUP BY label) a
        LEFT JOIN (SELECT label, cnt AS tp FROM cm WHERE label = prediction) t ON a.label = t.label
        LEFT JOIN (SELECT prediction AS label, sum(cnt) AS predicted FROM cm GROUP BY prediction) p ON a.label = p.label),
per2 AS (SELECT *, CASE WHEN p + r = 0 THEN 0.0 ELSE 2 * p * r / (p + r) END AS f FROM per)
SELECT 'accuracy' AS metric, round(sum(tp) / (SELECT n FROM n), 6) AS value FROM per2
UNION ALL SELECT 'weightedPrecision', round(sum(actual / (SELECT n FROM n) * p), 6) FROM per2
UNION ALL SELECT 'weightedRecall', round(sum(actual / (SELECT n FROM n) * r), 6) FROM per2
UNION ALL SELECT 'f1', round(sum(actual / (SELECT n FROM n) * f), 6) FROM per2""")
def q_multiclass_metrics(spark, sf):
    return round_doubles(M.multiclass_metrics(_nb(spark, sf)[0]))


@query("misclassified", ops=("C9",), fx=DOCS, sql=NB_SQL + """
SELECT doc_id, label_index, prediction FROM res WHERE label_index <> prediction""")
def q_misclassified(spark, sf):
    return M.misclassified(_nb(spark, sf)[0].select("doc_id", "label_index", "prediction"))


@query("roc_curve", ops=("C7",), fx=("fx_orders", "fx_prior", "fx_trains"), sql=ROC_SQL + """
SELECT round(threshold, 6) AS threshold, round(fpr, 6) AS fpr, round(tpr, 6) AS tpr FROM roc""")
def q_roc_curve(spark, sf):
    return round_doubles(M.roc_curve(_roc_input(spark, sf)))


@query("auc", ops=("C7",), fx=("fx_orders", "fx_prior", "fx_trains"), sql=ROC_SQL + """
SELECT round(sum((fpr - fpr0) * (tpr + tpr0) / 2), 6) AS auc FROM (
  SELECT fpr, tpr, COALESCE(lag(fpr) OVER (ORDER BY threshold DESC), 0) AS fpr0,
         COALESCE(lag(tpr) OVER (ORDER BY threshold DESC), 0) AS tpr0 FROM roc) z""")
def q_auc(spark, sf):
    return round_doubles(M.auc(_roc_input(spark, sf)))
