"""Round 5: what is moved and kept by term counts, on rows of the tests' own."""

import collections
import math

import pytest

from cartwheel.operators import text as TX

DOCS = [(1, "b a b"), (2, "a c"), (2, "a d"), (3, None), (4, ""), (5, "1 2"), (None, "b x"), (None, "x"), (6, "a x")]


def _counts(docs):
    out = collections.Counter()
    for d, t in docs:
        out.update((d, w) for w in (t or "").split() if w.isalpha())
    return out


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_counts_of_terms_move_no_text(spark):
    docs = spark.createDataFrame([r for r in DOCS if r[0] in (1, 3, 4, 5, 6)], "doc_id long, text string").repartition(3).localCheckpoint()
    assert "Exchange" not in _plan(TX.term_frequency(docs))


@pytest.mark.parametrize("docs", [DOCS, DOCS[:2], [(1, None)], [(7, "a")] * 3])
def test_counts_of_rows_that_share_an_id(spark, docs):
    got = [tuple(r) for r in TX.term_frequency(spark.createDataFrame(docs, "doc_id long, text string")).collect()]
    assert len(got) == len(set(g[:2] for g in got)) and {g[:2]: g[2] for g in got} == _counts(docs)


@pytest.mark.parametrize("most", [0, 1, 2, 100])
def test_frequent_and_rare_terms_have_the_same_idf(spark, monkeypatch, most):
    monkeypatch.setattr(TX, "SENT_TERMS", most)
    tf = _counts(DOCS)
    df = collections.Counter(w for _, w in tf)
    out = TX.tf_idf(spark.createDataFrame(DOCS, "doc_id long, text string"), min_doc_freq=2).collect()
    assert len(out) == len(tf)
    for r in out:
        idf = math.log((len(DOCS) + 1) / (df[r["term"]] + 1)) if df[r["term"]] >= 2 else 0.0
        assert r["tf"] == tf[r["doc_id"], r["term"]] and r["idf"] == pytest.approx(idf) and r["tfidf"] == pytest.approx(r["tf"] * idf)
