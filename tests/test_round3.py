"""Findings of the third round: what is shuffled, and that results stay."""

from cartwheel.operators import neighbours as NB
from cartwheel.operators import recommend as R
from cartwheel.operators import text as TX


def _ratings(spark):
    rows = [(u, i, (u * i) % 5 + 1) for u in range(40) for i in range(12) if (u + i) % 3] + [(None, 1, 3), (7, None, 2)]
    return spark.createDataFrame(rows, "user_id long, item_id long, rating int")


def test_pairs_are_not_joined_with_norms(spark):
    """No exchange or join behind the one that brings a user's co-ratings together."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for sim in (R.cosine(_ratings(spark)), R.top_neighbours(R.directed_cosine(_ratings(spark)), 3)):
            plan = sim._jdf.queryExecution().executedPlan().toString()
            above = plan[:plan.index("Exchange")]
            assert "Join" not in above and "REPARTITION_BY_NUM" in plan[plan.index("Exchange"):].splitlines()[0]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_arrays_give_the_pairs_of_a_plain_join(spark):
    r = _ratings(spark)
    rows = r.dropna().collect()
    want = {}
    for a in rows:
        for b in rows:
            if a["item_id"] == b["item_id"] and a["user_id"] < b["user_id"]:
                want[a["user_id"], b["user_id"]] = want.get((a["user_id"], b["user_id"]), 0) + a["rating"] * b["rating"]
    for block in (3, 2048):
        assert {(x["u"], x["v"]): x["dot"] for x in R.co_rating_dot(r, block=block).collect()} == want


def test_nearest_users_without_common_items_needs_no_candidates(spark, monkeypatch):
    """pairs of rarely rated items are summed once, not joined with whole vectors."""
    r = _ratings(spark).dropna()
    want = sorted(map(tuple, R.top_neighbours(R.cosine(r), 5).collect()))
    assert sorted(map(tuple, NB.nearest_users(r, 5, rare=10).collect())) == want
    monkeypatch.setattr(NB, "candidates", None)
    assert sorted(map(tuple, NB.nearest_users(r, 5).collect())) == want


def test_term_rows_are_not_shuffled(spark):
    """Texts are moved, their terms only as partial counts of a term's documents."""
    docs = spark.createDataFrame([(1, "a b a"), (2, "b c"), (2, "b"), (3, None)], "doc_id long, text string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = TX.tf_idf(docs)
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" not in plan and "hashpartitioning(doc_id#" in plan and "hashpartitioning(term#" not in plan
        got = {(r["doc_id"], r["term"]): r["tf"] for r in df.collect()}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert got == {(1, "a"): 2, (1, "b"): 1, (2, "b"): 2, (2, "c"): 1}


def test_a_large_vocabulary_is_joined_by_a_shuffle(spark, monkeypatch):
    docs = spark.createDataFrame([(1, "a b a"), (2, "b c")], "doc_id long, text string")
    want = sorted(map(tuple, TX.tf_idf(docs).collect()))
    monkeypatch.setattr(TX, "SENT_TERMS", 1)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = TX.tf_idf(docs)
        assert "Broadcast" not in df._jdf.queryExecution().executedPlan().toString()
        assert sorted(map(tuple, df.collect())) == want
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
