"""Findings of the fourth run: what is written, moved and summed, and that results stay."""

import re

import pytest
from pyspark.sql import functions as F

from cartwheel.operators import analytics as A
from cartwheel.operators import features as FE
from cartwheel.llm import byte_bpe
from cartwheel.operators import clusters as CL
from cartwheel.operators import linear as LN
from cartwheel.operators import recommend as R
from cartwheel.sources import fixtures as FXS

SF = "/root/testdata/sf0.001"


@pytest.fixture
def shuffled(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.fixture(scope="module")
def baskets(spark):
    orders = [(str(o), None if o == 9 else f"u{o % 4}", "prior" if o < 16 else "train", str(o), "1", "9", "" if o < 4 else "7")
              for o in range(20)] + [("3", "u3", "prior", "3", "1", "9", ""), (None, "u1", "prior", "5", "1", "9", "2")]
    lines = [(str(o), None if (o + k) % 11 == 0 else str((o * k) % 7), str(k), str(k % 2)) for o in range(21) for k in range(1, 4)]
    orders = spark.createDataFrame(orders, "order_id string, user_id string, eval_set string, order_number string, order_dow string, "
                                           "order_hour_of_day string, days_since_prior_order string")
    names = "order_id string, product_id string, add_to_cart_order string, reordered string"
    return orders, *(spark.createDataFrame([r for r in lines if (int(r[0]) < 16) == first], names) for first in (True, False))


def exchanges(df):
    return len(re.findall("Exchange hashpartitioning", df._jdf.queryExecution().executedPlan().toString()))


def test_string_tables_are_read_from_the_typed_ones(spark):
    """Order, line and document tables are stored once."""
    for name in ("fx_orders", "fx_prior", "fx_trains", "fx_lines", "fx_docs"):
        assert FXS.load(spark, SF, name).count() > 0
    assert not {"fx_orders", "fx_prior", "fx_trains", "fx_lines", "fx_docs"} & {key[2] for key in FXS._STORED}


def test_lines_go_to_their_user_once(shuffled, baskets):
    """one exchange each of lines and orders for the join, and one by user."""
    assert exchanges(A.user_product_record(*baskets[:2])) <= 3


def test_train_matrix_is_that_of_plain_joins(baskets, shuffled):
    """Fewer passes, the same rows with null and repeated keys."""
    orders, prior, trains = baskets
    got = FE.train_matrix(orders, prior, trains)
    uf = FE.user_features(orders, prior).drop("u_prod_records")
    want = (FE.train_labels(orders, prior, trains).join(uf, "user_id").join(FE.product_features(prior), "product_id")
            .select(*got.columns))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect())) and got.count() > 10
    assert exchanges(got) < exchanges(want)


def test_sums_of_longs_are_those_of_decimals(spark):
    """exact beyond a long, for either sign."""
    rows = spark.createDataFrame([(v,) for v in (2**62, 2**62 - 1, 2**62, -1, -2**40 - 3, 0, None)], "n long")
    got = rows.agg(LN.exact_sum(F.col("n")).alias("a"), F.sum(F.col("n").cast("decimal(20,0)")).alias("b")).first()
    assert got["a"] == got["b"] == 3 * 2**62 - 1 - 1 - 2**40 - 3
    assert rows.filter("n is null").agg(LN.exact_sum(F.col("n"))).first()[0] is None


def ratings_of(spark):
    rows = [(u, i, (u * i) % 5 + 1) for u in range(30) for i in range(14) if (u + i) % 3] + [(None, 1, 3), (7, None, 2), (8, None, 4)]
    return spark.createDataFrame(rows, "user_id long, item_id long, rating int")


def test_neighbours_ratings_travel_as_lists(spark, shuffled):
    """the rows of the former anti join on (user, item), which is not planned any more."""
    ratings = ratings_of(spark)
    near = R.top_neighbours(R.directed_cosine(ratings), 25).cache()
    rv = ratings.select(F.col("user_id").alias("user_v"), "item_id", F.col("rating").alias("rating_v"))
    want = near.join(rv, "user_v").join(ratings.select("user_id", "item_id"), ["user_id", "item_id"], "left_anti").select(
        "user_id", "user_v", "item_id", (F.col("sim") * F.col("rating_v")).alias("score"))
    got = R.item_scores(near, ratings)
    key = lambda r: tuple(-1 if v is None else round(v, 9) for v in r)
    assert sorted(map(key, got.collect())) == sorted(map(key, want.collect())) and got.count() > 20
    assert got.filter("item_id is null").count() > 0
    sums = want.groupBy("user_id", "item_id").agg(F.sum("score").alias("sum_score"))
    assert sorted(map(key, R.recommend_gathered(near, ratings).collect())) == sorted(map(key, sums.collect()))
    for df in (got, R.recommend_gathered(near, ratings)):
        assert "LeftAnti" not in df._jdf.queryExecution().executedPlan().toString()


def test_ratings_are_made_once_for_the_pairs(spark):
    """sizes and arrays read written ratings, they don't sum each user's squares again."""
    plan = R.directed_cosine(ratings_of(spark))._jdf.queryExecution().executedPlan().toString()
    assert "POWER" not in plan.upper()


def test_distances_by_longs_are_those_by_decimals(spark):
    """The same whole numbers, and decimals where a product exceeds a long."""
    values = spark.createDataFrame([(d, f"t{t}", float((d * 7 + t * 5) % 11) * scale) for d in range(12) for t in range(6)
                                    for scale in (1.0,)], "doc_id long, term string, tfidf double")
    docs = values.select("doc_id").distinct()
    rows, points = CL.sparse_rows(values, docs)
    centres = CL.centres_at(rows, [0, 5, 9])
    made = [sorted(map(tuple, CL.distances(rows, points, centres, 3, top).collect())) for top in (CL.greatest(rows), CL.LONG_ROOT + 1)]
    assert made[0] == made[1]
    large, spots = CL.sparse_rows(values.withColumn("tfidf", F.col("tfidf") * 1e6), docs)
    assert CL.greatest(large) > CL.LONG_ROOT
    verdicts, costs = CL.lloyd(large, spots, [0, 5, 9], 2)
    assert verdicts.count() == 12 and costs == sorted(costs, reverse=True)
    sums = lambda top: CL.product_sum("x", "x", top)._jc.toString()
    assert "decimal(20,0)" not in sums(CL.LONG_ROOT + 1).lower() and "bigint" in sums(1).lower()


def test_memo_tables_of_a_worker_are_small():
    """op11_byte_bpe: five tables of at most so many entries, of some 200 bytes, in each worker."""
    assert byte_bpe.MEMO * 5 * 200 <= 64 << 20
