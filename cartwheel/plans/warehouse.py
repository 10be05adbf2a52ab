"""Catalog: warehouse SQL family (scans, filters, aggregates, joins, windows,
set operations, scalar functions) on the derived shopping-cart tables."""

from __future__ import annotations


from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions.typed import hour_gap, plus_columns, to_int, to_long
from ..functions.text import segment
from ..operators import analytics as A
from ..operators.skew import salted_counts
from ..session import scratch_path
from ..sinks import tables as SK
from ..sources import fixtures as FXS
from ..sources.tables import load_table
from .common import round_doubles
from .registry import query

OP = ("fx_orders", "fx_prior")


def _op(spark, sf):
    return FXS.load(spark, sf, "fx_orders"), FXS.load(spark, sf, "fx_prior")


def _article(spark, sf):
    """The ``article`` table: one text per row (documents.text)."""
    return load_table(spark, sf, "documents").select(F.col("text").alias("sentence"))


# ------------------------------------------------------------ scans / projections

@query("scan_project", ops=("S1", "P1"), fx=("fx_orders",), sql="""
SELECT order_id, user_id AS customer, order_number, order_dow FROM fx_orders""")
def q_scan_project(spark, sf):
    o = FXS.load(spark, sf, "fx_orders")
    return (o.drop("eval_set", "order_hour_of_day", "days_since_prior_order")
            .withColumnRenamed("user_id", "customer")
            .select("order_id", "customer", "order_number", "order_dow"))


@query("filter_eval_set", ops=("P2",), fx=("fx_orders",), sql="""
SELECT DISTINCT user_id FROM fx_orders WHERE eval_set = 'train'""")
def q_filter_eval_set(spark, sf):
    return A.users_in(FXS.load(spark, sf, "fx_orders"), "train")


@query("blank_to_zero", ops=("P4", "X7", "X8"), fx=("fx_orders",), sql="""
SELECT order_id, user_id,
       COALESCE(TRY_CAST(NULLIF(days_since_prior_order, '') AS DOUBLE), 0.0) AS days_since_prior_order
FROM fx_orders""")
def q_blank_to_zero(spark, sf):
    return A.blank_gap_to_zero(FXS.load(spark, sf, "fx_orders"))


@query("null_fill", ops=("P6",), fx=("fx_orders",), sql="""
SELECT order_id, COALESCE(TRY_CAST(order_hour_of_day AS INTEGER), 0) AS order_hour_of_day,
       COALESCE(TRY_CAST(days_since_prior_order AS DOUBLE), 0.0) AS days_since_prior_order
FROM fx_orders""")
def q_null_fill(spark, sf):
    o = FXS.load(spark, sf, "fx_orders")
    return o.select("order_id", to_int("order_hour_of_day").alias("order_hour_of_day"),
                    o["days_since_prior_order"].try_cast("double").alias("days_since_prior_order")
                    ).na.fill(0)


_DESC_COLS = ["order_number", "order_dow", "order_hour_of_day", "days_since_prior_order"]


@query("describe_columns", ops=("P8",), fx=("fx_orders",), sql=" UNION ALL ".join(f"""
SELECT '{c}' AS "column", count(v) AS n, round(avg(v), 6) AS mean, round(stddev_samp(v), 6) AS stddev,
       round(min(v), 6) AS min, round(max(v), 6) AS max
FROM (SELECT TRY_CAST(NULLIF({c}, '') AS DOUBLE) AS v FROM fx_orders) t""" for c in _DESC_COLS))
def q_describe_columns(spark, sf):
    o = FXS.load(spark, sf, "fx_orders").select(*[F.nullif(F.col(c), F.lit("")).try_cast("double").alias(c)
                                          for c in _DESC_COLS])
    long = o.unpivot([], _DESC_COLS, "column", "v")
    return round_doubles(long.groupBy("column").agg(
        F.count("v").alias("n"), F.avg("v").alias("mean"), F.stddev_samp("v").alias("stddev"),
        F.min("v").alias("min"), F.max("v").alias("max")))


@query("modulo_sample", ops=("S9", "X12"), fx=("fx_ratings",), sql="""
SELECT user_id, item_id, rating FROM fx_ratings WHERE user_id % 10 > 0""")
def q_modulo_sample(spark, sf):
    return FXS.load(spark, sf, "fx_ratings").filter(F.col("user_id") % 10 > 0)


@query("bucket_sample", ops=("S8",), fx=("fx_ratings",), sql="""
SELECT user_id, item_id, rating FROM fx_ratings WHERE ((user_id % 4) + 4) % 4 = 0""")
def q_bucket_sample(spark, sf):
    """``tablesample(bucket 1 out of 4 on user_id)``: the bucket of an int key is the
    key mod n. The table is laid out by it, and the sample reads one bucket's folder."""
    path = scratch_path(spark, "sampled")
    SK.save_sampled(FXS.load(spark, sf, "fx_ratings"), path, "user_id", 4)
    return SK.read_sample(spark, path, "user_id", 4, 1, 4)


# ------------------------------------------------------------ word count

@query("word_count", ops=("A1", "X1", "X4"), sql="""
SELECT word, count(*) AS cnt FROM (SELECT unnest(string_split(text, ' ')) AS word FROM documents) t
GROUP BY word""", bench=True)
def q_word_count(spark, sf):
    return A.word_count(_article(spark, sf))


@query("top_words", ops=("A25", "O2", "O4"), sql="""
SELECT word, count(*) AS cnt FROM (SELECT unnest(string_split(text, ' ')) AS word FROM documents) t
GROUP BY word ORDER BY cnt DESC, word LIMIT 100""")
def q_top_words(spark, sf):
    return A.top_words(_article(spark, sf), 100)


# ------------------------------------------------------------ order aggregates

@query("products_per_order", ops=("A2",), fx=OP, sql="""
SELECT order_id, count(product_id) AS prod_cnt FROM fx_prior GROUP BY order_id""")
def q_products_per_order(spark, sf):
    return A.products_per_order(FXS.load(spark, sf, "fx_prior"))


@query("order_size_by_user", ops=("J1",), fx=OP, sql="""
SELECT o.order_id, o.user_id, p.prod_cnt FROM fx_orders o
JOIN (SELECT order_id, count(product_id) AS prod_cnt FROM fx_prior GROUP BY order_id) p ON o.order_id = p.order_id""")
def q_order_size_by_user(spark, sf):
    return A.order_size_by_user(*_op(spark, sf))


@query("user_total_products", ops=("A3", "J7"), fx=OP, sql="""
SELECT o.user_id, CAST(sum(p.prod_cnt) AS BIGINT) AS sum_prod_cnt FROM fx_orders o
JOIN (SELECT order_id, count(product_id) AS prod_cnt FROM fx_prior GROUP BY order_id) p ON o.order_id = p.order_id
GROUP BY o.user_id""")
def q_user_total_products(spark, sf):
    return A.user_total_products(*_op(spark, sf))


@query("orders_per_user", ops=("A4",), fx=("fx_orders",), sql="""
SELECT user_id, count(order_id) AS order_cnt FROM fx_orders GROUP BY user_id""")
def q_orders_per_user(spark, sf):
    return A.orders_per_user(FXS.load(spark, sf, "fx_orders"))


@query("user_avg_order_size", ops=("A5",), fx=OP, sql="""
SELECT o.user_id, round(avg(p.prod_cnt), 6) AS avg_prod_cnt FROM fx_orders o
JOIN (SELECT order_id, count(product_id) AS prod_cnt FROM fx_prior GROUP BY order_id) p ON o.order_id = p.order_id
GROUP BY o.user_id""")
def q_user_avg_order_size(spark, sf):
    return round_doubles(A.user_avg_order_size(*_op(spark, sf)))


@query("per_day_ratio", ops=("A6",), fx=OP, sql="""
SELECT o.user_id, round(sum(p.prod_cnt) / count(DISTINCT o.days_since_prior_order), 6) AS day_cnt
FROM fx_orders o
JOIN (SELECT order_id, count(product_id) AS prod_cnt FROM fx_prior GROUP BY order_id) p ON o.order_id = p.order_id
GROUP BY o.user_id""")
def q_per_day_ratio(spark, sf):
    return round_doubles(A.per_day_ratio(*_op(spark, sf)))


@query("per_day_nested", ops=("A7",), fx=OP, sql="""
SELECT user_id, round(avg(prod_cnt), 6) AS avg_day_prod_cnt FROM (
  SELECT o.user_id, o.days_since_prior_order, sum(p.prod_cnt) AS prod_cnt FROM fx_orders o
  JOIN (SELECT order_id, count(product_id) AS prod_cnt FROM fx_prior GROUP BY order_id) p ON o.order_id = p.order_id
  GROUP BY o.user_id, o.days_since_prior_order) t
GROUP BY user_id""")
def q_per_day_nested(spark, sf):
    return round_doubles(A.per_day_nested(*_op(spark, sf)))


@query("user_day_count", ops=("A8",), fx=("fx_orders",), sql="""
SELECT user_id, count(DISTINCT days_since_prior_order) AS day_cnt FROM fx_orders GROUP BY user_id""")
def q_user_day_count(spark, sf):
    return A.user_day_count(FXS.load(spark, sf, "fx_orders"))


@query("dow_pivot", ops=("A9", "X6"), fx=("fx_orders",), sql="SELECT user_id, " + ", ".join(
    f"count(*) FILTER (WHERE order_dow = '{d}') AS dow_{d}" for d in A.DOW_VALUES)
    + " FROM fx_orders GROUP BY user_id")
def q_dow_pivot(spark, sf):
    return A.dow_pivot(FXS.load(spark, sf, "fx_orders"))


# ------------------------------------------------------------ product aggregates

@query("product_pv", ops=("A10",), fx=("fx_prior",), sql="""
SELECT product_id, count(*) AS pv FROM fx_prior GROUP BY product_id""")
def q_product_pv(spark, sf):
    return A.product_pv(FXS.load(spark, sf, "fx_prior"))


@query("product_uv", ops=("A11",), fx=OP, sql="""
SELECT p.product_id, count(DISTINCT o.user_id) AS uv FROM fx_orders o JOIN fx_prior p ON o.order_id = p.order_id
GROUP BY p.product_id""")
def q_product_uv(spark, sf):
    return A.product_uv(*_op(spark, sf))


@query("product_reorders", ops=("A12",), fx=("fx_prior",), sql="""
SELECT product_id, CAST(sum(CAST(reordered AS INTEGER)) AS BIGINT) AS reordered_cnt FROM fx_prior GROUP BY product_id""")
def q_product_reorders(spark, sf):
    return A.product_reorders(FXS.load(spark, sf, "fx_prior"))


@query("product_pv_reorders", ops=("A13",), fx=("fx_prior",), sql="""
SELECT product_id, count(*) AS pv, CAST(sum(CAST(reordered AS INTEGER)) AS BIGINT) AS reordered_cnt
FROM fx_prior GROUP BY product_id""")
def q_product_pv_reorders(spark, sf):
    return A.product_pv_reorders(FXS.load(spark, sf, "fx_prior"))


@query("product_pv_uv_onepass", ops=("A14",), fx=OP, sql="""
SELECT p.product_id, count(*) AS pv, count(DISTINCT o.user_id) AS uv,
       CAST(sum(CAST(p.reordered AS INTEGER)) AS BIGINT) AS reordered_cnt
FROM fx_orders o JOIN fx_prior p ON o.order_id = p.order_id GROUP BY p.product_id""", bench=True)
def q_product_pv_uv_onepass(spark, sf):
    return A.product_pv_uv_onepass(*_op(spark, sf))


@query("product_pv_uv_join", ops=("J8",), fx=OP, sql="""
SELECT l.product_id, count(*) AS pv, count(*) FILTER (l.reordered = '1') AS reordered_cnt,
       count(DISTINCT b.user_id) AS uv
FROM fx_prior l, fx_orders b WHERE b.order_id = l.order_id GROUP BY l.product_id""")
def q_product_pv_uv_join(spark, sf):
    return A.product_pv_uv_join(*_op(spark, sf))


# ------------------------------------------------------------ lists / sets

@query("user_order_list", ops=("A15",), fx=("fx_orders",), sql="""
SELECT user_id, string_agg(order_id, ',' ORDER BY CAST(order_id AS BIGINT)) AS order_ids
FROM fx_orders GROUP BY user_id""")
def q_user_order_list(spark, sf):
    return A.user_order_list(FXS.load(spark, sf, "fx_orders"))


_PAIRS = """(SELECT DISTINCT o.user_id, p.product_id FROM fx_orders o JOIN fx_prior p ON o.order_id = p.order_id)"""


@query("user_product_set", ops=("A16", "X19"), fx=OP, sql=f"""
SELECT user_id, string_agg(product_id, ',' ORDER BY CAST(product_id AS BIGINT)) AS product_set
FROM {_PAIRS} t GROUP BY user_id""")
def q_user_product_set(spark, sf):
    return A.user_product_set(*_op(spark, sf))


@query("user_product_record", ops=("A17",), fx=OP, sql=f"""
SELECT user_id, count(*) AS u_prod_dist_cnt,
       string_agg(product_id, ',' ORDER BY CAST(product_id AS BIGINT)) AS u_prod_records
FROM {_PAIRS} t GROUP BY user_id""")
def q_user_product_record(spark, sf):
    return A.user_product_record(*_op(spark, sf))


@query("user_product_totals", ops=("A18",), fx=OP, sql="""
SELECT user_id, CAST(sum(n) AS BIGINT) AS pro_tal,
       string_agg(product_id, ',' ORDER BY CAST(product_id AS BIGINT)) AS pro_record
FROM (SELECT o.user_id, p.product_id, count(*) AS n FROM fx_orders o JOIN fx_prior p ON o.order_id = p.order_id
      GROUP BY o.user_id, p.product_id) t GROUP BY user_id""")
def q_user_product_totals(spark, sf):
    return A.user_product_totals(*_op(spark, sf))


@query("user_hour_sequence", ops=("A19",), fx=("fx_orders",), sql="""
SELECT user_id, string_agg(order_number || '_' || order_hour_of_day, ','
                           ORDER BY order_hour_of_day, CAST(order_number AS BIGINT)) AS ons
FROM fx_orders GROUP BY user_id""")
def q_user_hour_sequence(spark, sf):
    return A.user_hour_sequence(FXS.load(spark, sf, "fx_orders"))


@query("user_top_decile_size", ops=("A20", "X9"), fx=OP, sql="""
SELECT o.user_id, CAST(ceil(CAST(count(DISTINCT p.product_id) AS DOUBLE) * CAST(0.1 AS DOUBLE)) AS BIGINT) AS total_prod_cnt
FROM fx_orders o JOIN fx_prior p ON o.order_id = p.order_id GROUP BY o.user_id""")
def q_user_top_decile_size(spark, sf):
    return A.user_top_decile_size(*_op(spark, sf))


@query("salted_count", ops=("A21",), fx=OP, sql="""
SELECT o.user_id, count(*) AS prod_cnt, count(DISTINCT p.product_id) AS dist_prod_cnt
FROM fx_orders o JOIN fx_prior p ON o.order_id = p.order_id GROUP BY o.user_id""")
def q_salted_count(spark, sf):
    o, p = _op(spark, sf)
    j = o.select("order_id", "user_id").join(p.select("order_id", "product_id"), "order_id")
    return (salted_counts(j, "user_id", "product_id", buckets=16)
            .select("user_id", F.col("rows").alias("prod_cnt"), F.col("distinct_values").alias("dist_prod_cnt")))


@query("distinct_pairs", ops=("A22",), fx=OP, sql=f"SELECT user_id, product_id FROM {_PAIRS} t")
def q_distinct_pairs(spark, sf):
    return A.distinct_pairs(*_op(spark, sf))


# ------------------------------------------------------------ windows

_UPC = """(SELECT o.user_id, p.product_id, count(*) AS c FROM fx_orders o JOIN fx_prior p ON o.order_id = p.order_id
  GROUP BY o.user_id, p.product_id)"""


@query("user_top3_products", ops=("W1", "X3"), fx=OP, sql=f"""
SELECT user_id, string_agg(product_id || '_' || CAST(row_num AS VARCHAR), ',' ORDER BY row_num) AS top_3_prods
FROM (SELECT user_id, product_id,
             row_number() OVER (PARTITION BY user_id ORDER BY c DESC, CAST(product_id AS BIGINT)) AS row_num
      FROM {_UPC} t) r
WHERE row_num <= 3 GROUP BY user_id""", bench=True)
def q_user_top3_products(spark, sf):
    return A.user_top_products(*_op(spark, sf), n=3)


@query("user_top_decile", ops=("W2", "W3", "W4"), fx=OP, sql=f"""
SELECT user_id, string_agg(product_id || '_' || CAST(row_num AS VARCHAR) || '_' || CAST(total AS VARCHAR), ','
                           ORDER BY row_num) AS top_10_perc_prod
FROM (SELECT user_id, product_id,
             row_number() OVER (PARTITION BY user_id ORDER BY c DESC, CAST(product_id AS BIGINT)) AS row_num,
             CAST(ceil(CAST(count(*) OVER (PARTITION BY user_id) AS DOUBLE) * CAST(0.1 AS DOUBLE)) AS BIGINT) AS total
      FROM {_UPC} t) r
WHERE row_num <= total GROUP BY user_id""")
def q_user_top_decile(spark, sf):
    return A.user_top_decile(*_op(spark, sf))


# ------------------------------------------------------------ joins / set ops

@query("join_diff_keys", ops=("J2",), fx=OP, sql="""
SELECT o.order_id, o.user_id, p.product_id, p.add_to_cart_order FROM fx_orders o JOIN fx_prior p ON o.order_id = p.order_id""")
def q_join_diff_keys(spark, sf):
    return A.join_diff_keys(*_op(spark, sf))


@query("three_way_join", ops=("J3",), fx=OP, sql="""
SELECT o.order_id, o.user_id, p.product_id, s.prod_cnt FROM fx_orders o
JOIN fx_prior p ON o.order_id = p.order_id
JOIN (SELECT order_id, count(product_id) AS prod_cnt FROM fx_prior GROUP BY order_id) s ON o.order_id = s.order_id""")
def q_three_way_join(spark, sf):
    return A.three_way_join(*_op(spark, sf))


@query("eval_set_overlap", ops=("U1",), fx=("fx_orders",), sql="""
WITH u AS (SELECT DISTINCT eval_set, user_id FROM fx_orders)
SELECT 'train&test' AS sets, count(*) AS users FROM (SELECT user_id FROM u WHERE eval_set='train' INTERSECT SELECT user_id FROM u WHERE eval_set='test') a
UNION ALL
SELECT 'prior&train', count(*) FROM (SELECT user_id FROM u WHERE eval_set='prior' INTERSECT SELECT user_id FROM u WHERE eval_set='train') b
UNION ALL
SELECT 'prior&test', count(*) FROM (SELECT user_id FROM u WHERE eval_set='prior' INTERSECT SELECT user_id FROM u WHERE eval_set='test') c""")
def q_eval_set_overlap(spark, sf):
    return A.eval_set_overlap(FXS.load(spark, sf, "fx_orders"))


# ------------------------------------------------------------ scalar functions

@query("split_composite_key", ops=("X2",), fx=OP, sql=f"""
SELECT user_id || '_' || product_id AS user_prod, split_part(user_id || '_' || product_id, '_', 1) AS user_id,
       split_part(user_id || '_' || product_id, '_', 2) AS product_id FROM {_PAIRS} t""")
def q_split_composite_key(spark, sf):
    up = A.distinct_pairs(*_op(spark, sf)).select(F.concat_ws("_", "user_id", "product_id").alias("user_prod"))
    parts = F.split("user_prod", "_")
    return up.select("user_prod", parts.getItem(0).alias("user_id"), parts.getItem(1).alias("product_id"))


@query("explode_struct_array", ops=("X5",), fx=("fx_prior",), sql="""
SELECT order_id, product_id AS item, CAST(add_to_cart_order AS INTEGER) AS pos FROM fx_prior""")
def q_explode_struct_array(spark, sf):
    p = FXS.load(spark, sf, "fx_prior")
    packed = p.groupBy("order_id").agg(F.collect_list(F.struct(
        F.col("product_id").alias("item"), to_int("add_to_cart_order").alias("pos"))).alias("items"))
    return packed.select("order_id", F.inline("items"))


@query("array_build_explode", ops=("X17", "V9"), fx=("fx_orders",), sql="""
SELECT order_id, order_number AS v FROM fx_orders UNION ALL SELECT order_id, order_dow AS v FROM fx_orders""")
def q_array_build_explode(spark, sf):
    o = FXS.load(spark, sf, "fx_orders")
    return o.select("order_id", F.explode(F.array("order_number", "order_dow")).alias("v"))


@query("array_scale", ops=("X18",), fx=("fx_ratings",), sql="""
SELECT user_id, count(*) FILTER (WHERE rating >= 3) AS kept,
       round(COALESCE(sum(rating * CAST(0.5 AS DOUBLE)) FILTER (WHERE rating >= 3), CAST(0.0 AS DOUBLE)), 6) AS scaled_sum
FROM fx_ratings GROUP BY user_id""")
def q_array_scale(spark, sf):
    r = FXS.load(spark, sf, "fx_ratings")
    per = r.groupBy("user_id").agg(F.collect_list(F.struct("item_id", "rating")).alias("items"))
    kept = F.filter("items", lambda s: s["rating"] >= 3)
    scaled = F.transform(kept, lambda s: s["rating"].cast("double") * F.lit(0.5))
    return round_doubles(per.select("user_id", F.size(kept).cast("bigint").alias("kept"),
                                    F.aggregate(scaled, F.lit(0.0), lambda a, x: a + x).alias("scaled_sum")))


@query("plus_columns", ops=("V5",), fx=("fx_orders",), sql="""
SELECT order_id, TRY_CAST(order_number AS INTEGER) + TRY_CAST(order_dow AS INTEGER) AS plus_udf FROM fx_orders""")
def q_plus_columns(spark, sf):
    o = FXS.load(spark, sf, "fx_orders")
    return o.select("order_id", plus_columns("order_number", "order_dow").alias("plus_udf"))


@query("hour_gap", ops=("X11", "V6"), fx=("fx_orders",), sql="""
SELECT order_id, CASE WHEN g IS NULL THEN NULL ELSE LEAST(g, 24 - g) END AS up_hour_vs_last
FROM (SELECT order_id, CAST(order_hour_of_day AS INTEGER)
             - lag(CAST(order_hour_of_day AS INTEGER)) OVER (PARTITION BY user_id ORDER BY CAST(order_number AS INTEGER)) AS g
      FROM fx_orders) t""")
def q_hour_gap(spark, sf):
    o = FXS.load(spark, sf, "fx_orders")
    w = Window.partitionBy("user_id").orderBy(to_int("order_number"))
    h = to_int("order_hour_of_day")
    return o.select("order_id", hour_gap(h, F.lag(h).over(w)).alias("up_hour_vs_last"))


@query("reseparate_tokens", ops=("X15",), sql="""
SELECT doc_id, array_to_string(regexp_extract_all(lower(text), '\\p{L}+'), ' ') AS seg FROM documents""")
def q_reseparate_tokens(spark, sf):
    d = load_table(spark, sf, "documents")
    return d.select("doc_id", F.regexp_replace(segment("text", "/"), "/", " ").alias("seg"))


@query("head_rows", ops=("O3",), fx=("fx_orders",), sql="""
SELECT order_id, user_id, order_dow FROM fx_orders ORDER BY CAST(order_id AS BIGINT) LIMIT 300""")
def q_head_rows(spark, sf):
    """O3: a row preview (``select ... limit 300``). The limit is the feature
    here; it is given a total order so the rows are always the same, which
    plans as a distributed top-k (TakeOrderedAndProject)."""
    o = FXS.load(spark, sf, "fx_orders")
    return o.orderBy(to_long("order_id")).limit(300).select("order_id", "user_id", "order_dow")
